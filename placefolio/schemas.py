"""Schemas of the stored tables and of the JSON they are read from."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**columns: str) -> T.StructType:
    schema = T.StructType()
    for name, kind in columns.items():
        schema = schema.add(name, kind)
    return schema


BRONZE = _schema(place_id="string", raw_json="string", ingested_at="timestamp")

SILVER = _schema(
    place_id="string", name="string", formatted_address="string", latitude="double", longitude="double",
    primary_type="string", types="string", rating="double", user_rating_count="long", price_level="string",
    website_uri="string", phone="string", opening_hours="string", business_status="string")

DOCUMENTS = _schema(
    place_id="string", source_url="string", doc_type="string", http_status="integer", content_type="string",
    stored_path="string", raw_text="string", robots_allowed="boolean", note="string")

# One constant for the filled and the empty items table, so both always have the same columns.
ITEMS = _schema(
    place_id="string", source_url="string", section="string", item_name="string", description="string",
    price="double", currency="string", extracted_at="timestamp")

ITEM_KEY = ("place_id", "section", "item_name", "description", "price")

# Places stay JSON text on this level: bronze keeps each one exactly as it was recorded.
SEARCH_PAGE_JSON = "places ARRAY<STRING>, nextPageToken STRING, _corrupt STRING"

PLACE_JSON = (
    "id STRING, displayName STRUCT<text: STRING>, formattedAddress STRING, "
    "location STRUCT<latitude: DOUBLE, longitude: DOUBLE>, rating DOUBLE, userRatingCount BIGINT, "
    "priceLevel STRING, types ARRAY<STRING>, primaryType STRING, websiteUri STRING, "
    "nationalPhoneNumber STRING, currentOpeningHours STRUCT<weekdayDescriptions: ARRAY<STRING>>, "
    "businessStatus STRING")

RESPONSE_JSON = "items ARRAY<STRUCT<section: STRING, item_name: STRING, description: STRING, price: DOUBLE>>"
