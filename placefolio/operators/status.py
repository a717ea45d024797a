"""Place status from items and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# The status names, first match wins.
STATUS_NAMES = ("no_website", "menu_extracted", "not_attempted", "source_found_no_items", "robots_blocked", "fetch_failed",
                "no_menu_found")


def items_per_place(items: DataFrame) -> DataFrame:
    return items.groupBy("place_id").agg(F.count("*").alias("n_items"))


def document_flags(documents: DataFrame) -> DataFrame:
    """What the fetches of a place came to, over all its document rows."""
    def any_of(*kinds):
        return F.coalesce(F.bool_or(F.col("doc_type").isin(*kinds)), F.lit(False))

    return documents.groupBy("place_id").agg(
        any_of("html", "pdf").alias("has_source"), any_of("robots_blocked").alias("was_blocked"),
        any_of("fetch_failed").alias("has_failed"))


def place_status(places: DataFrame, items: DataFrame, documents: DataFrame) -> DataFrame:
    """All place columns with ``menu_status`` and ``menu_item_count``, one row per place.

    Items and documents are aggregated before they meet the places, so both joins are one to one and each
    input is shuffled once.
    """
    joined = (places.join(items_per_place(items), "place_id", "left")
              .join(document_flags(documents), "place_id", "left"))
    no_website, extracted, not_attempted_, no_items, blocked, failed, nothing = STATUS_NAMES
    # A place without document rows has null flags.
    status = (F.when(F.col("website_uri").isNull(), no_website)
              .when(F.col("n_items") > 0, extracted)
              .when(F.col("has_source").isNull(), not_attempted_)
              .when(F.col("has_source"), no_items)
              .when(F.col("was_blocked"), blocked)
              .when(F.col("has_failed"), failed)
              .otherwise(nothing))
    return joined.select(*[F.col(name) for name in places.columns], status.alias("menu_status"),
                         F.coalesce("n_items", F.lit(0)).cast("bigint").alias("menu_item_count"))


def not_attempted(places: DataFrame, documents: DataFrame) -> DataFrame:
    """Places with a website that no document row exists for."""
    return places.where(F.col("website_uri").isNotNull()).join(
        documents.select("place_id"), "place_id", "left_anti")
