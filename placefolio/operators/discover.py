"""Recorded search results -> one row per place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from placefolio import schemas
from placefolio.operators.hot_keys import join_on_unique
from placefolio.operators.topn import first_rows
from placefolio.params import DEFAULT_TARGET, MAX_PAGES_PER_QUERY
from placefolio.session import staged

DISCOVERY_ORDER = ["query_ord", "page_no", "pos"]


def number_queries(pages: DataFrame, queries: tuple[str, ...]) -> DataFrame:
    """Pages recorded by ``search_query`` get the query's place in the parameter list as ``query_ord``."""
    order = pages.sparkSession.createDataFrame(
        [(query, number) for number, query in enumerate(queries)], "search_query string, query_ord bigint")
    return pages.join(order, "search_query")


def read_search_pages(pages: DataFrame) -> DataFrame:
    """Parse recorded pages ``(query_ord, page_no, first_pos, response, error)``.

    A page may be recorded in several rows; ``first_pos`` is the position of a row's first place.
    """
    parsed = F.from_json("response", schemas.SEARCH_PAGE_JSON, {"columnNameOfCorruptRecord": "_corrupt"})
    return pages.withColumn("_page", parsed).select(
        "query_ord", "page_no", "first_pos",
        (F.col("error").isNotNull() | F.col("_page").isNull() | F.col("_page._corrupt").isNotNull()).alias("failed"),
        (F.coalesce(F.col("_page.nextPageToken"), F.lit("")) != "").alias("has_next"),
        F.coalesce(F.col("_page.places"), F.array().cast("array<string>")).alias("places"))


def _each_place(places: str | Column) -> list[Column]:
    # The outer form: for the other one the optimizer would parse the page once more to filter empty lists.
    return [F.posexplode_outer(places).alias("_at", "raw_json")]


def replay_search(pages: DataFrame, max_pages: int | None = MAX_PAGES_PER_QUERY) -> DataFrame:
    """Listings ``(query_ord, page_no, pos, raw_json)`` a paging client would have seen.

    A query ends before its first failed or missing page, behind its first page without a next token, and after
    ``max_pages`` pages (``None``: no such limit); other queries go on.
    """
    read = read_search_pages(pages)
    if max_pages is not None:
        read = read.where(F.col("page_no") < max_pages)
    # One row per query and page behind the map-side combine, whatever the size of its pages. A client goes on from
    # a page to the next as long as none before it failed, was the last, or is missing.
    state = read.groupBy("query_ord", "page_no").agg(F.max("failed").alias("failed"), F.max("has_next").alias("has_next"))
    in_order = W.partitionBy("query_ord").orderBy("page_no")
    ends = (state.withColumn("_at", F.row_number().over(in_order) - 1)
            .withColumn("_stop", F.when(F.col("failed") | (F.col("page_no") != F.col("_at")), F.col("_at") - 1)
                        .when(~F.col("has_next"), F.col("_at")))
            .groupBy("query_ord").agg(F.min("_stop").alias("_last_page")))
    return (join_on_unique(read, ends, "query_ord")
            .where(F.col("_last_page").isNull() | (F.col("page_no") <= F.col("_last_page")))
            .select("query_ord", "page_no", "first_pos", *_each_place("places"))
            .where(F.col("raw_json").isNotNull())
            .select("query_ord", "page_no", (F.col("first_pos") + F.col("_at")).alias("pos"), "raw_json"))


def with_place_id(listings: DataFrame) -> DataFrame:
    return listings.withColumn("place_id", F.get_json_object("raw_json", "$.id"))


def first_seen_order(listings: DataFrame) -> DataFrame:
    """``(place_id, query_ord, page_no, pos)`` of each place's first listing. Rows without an id are dropped.

    A hash aggregate on one number: a place that is listed over and over shrinks to one row per task, unsorted. The
    number has 14 digits for the query, 10 for the page and 14 for the position; larger ones raise an error.
    """
    zeros = {"query_ord": 24, "page_no": 14, "pos": 0}
    sizes = {"query_ord": 14, "page_no": 10, "pos": 14}
    packed = " + ".join(f"CAST(CAST({name} AS DECIMAL({sizes[name]}, 0)) * {10 ** zeros[name]}BD AS DECIMAL(38, 0))"
                        for name in DISCOVERY_ORDER)
    types = dict(listings.dtypes)
    left = {"query_ord": "_at", "page_no": f"_at % {10 ** 24}BD", "pos": f"_at % {10 ** 14}BD"}
    unpacked = [F.expr(f"({left[name]}) div {10 ** zeros[name]}BD").cast(types[name]).alias(name) for name in DISCOVERY_ORDER]
    return (listings.where(F.coalesce("place_id", F.lit("")) != "")
            .groupBy("place_id").agg(F.min(F.expr(f"CAST({packed} AS DECIMAL(38, 0))")).alias("_at"))
            .select("place_id", *unpacked))


def with_payload(found: DataFrame, listings: DataFrame) -> DataFrame:
    """The other columns of each place's first listing; of repeated listings at one position the smallest."""
    key = ["place_id", *DISCOVERY_ORDER]
    rest = [name for name in listings.columns if name not in key]
    return (listings.join(found, key, "left_semi").groupBy(*key).agg(F.min(F.struct(*rest)).alias("_rest"))
            .select(*key, *[f"_rest.{name}" for name in rest]))


def first_seen(listings: DataFrame) -> DataFrame:
    """One row per place: its first listing by query, page and position. Rows without an id are dropped."""
    return with_payload(first_seen_order(listings), listings)


def discover(pages: DataFrame, target: int | None = DEFAULT_TARGET,
             max_pages: int | None = MAX_PAGES_PER_QUERY) -> DataFrame:
    """First ``target`` distinct places in discovery order, with that order and the recorded JSON."""
    # Written once: the order needs three numbers and the id of each listing, only the winners need the rest.
    listings = staged(with_place_id(replay_search(pages, max_pages)), "listings")
    found = staged(first_seen_order(listings), "first-seen")
    return with_payload(first_rows(found, [*DISCOVERY_ORDER, "place_id"], target), listings)


def flatten_places(bronze: DataFrame) -> DataFrame:
    """Place JSON in ``raw_json`` -> the 14 metadata columns; other columns are kept in front.

    Missing parents give null, a missing type list gives ``''`` and missing hours give null.
    """
    silver = set(schemas.SILVER.fieldNames())
    kept = [name for name in bronze.columns if name not in silver and name != "raw_json"]
    place = bronze.withColumn("_p", F.from_json("raw_json", schemas.PLACE_JSON))
    hours = F.col("_p.currentOpeningHours.weekdayDescriptions")
    fields = {
        "place_id": F.col("_p.id"),
        "name": F.col("_p.displayName.text"),
        "formatted_address": F.col("_p.formattedAddress"),
        "latitude": F.col("_p.location.latitude"),
        "longitude": F.col("_p.location.longitude"),
        "primary_type": F.col("_p.primaryType"),
        "types": F.concat_ws(",", F.col("_p.types")),
        "rating": F.col("_p.rating"),
        "user_rating_count": F.col("_p.userRatingCount"),
        "price_level": F.col("_p.priceLevel"),
        "website_uri": F.col("_p.websiteUri"),
        "phone": F.col("_p.nationalPhoneNumber"),
        "opening_hours": F.when(F.size(hours) > 0, F.concat_ws(" | ", hours)),
        "business_status": F.col("_p.businessStatus"),
    }
    return place.select(*kept, *[fields[name].alias(name) for name in schemas.SILVER.fieldNames()])


def page_sample(pages: DataFrame, size: int = 5) -> DataFrame:
    """First ``size`` places of every page in five fields, with the page's place count and next-page flag."""
    read = read_search_pages(pages)
    answered = F.when(~F.col("failed"), F.col("places"))
    totals = read.groupBy("query_ord", "page_no").agg(
        F.sum(F.coalesce(F.size(answered), F.lit(0))).cast("bigint").alias("returned"),
        F.max(F.col("has_next") & ~F.col("failed")).alias("has_next_page_token"))
    sample = (read.where(F.col("first_pos") < size)
              .select("query_ord", "page_no", "first_pos", *_each_place(F.slice(answered, 1, size)))
              .where(F.col("raw_json").isNotNull())
              .withColumn("pos", F.col("first_pos") + F.col("_at")).where(F.col("pos") < size)
              .withColumn("_p", F.from_json("raw_json", schemas.PLACE_JSON)))
    return sample.join(totals, ["query_ord", "page_no"]).select(
        "query_ord", "page_no", "pos", "returned", "has_next_page_token",
        F.col("_p.displayName.text").alias("name"), F.col("_p.websiteUri").alias("website"),
        F.col("_p.primaryType").alias("primary_type"), F.col("_p.rating").alias("rating"),
        F.col("_p.priceLevel").alias("price_level"))
