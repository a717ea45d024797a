"""Consumer reports over the final tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from placefolio.operators.hot_keys import join_on_unique
from placefolio.operators.status import STATUS_NAMES


def status_breakdown(catalogue: DataFrame) -> DataFrame:
    return (catalogue.groupBy("menu_status")
            .agg(F.count("*").alias("restaurants"), F.sum("menu_item_count").cast("bigint").alias("total_items"))
            .orderBy(F.desc("restaurants"), "menu_status"))


def run_summary(catalogue: DataFrame, items: DataFrame) -> DataFrame:
    """One row of counts with the status breakdown as JSON. Each table is read once."""
    per_status = catalogue.groupBy("menu_status").agg(
        F.count("*").alias("n"), F.count_if(F.col("website_uri").isNotNull()).alias("with_website"))
    places = per_status.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("restaurants"),
        F.coalesce(F.sum("with_website"), F.lit(0)).cast("bigint").alias("with_website"),
        F.coalesce(F.sum(F.when(F.col("menu_status") == "menu_extracted", F.col("n"))), F.lit(0)).cast("bigint")
        .alias("restaurants_with_menu"),
        # At most one entry per status name.
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("menu_status", "n")))))
        .alias("status_breakdown"))
    return (places.unionByName(items.agg(F.count("*").alias("menu_items")), allowMissingColumns=True)
            .agg(*[F.max(name).alias(name) for name in (
                "restaurants", "with_website", "menu_items", "restaurants_with_menu", "status_breakdown")]))


def summary_counts() -> list[Column]:
    """What a summary needs of a catalogue, as aggregates without keys that can be taken while it is written."""
    return [F.count(F.lit(1)).alias("restaurants"), F.count_if(F.col("website_uri").isNotNull()).alias("with_website"),
            *[F.count_if(F.col("menu_status") == name).alias(name) for name in STATUS_NAMES]]


def summary_of_counts(spark: SparkSession, catalogue: dict, menu_items: int) -> DataFrame:
    """The row of :func:`run_summary` from counts taken while the tables were written."""
    per_status = {name: catalogue[name] for name in sorted(STATUS_NAMES) if catalogue[name]}
    row = (catalogue["restaurants"], catalogue["with_website"], menu_items, catalogue["menu_extracted"],
           json.dumps(per_status, separators=(",", ":")))
    return spark.createDataFrame([row], "restaurants bigint, with_website bigint, menu_items bigint, restaurants_with_menu bigint, "
                                        "status_breakdown string")


def _named_items(items: DataFrame, places: DataFrame, *columns: str) -> DataFrame:
    return join_on_unique(items, places.select("place_id", *columns), "place_id")


def priced_items(items: DataFrame, places: DataFrame) -> DataFrame:
    """Items with a price under their place's name, by name and section."""
    order = ["name", "section", "place_id", "item_name", "price"]
    return (_named_items(items.where(F.col("price").isNotNull()), places, "name")
            .orderBy(*order).select("name", "section", "item_name", "price", "currency"))


def item_sample(items: DataFrame, places: DataFrame, size: int = 50) -> DataFrame:
    """First ``size`` items by place name."""
    order = ["name", "place_id", "section", "item_name", "description", "price"]
    return (_named_items(items, places, "name", "rating").orderBy(*order).limit(size)
            .select("name", "rating", "section", "item_name", "price", "currency"))
