"""Responses -> clean item rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from placefolio import schemas
from placefolio.operators.extraction import parse_responses
from placefolio.params import DEFAULT_CURRENCY


def explode_items(responses: DataFrame) -> DataFrame:
    return (parse_responses(responses)
            .select("place_id", "source_url", F.explode_outer("parsed.items").alias("item"))
            .select("place_id", "source_url", "item.section", "item.item_name", "item.description", "item.price"))


def with_name(items: DataFrame) -> DataFrame:
    """Items with a name. SQL ``trim`` takes spaces only: a name that is just a line break passes."""
    return items.where("item_name IS NOT NULL AND length(trim(item_name)) > 0")


def distinct_items(items: DataFrame) -> DataFrame:
    """One row per item of a place; of several sources the smallest stays. Nulls are equal, prices differ.

    The smallest of strings needs sorted input, so repeats go first, by hash and before the shuffle.
    """
    found = items.select(*schemas.ITEM_KEY, "source_url").distinct()
    return found.groupBy(*schemas.ITEM_KEY).agg(F.min("source_url").alias("source_url"))


def clean_items(items: DataFrame) -> DataFrame:
    return distinct_items(with_name(items))


def items_from_responses(responses: DataFrame, currency: str = DEFAULT_CURRENCY,
                         run_ts: Column | None = None) -> DataFrame:
    """Item table of all responses. Pass ``run_ts`` to get the same rows in every run."""
    return (clean_items(explode_items(responses))
            .withColumn("currency", F.lit(currency))
            .withColumn("extracted_at", F.current_timestamp() if run_ts is None else run_ts)
            .select(*schemas.ITEMS.fieldNames()))


def empty_items(spark: SparkSession) -> DataFrame:
    """Item table of a run that found nothing."""
    return spark.createDataFrame([], schemas.ITEMS)
