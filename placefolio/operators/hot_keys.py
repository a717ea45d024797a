"""Joins that keep working when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# A key is spread from this many rows on, over one task per this many rows.
HOT_KEY_ROWS = 100_000
# Keys that are spread at most: each one beyond has less than this share of the rows, whatever their number.
MAX_HOT_KEYS = 50_000


def hot_keys(rows: DataFrame, key: str, hot_key_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Every key with at least ``hot_key_rows`` rows as ``(key, _copies)``, from a count with map-side combine.

    The list is broadcast. It holds the ``MAX_HOT_KEYS`` most frequent ones at most.
    """
    return hottest(rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n")), key, hot_key_rows)


def hottest(counts: DataFrame, key: str, hot_key_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """The same from ``(key, _n)``, where the rows of each key are counted already."""
    return (counts.where(F.col("_n") >= hot_key_rows).orderBy(F.desc("_n"), key).limit(MAX_HOT_KEYS)
            .select(key, F.ceil(F.col("_n") / hot_key_rows).cast("int").alias("_copies")))


def spread_join(rows: DataFrame, lookup: DataFrame, on: list[str], hot: DataFrame, how: str = "inner") -> DataFrame:
    """Join ``rows`` to a ``lookup`` that is unique on ``on``, with the rows of hot keys spread.

    ``hot`` comes from :func:`hot_keys` for one of the join columns. Rows of a hot key get the number of their
    task as salt, which a repeated task gets again, and the lookup rows are copied per salt. Rows without a key match
    nothing, so they are spread over all tasks. All other keys join as they are.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    key, copies = hot.columns[0], F.coalesce("_copies", F.lit(1))
    left = (rows.join(F.broadcast(hot), key, "left")
            .withColumn("_salt", F.when(F.col(key).isNull(), F.spark_partition_id())
                        .otherwise(F.pmod(F.spark_partition_id(), copies))).drop("_copies"))
    right = (lookup.join(F.broadcast(hot), key, "left")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0), copies - 1))).drop("_copies"))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def join_on_unique(rows: DataFrame, lookup: DataFrame, key: str, how: str = "inner",
                   hot_key_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Join to a ``lookup`` with one row per ``key``. ``rows`` is read twice, first for its keys only."""
    return spread_join(rows, lookup, [key], hot_keys(rows, key, hot_key_rows), how)
