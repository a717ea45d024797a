"""First n rows of a total order, for any n."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, Window as W, functions as F

from placefolio.session import staged

# So many rows of order columns may meet in one task.
FEW_ROWS = 10_000


def first_rows(df: DataFrame, order: list[str], n: int | None) -> DataFrame:
    """First ``n`` rows by ``order``, which must identify a row. ``None`` keeps all rows.

    The n-th row is looked for among the order columns alone, and all rows up to it are kept by a filter. Up to ``FEW_ROWS``
    every task passes on its own first ``n``. Beyond, the order columns are range-partitioned and staged, the ranges are
    counted, and the range that holds the n-th row is looked into: no task meets more than a range, whatever ``n`` is. Both
    ways find the same row, and the driver gets no other.
    """
    if n is None:
        return df
    if n < 1:
        return df.where("false")
    last = _last_of_few(df, order, n) if n <= FEW_ROWS else _last_by_ranges(df, order, n)
    if last is None:
        return df
    types = dict(df.select(*order).dtypes)
    bound = F.struct(*[F.lit(last[name]).cast(types[name]).alias(name) for name in order])
    return df.where(F.struct(*order) <= bound)


def _last_of_few(df: DataFrame, order: list[str], n: int) -> Row | None:
    """The n-th row, None if there are fewer."""
    first = df.select(*order).orderBy(*order).limit(n)
    found = first.agg(F.count("*").alias("n"), F.max(F.struct(*order)).alias("last")).first()
    return found["last"] if found["n"] == n else None


def _last_by_ranges(df: DataFrame, order: list[str], n: int) -> Row | None:
    ranged = staged(df.select(*order).repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    # One row per range, so at most as many rows as there are shuffle partitions.
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_size"))
    upto = W.orderBy("_range").rowsBetween(W.unboundedPreceding, W.currentRow)
    cut = (sizes.withColumn("_upto", F.sum("_size").over(upto)).where((F.col("_upto") >= n))
           .orderBy("_range").limit(1).first())
    if cut is None:
        return None
    inside = n - (cut["_upto"] - cut["_size"])
    return (ranged.where(F.col("_range") == cut["_range"])
            .withColumn("_row", F.row_number().over(W.partitionBy("_range").orderBy(*order)))
            .where(F.col("_row") == inside).first())
