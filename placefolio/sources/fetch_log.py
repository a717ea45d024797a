"""Layout of a large fetch log, so that a run which asks for few URLs reads few row groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Bytes of a row group. Small ones are skipped more often, but each costs its statistics and a Bloom filter.
ROW_GROUP_BYTES = 16 << 20
# Distinct URLs that the Bloom filter of a row group is made for, and how often it may be wrong.
URLS_PER_GROUP, WRONG = 20_000, 0.01


def write_fetch_log(log: DataFrame, path: str, partitions: int | None = None, row_group_bytes: int = ROW_GROUP_BYTES,
                    urls_per_group: int = URLS_PER_GROUP) -> DataFrame:
    """Write a log sorted by URL, with a Bloom filter on it in each row group, and read it back.

    Ranges of URLs keep the pages of a site together, so the statistics of a row group name a short range; the filter
    settles URLs that fall into the range and were never fetched. Rows without a URL come first.
    """
    ordered = log.repartitionByRange(partitions, "url") if partitions else log.repartitionByRange("url")
    (ordered.sortWithinPartitions("url").write
     .option("parquet.block.size", row_group_bytes)
     .option("parquet.bloom.filter.enabled#url", "true")
     .option("parquet.bloom.filter.expected.ndv#url", urls_per_group)
     .option("parquet.bloom.filter.fpp#url", WRONG)
     .parquet(path))
    return read_fetch_log(log.sparkSession, path)


def read_fetch_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
