import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from placefolio.operators import fetches
from placefolio.session import shared_folder
from placefolio.sources.fetch_log import write_fetch_log


@pytest.fixture(scope="module")
def log(spark):
    """20,000 pages of 200 sites in some 40 row groups."""
    rows = spark.range(20_000).select(
        F.concat(F.lit("http://s"), F.lpad((F.col("id") % 200).cast("string"), 3, "0"), F.lit(".example.com/"), F.col("id")).alias("url"),
        F.lit(200).alias("http_status"), F.lit(None).cast("string").alias("error"), F.lit("text/html").alias("content_type"),
        F.repeat(F.sha2(F.col("id").cast("string"), 256), 20).cast("binary").alias("content"))
    path = f"{shared_folder(spark)}/log-{uuid.uuid4().hex}"
    return path, write_fetch_log(rows.union(rows.limit(1).withColumn("url", F.lit(None).cast("string"))), path, 4, row_group_bytes=512 << 10,
                                 urls_per_group=1000)


def rows_read(df):
    """Rows that the scan of a collected query gave on."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    leaves = plan.collectLeaves()
    return max(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size())
               if "Scan" in leaves.apply(i).nodeName())


def test_layout(log):
    import glob
    groups = [pq.ParquetFile(f).metadata for f in glob.glob(f"{log[0].removeprefix('file:')}/*.parquet")]
    assert sum(m.num_row_groups for m in groups) >= 20
    # One range of URLs per row group, none overlapping the next.
    ranges = sorted((c.statistics.min, c.statistics.max) for m in groups for g in range(m.num_row_groups)
                    for c in [m.row_group(g).column(0)] if c.statistics and c.statistics.has_min_max)
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_asked_urls_skip_row_groups(spark, log):
    _, table = log
    asked = spark.createDataFrame([("http://s007.example.com/207",), ("http://s150.example.com/150",), ("http://nowhere.example.com/1",),
                                   (None,)], "url string")
    few, joined = fetches.asked_rows(table, asked), fetches.asked_rows(table, asked, most_literals=2)
    assert sorted(map(str, few.collect())) == sorted(map(str, joined.collect())) and few.count() == 2
    few.collect()
    assert rows_read(few) < 0.2 * table.count()
    # A URL that lies inside a range and was never fetched is settled by the Bloom filter alone.
    inside = spark.createDataFrame([(f"http://s{i:03}.example.com/{i}5x",) for i in range(3, 190, 40)], "url string")
    nothing = fetches.asked_rows(table, inside)
    assert nothing.collect() == [] and rows_read(nothing) == 0
    assert fetches.asked_rows(table, asked.limit(0)).collect() == []


def test_filter_reaches_the_scan(spark, log):
    asked = spark.createDataFrame([(f"u{i}",) for i in range(20)], "url string")
    text = fetches.asked_rows(log[1], asked)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(url" in text
