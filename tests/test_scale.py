"""Skew and size paths give the same rows as the plain form."""

import re

import pytest
from pyspark.sql import functions as F

from placefolio.operators.hot_keys import hot_keys, join_on_unique, spread_join
from placefolio.operators import topn
from placefolio.operators.topn import first_rows
from placefolio.session import shared_folder, staged


@pytest.fixture(scope="module")
def skewed(spark):
    # A third of all rows, exact copies among them, on one key.
    rows = spark.range(9_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 500 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 700).cast("string"))).alias("k"), (F.col("id") % 4).alias("v"))
    lookup = spark.range(600).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), F.col("id").alias("x"))
    return rows, lookup.union(spark.createDataFrame([("hot", -1)], "k string, x bigint"))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_spread_joins_equal_the_plain_join(spark, skewed, how, broadcast):
    rows, lookup = skewed
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        plain = rows.join(lookup, "k", how)
        for df in (join_on_unique(rows, lookup, "k", how, hot_key_rows=1_000), join_on_unique(rows, lookup, "k", how),
                   join_on_unique(rows, lookup, "k", how, hot_key_rows=1),
                   spread_join(rows, lookup, ["k"], hot_keys(rows, "k", 10), how)):
            df = df.select(plain.columns)
            assert df.count() == plain.count()
            assert df.exceptAll(plain).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_other_join_types_are_refused(skewed):
    rows, lookup = skewed
    with pytest.raises(ValueError):
        join_on_unique(rows, lookup, "k", "right")


def test_copies_follow_the_rows_of_a_key(skewed):
    rows, _ = skewed
    assert {r["k"]: r["_copies"] for r in hot_keys(rows, "k", 250).collect()} == {"hot": 12}


@pytest.mark.parametrize("few", [0, 10_000])
@pytest.mark.parametrize("n", [0, 1, 999, 1_500, 3_000, 5_000])
def test_large_prefix_equals_the_limit(spark, n, few, monkeypatch):
    monkeypatch.setattr(topn, "FEW_ROWS", few)
    # One leading value holds a third of the rows.
    df = spark.range(3_000, numPartitions=5).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("a"), F.col("id").alias("b"), F.lit("x").alias("c"))
    want = {tuple(r) for r in df.orderBy("a", "b").limit(n).collect()}
    got = [tuple(r) for r in first_rows(df, ["a", "b"], n).collect()]
    assert set(got) == want and len(got) == len(want)
    assert first_rows(df, ["a", "b"], None) is df


def test_staged_data_lies_in_the_named_folder(spark):
    folder = shared_folder(spark)
    assert spark.conf.get("spark.checkpoint.dir").rstrip("/") == folder
    df = staged(spark.range(5).withColumn("s", F.lit("x")), "probe")
    assert df.count() == 5 and all(folder in name for name in df.inputFiles())


def test_answers_meet_their_texts_in_three_shuffles(spark):
    from placefolio.operators import extraction

    # One text is frequent, some rows have none.
    text = (F.when(F.col("id") % 3 == 0, "Red Soup 4.50").when(F.col("id") % 7 == 1, F.lit(None))
            .when(F.col("id") % 7 == 2, "refused").otherwise(F.concat_ws(" ", F.lit("Soup"), F.col("id") % 90, F.lit("Dish 2.50"))))
    texts = staged(spark.range(2_000, numPartitions=6).select(
        F.concat(F.lit("p"), F.col("id") % 500).alias("place_id"), F.concat(F.lit("u"), F.col("id")).alias("source_url"),
        text.alias("source_text")), "texts")

    def extract(prompt):
        if "refused" in prompt:
            raise ValueError("refused")
        return extraction.rule_extractor(prompt)

    def wanted(text):
        if text is None:
            return None, None
        return (None, "ValueError: refused") if text == "refused" else (extraction.rule_extractor(text), None)

    want = sorted(((r["place_id"], r["source_url"], *wanted(r["source_text"])) for r in texts.collect()), key=str)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for hot_key_rows in (100, 100_000):
            got = extraction.extract_items(texts, extract, hot_key_rows=hot_key_rows)
            assert sorted(map(tuple, got.collect()), key=str) == want
        counted = extraction.with_answers(texts, extraction.new_answers(texts, extract))
        assert sorted(map(tuple, counted.collect()), key=str) == want
        got = extraction.extract_items(texts, extract, hot_key_rows=100)
        got.collect()
        final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        # Texts, rows and answers: the hot keys are found where the copies of a text meet.
        assert len(re.findall(r"\+- Exchange hashpartitioning", final)) == 3 and "ReusedExchange" in final
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
