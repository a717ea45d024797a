"""Exact de-duplication with a heavy-hitter split.

A frequent-items sketch (Misra-Gries counters, merged in two levels) names digests that may be frequent, an exact count
verifies them, and the winners, at most ``MAX_WINNERS`` rows, are broadcast: their copies are decided on the map side.
Only the other digests are shuffled, and none of those can hold more than about 1/MAX_WINNERS of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from placefolio.llm.common import BLANKS, fresh, text_of
from placefolio.session import staged

# Counters of the sketch, a power of two. Every digest with more than about 1.5 / SKETCH_ITEMS of the rows is in it.
SKETCH_ITEMS = 4096
MAX_WINNERS = 2000
# Tasks whose sketches are merged at once, so that the last merge gets one sketch per group, not one per task.
MERGED_TASKS = 256


def digest_of(column: str = "text"):
    """SHA-256 of the text with each run of ASCII blanks as one space."""
    return F.sha2(F.regexp_replace(text_of(column), BLANKS, " ").cast("binary"), 256)


def frequent_digests(digests: DataFrame, most: int = MAX_WINNERS) -> DataFrame:
    """At most ``most`` digests that may be frequent."""
    per_group = (digests.groupBy(F.expr(f"spark_partition_id() div {MERGED_TASKS}").alias("part"))
                 .agg(F.expr(f"approx_top_k_accumulate(digest, {SKETCH_ITEMS})").alias("sketch")))
    # Grouped by a constant: without a key, tasks without rows would add sketches of no type, which cannot be merged.
    top = per_group.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {SKETCH_ITEMS})").alias("sketch"))
    return (top.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {most})")).alias("found"))
            .select(F.col("found.item").alias("digest")).where(F.col("digest").isNotNull()))


def duplicate_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Null texts are empty texts. Of equal texts the row with the smallest id stays; a null id is larger than all
    others. Of repeated rows (same id, equal texts) one stays. No rows in, no rows out. Other columns are not read.
    """
    rows = staged(docs.select(F.col(doc_id).alias("doc_id"), digest_of(text).alias("digest"),
                              F.monotonically_increasing_id().alias("row")), "digests")
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row")
    counts = [F.min(order).alias("first"), F.count("*").alias("group_size")]
    candidates = F.broadcast(frequent_digests(rows))
    winners = F.broadcast(rows.join(candidates, "digest", "left_semi").groupBy("digest").agg(*counts))
    tagged = rows.join(winners, "digest", "left")
    hot = tagged.where(F.col("group_size").isNotNull())
    cold = tagged.where(F.col("group_size").isNull()).select("doc_id", "digest", "row")
    cold = cold.join(cold.groupBy("digest").agg(*counts), "digest")
    return hot.unionByName(cold).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"), F.col("digest").alias("text_sha256"))


def drop_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the copies that :func:`duplicate_groups` does not keep, with the same columns.

    The texts are shuffled once, by id and digest. Repeated rows of a kept id are told apart only if there are any.
    """
    key, digest, copies = (fresh(n, docs.columns) for n in ("key", "digest", "copies"))
    kept = (duplicate_groups(docs, doc_id, text).where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
            .groupBy(F.col("doc_id").alias(key), F.col("text_sha256").alias(digest))
            .agg(F.count("*").alias(copies)))
    kept = staged(kept, "kept")
    named = docs.withColumn(digest, digest_of(text))
    found = named.join(kept.withColumnRenamed(digest, fresh("d2", docs.columns)),
                       F.col(doc_id).eqNullSafe(F.col(key))
                       & (F.col(digest) == F.col(fresh("d2", docs.columns))))
    if kept.where(F.col(copies) > 1).isEmpty():
        return found.select(*docs.columns)
    once = found.where(F.col(copies) == 1)
    again = found.where(F.col(copies) > 1).dropDuplicates([key, digest])
    return once.unionByName(again).select(*docs.columns)
