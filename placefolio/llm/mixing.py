"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

A source's target is ``min(cap, level * weight)``. The level at which the targets add up to the wanted total follows from
the sources in order of ``cap / weight``: the first k are full, the rest share what is left. That is one small table with a
row per source. Repetitions then follow a seeded order within the source: every document is taken ``floor(target / size)``
times, and the documents at the head of the order once more, up to the one nearest to the target. The cut is found in
buckets of the order, so that no source meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from placefolio.llm.common import fresh, n_words
from placefolio.session import staged

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SEED = "mix-1"
# Buckets of the seeded order of a source, and so the part of a source that is sorted in one task at most.
BUCKET_BITS = 16
ORDER_HEX = 12


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, epochs: int = MAX_EPOCHS,
                   share: float = 1.0) -> DataFrame:
    """``source, source_size, target`` from rows ``source, size``. One row per source.

    Sources in code point order, null last, get ``weights`` in turn. Targets add up to ``share`` of all words as far
    as the caps allow. Without any words every target is 0.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = W.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    cap = (F.col("source_size") * epochs).cast("double")
    ranked = per_source.withColumn("weight", weight).withColumn("cap", cap).withColumn("full_at", cap / F.col("weight"))
    by_level = W.orderBy("full_at", F.col("source").isNull(), "source")
    every = W.partitionBy()
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    total = F.sum("source_size").over(every) * share
    # Level of the rest if all sources before this one are full; the first that holds is the level.
    level = ((total - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    ranked = ranked.withColumn("level", level)
    level = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "level"))).over(every)["level"]
    target = F.when(F.col("full_at") <= level, F.col("cap")).otherwise(F.col("weight") * level)
    return ranked.withColumn("target", F.coalesce(target, F.col("cap"))).select("source", "source_size", "target")


def seeded_order(doc_id: Column, seed: str = SEED) -> Column:
    """48 bits of a digest of seed and id; a null id counts as the empty text."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, ORDER_HEX), 16, 10).cast("long")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[float] = WEIGHTS, epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, size, source_size, target, repeats, taken``.

    ``size`` is the number of words (null text: 0), ``repeats`` how often the document is taken, at most ``epochs``,
    and ``taken`` is ``size * repeats``. The words taken of a source differ from its target by half a document at
    most. Documents without words are taken as often as their source is as a whole. Repeated rows count each.
    """
    sizes = staged(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                               n_words(text).alias("size"), seeded_order(F.col(doc_id), seed).alias("u")), "sizes")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = (source_targets(sizes, weights, epochs).withColumn("whole", F.least(whole, F.lit(epochs)).cast("long"))
               .withColumn("need", F.col("target") - F.col("whole") * F.col("source_size")))
    targets = staged(targets, "targets")
    bucket = F.shiftright("u", 4 * ORDER_HEX - BUCKET_BITS)
    sizes = sizes.withColumn("bucket", bucket)
    # The cut is looked for among 2^(BUCKET_BITS / 2) parts of a source, and then among as many buckets of one part, so that
    # no window meets more rows than that.
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    part = F.shiftright("bucket", BUCKET_BITS // 2)
    before = lambda column: (F.coalesce(F.sum("words").over(
        W.partitionBy("source").orderBy(column).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    holds_cut = (F.col("before") <= F.col("need")) & (F.col("before") + F.col("words") > F.col("need"))
    parts = (sizes.groupBy("source", part.alias("part")).agg(F.sum("size").alias("words"))
             .withColumn("before", before("part")))
    parts = (parts.join(targets, same(parts, targets)).where(holds_cut)
             .select(targets["source"], "need", F.col("part").alias("cut_part"), F.col("before").alias("part_before")))
    parts = staged(parts, "cut-parts")
    inside = sizes.join(parts, same(sizes, parts) & (part == F.col("cut_part"))).drop(parts["source"])
    buckets = (inside.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.first("need").alias("need"),
                                                     F.first("part_before").alias("part_before"))
               .withColumn("before", F.col("part_before") + before("bucket")))
    cuts = buckets.where(holds_cut).select("source", F.col("bucket").alias("cut"), F.col("before").alias("cut_before"))
    # One row per source, stored, so that its size is known: it is broadcast if it is small, and hot sources are split if not.
    plan = staged(targets.join(cuts, same(targets, cuts), "left").drop(cuts["source"]), "mix-plan")
    rows = sizes.join(plan, same(sizes, plan), "left").drop(plan["source"])
    at_cut = rows.where(F.col("bucket") == F.col("cut"))
    within = (W.partitionBy("source").orderBy("u", F.col("doc_id").isNull(), "doc_id", "size")
              .rowsBetween(W.unboundedPreceding, -1))
    middle = F.col("cut_before") + F.coalesce(F.sum("size").over(within), F.lit(0)) + F.col("size") / F.lit(2.0)
    at_cut = at_cut.withColumn("extra", (middle <= F.col("need")).cast("long"))
    others = (rows.where(~F.col("bucket").eqNullSafe(F.col("cut")))
              .withColumn("extra", ((F.col("need") > 0) & (F.col("cut").isNull() | (F.col("bucket") < F.col("cut"))))
                          .cast("long")))
    repeats = F.col("whole") + F.col("extra")
    return (at_cut.unionByName(others).withColumn("repeats", F.least(repeats, F.lit(epochs)).cast("long"))
            .select("doc_id", "source", "size", "source_size", "target", "repeats",
                    (F.col("repeats") * F.col("size")).alias("taken")))


def mixed_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
               **options) -> DataFrame:
    """``docs`` with every row as often as the mix takes it, and the number of the repetition from 1 on.

    The new column is ``repetition``, with underscores in front if ``docs`` has one of that name. Repeated rows (same
    id, source and size) are all taken as often as the one that is taken most.
    """
    key, group, size, n = (fresh(name, docs.columns) for name in ("mix_id", "mix_source", "mix_size", "mix_repeats"))
    taken = (mix(docs, doc_id, text, source, **options).where(F.col("repeats") > 0)
             .groupBy(F.col("doc_id").alias(key), F.col("source").alias(group), F.col("size").alias(size))
             .agg(F.max("repeats").cast("int").alias(n)))
    found = docs.join(taken, F.col(doc_id).eqNullSafe(F.col(key)) & F.col(source).eqNullSafe(F.col(group))
                      & (n_words(text) == F.col(size)))
    return found.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(n))).alias(fresh("repetition", docs.columns)))
