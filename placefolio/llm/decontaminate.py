"""Benchmark decontamination with spaced seeds.

Words are runs of letters and digits, lower-cased. A mask keeps some words of a short span and ignores the others, so two
texts that differ in an ignored word still have the seed in common. Seeds of the benchmark are joined to the seeds of the
documents; around every hit the two texts are aligned and compared word by word. A document is contaminated if some
``WINDOW`` aligned words (the whole item, if it is shorter) differ in at most ``SUBSTITUTIONS``. The two masks hit every such
window of 13 words, wherever the three substitutions are (``tests/llm`` tries all). Shorter items get runs of words instead: of
``allowed + 1`` parts of an item one is always without a substitution. Items of one word count. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from placefolio.llm.common import fresh, text_of

MASKS = ("11101", "110011")
WINDOW = 13
SUBSTITUTIONS = 3
# A seed takes some 50 bytes; up to this many are broadcast, more are joined by shuffling.
MAX_BROADCAST_SEEDS = 1_000_000


def word_hashes(column: str) -> Column:
    """64-bit hashes of the words of the whole text."""
    found = F.regexp_extract_all(F.lower(text_of(column)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.transform(found, lambda w: F.xxhash64(w))


def _seed(words: Column, at: Column, mask: str, number: int) -> Column:
    picked = [F.get(words, at + i) for i, keep in enumerate(mask) if keep == "1"]
    return F.when(at + len(mask) <= F.size(words), F.xxhash64(F.lit(number), *picked))


def run_of(n: int, window: int, substitutions: int) -> int:
    """Length of a run that an item of ``n < window`` words still has after all allowed substitutions."""
    return n // (n * substitutions // window + 1)


def seed_masks(items: DataFrame, masks: Sequence[str], window: int, substitutions: int) -> list[tuple[str, list[int] | None]]:
    """Masks and the lengths of the items they are for; ``None`` are all from ``window`` on. Runs only if there are such items."""
    size = F.size("item_words")
    short = sorted(r["n"] for r in items.where(size < window).select(size.alias("n")).distinct().collect())
    runs: dict[int, list[int]] = {}
    for n in short:
        runs.setdefault(run_of(n, window, substitutions), []).append(n)
    return [(mask, None) for mask in masks] + [("1" * w, lengths) for w, lengths in runs.items()]


def benchmark_seeds(items: DataFrame, masks: Sequence[tuple[str, list[int] | None]], window: int) -> DataFrame:
    """``mask, seed, found``: the places ``(item, at, before)`` of every seed, where ``before`` is the seed one word earlier.
    A list is as long as the benchmark at most."""
    every, size = None, F.size("item_words")
    for number, (mask, lengths) in enumerate(masks):
        own = items.where(size >= window if lengths is None else size.isin(lengths))
        at = own.select("item", "item_words", F.posexplode("item_words").alias("at", "word"))
        before = F.when(F.col("at") > 0, _seed(F.col("item_words"), F.col("at") - 1, mask, number)).alias("before")
        rows = at.select(F.lit(number).alias("mask"), _seed(F.col("item_words"), F.col("at"), mask, number).alias("seed"),
                         F.struct("item", "at", before).alias("place")).where(F.col("seed").isNotNull())
        every = rows if every is None else every.unionByName(rows)
    return every.groupBy("mask", "seed").agg(F.collect_list("place").alias("found"))


def _overlaps(window: int, substitutions: int) -> Column:
    """Whether the alignment of document and item words at ``shift`` has a window with few enough differences."""
    same = F.transform(F.col("item_words"), lambda w, k: F.when(F.get(F.col("words"), F.col("shift") + k) == w, 1)
                       .otherwise(0))
    n = F.least(F.lit(window), F.size("item_words"))
    allowed = F.floor(n * substitutions / F.lit(window))
    starts = F.sequence(F.lit(1), F.size("item_words") - n + 1)
    enough = F.exists(starts, lambda s: F.aggregate(F.slice(F.col("same"), s, n), F.lit(0), lambda a, x: a + x)
                      >= n - allowed)
    return same, enough


def _run_starts(found: Column, mask: str, number: int) -> Column:
    """Places of a hit that do not go on from a hit one word earlier: that one has the same alignment and is verified for all."""
    before = F.when(F.col("pos") > 0, _seed(F.col("words"), F.col("pos") - 1, mask, number))
    return F.filter(found, lambda place: ~F.coalesce(place["before"] == before, F.lit(False)))


def contaminated_items(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       item_id: str = "item_id", item_text: str = "text", masks: Sequence[str] = MASKS,
                       window: int = WINDOW, substitutions: int = SUBSTITUTIONS,
                       max_broadcast: int = MAX_BROADCAST_SEEDS) -> DataFrame:
    """``doc_id, text_hash, item_id``: each item that a document overlaps, once.

    Null and empty texts, on either side, overlap nothing; items of one word or more are all looked for. Rows with
    the same id and text are one document; a null id is an id of its own, of documents and of items.
    """
    items = (benchmark.select(F.col(item_id).alias("item"), word_hashes(item_text).alias("item_words"))
             .where(F.size("item_words") > 0).distinct())
    every_mask = seed_masks(items, masks, window, substitutions)
    seeds, masks = benchmark_seeds(items, every_mask, window), [mask for mask, _ in every_mask]
    small = (seeds.agg(F.coalesce(F.sum(F.size("found")), F.lit(0)).alias("n")).first()["n"] <= max_broadcast)
    hint = F.broadcast if small else (lambda df: df)
    words = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(text_of(text)).alias("text_hash"),
                        word_hashes(text).alias("words"))
    # Below the bound the words ride along; above it only seeds are shuffled and the words are joined to the hits.
    carried = ["doc", "text_hash"] + (["words"] if small else [])
    at = words.select("doc", "text_hash", "words", F.posexplode("words").alias("pos", "word"))
    at = at.select(*carried, "pos", *[_seed(F.col("words"), F.col("pos"), mask, n).alias(f"seed{n}")
                                      for n, mask in enumerate(masks)])
    if small:
        for n in range(len(masks)):
            own = seeds.where(F.col("mask") == n).select(F.col("seed").alias(f"seed{n}"), F.col("found").alias(f"found{n}"))
            at = at.join(hint(own), f"seed{n}", "left")
        lists = [F.col(f"found{n}") for n in range(len(masks))]
        hits = at.where(F.coalesce(*lists).isNotNull())
        starts = [_run_starts(found, mask, n) for n, (mask, found) in enumerate(zip(masks, lists))]
        places = F.flatten(F.filter(F.array(*starts), lambda x: x.isNotNull()))
        hits = hits.select(*carried, "pos", F.explode(places).alias("place"))
    else:
        hits = None
        for n in range(len(masks)):
            own = seeds.where(F.col("mask") == n).select(F.col("seed").alias(f"seed{n}"), "found")
            part = (at.join(own, f"seed{n}").select(*carried, "pos", F.explode("found").alias("place")))
            hits = part if hits is None else hits.unionByName(part)
    hits = hits.select(*carried, F.col("place.item").alias("item"), (F.col("pos") - F.col("place.at")).alias("shift"))
    if not small:
        hits = hits.distinct().join(words.withColumnsRenamed({"doc": "d2", "text_hash": "t2"}),
                                    F.col("doc").eqNullSafe(F.col("d2")) & (F.col("text_hash") == F.col("t2")))
    whole = items.withColumnRenamed("item", "own_item")
    hits = hits.join(hint(whole), F.col("item").eqNullSafe(F.col("own_item"))).drop("own_item")
    same, enough = _overlaps(window, substitutions)
    return (hits.withColumn("same", same).where(enough)
            .select(F.col("doc").alias("doc_id"), "text_hash", F.col("item").alias("item_id")).distinct())


def judge_documents(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    **options) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, contaminated, n_items, item_ids`` (sorted; empty for clean documents).

    A null item id is counted and listed as null, in front.
    """
    found = contaminated_items(docs, benchmark, doc_id, text, **options)
    per_doc = (found.groupBy(F.col("doc_id").alias("d2"), F.col("text_hash").alias("t2"))
               # In structs, as a list leaves nulls out.
               .agg(F.sort_array(F.collect_list(F.struct("item_id"))).getField("item_id").alias("item_ids")))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text_of(text)).alias("text_hash"))
    judged = rows.join(per_doc, F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("text_hash") == F.col("t2")), "left")
    n = F.coalesce(F.size("item_ids"), F.lit(0))
    return judged.select("doc_id", F.col("item_ids").isNotNull().alias("contaminated"),
                         F.when(F.col("item_ids").isNull(), 0).otherwise(n).cast("long").alias("n_items"),
                         F.coalesce("item_ids", F.array().cast(per_doc.schema["item_ids"].dataType)).alias("item_ids"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      **options) -> DataFrame:
    """``docs`` without the contaminated documents, with the same columns."""
    key, digest = fresh("bad_id", docs.columns), fresh("bad_text", docs.columns)
    bad = (contaminated_items(docs, benchmark, doc_id, text, **options)
           .select(F.col("doc_id").alias(key), F.col("text_hash").alias(digest)).distinct())
    return docs.join(bad, F.col(doc_id).eqNullSafe(F.col(key)) & (F.xxhash64(text_of(text)) == F.col(digest)),
                     "left_anti")
