"""Language identification by Bayesian evidence fusion.

Four kinds of evidence are multiplied: the text (naive Bayes over hashed byte 1- to 3-grams, tempered because n-grams overlap),
the language that the markup declares, the suffix of the address, and a prior of the host. The n-gram counts come from
documents with a known language. The other tables are counted over all rows, with the language that the text alone
suggests, less what the row itself adds to them: the prior of a host is smoothed towards its registered domain, that one
towards all rows. Missing evidence is left out. Rows without text, markup, address and host get the overall prior.

Null and empty texts say nothing, repeated rows count each and are judged alike, ties go to the first language in code
point order, and empty tables give no rows. Any number of languages may be trained: tables go to the workers
``LANGUAGES_AT_ONCE`` at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from placefolio.llm.common import fold, fresh
from placefolio.llm.url_filter import host_of, levels_of
from placefolio.llm.words import mix, one_array, slices
from placefolio.operators.hot_keys import hot_keys, spread_join
from placefolio.session import staged

BITS = 15
# Overlapping n-grams say the same thing again: the text counts as this share of its n-grams, and as TEXT_CAP at most.
TEMPER = 0.1
TEXT_CAP = 60.0
SMOOTH = 1.0  # of markup and suffix
HOST_STRENGTH, DOMAIN_STRENGTH = 5.0, 20.0
SLICE_BYTES = 2 << 20
# Languages whose n-gram tables a worker holds at a time: 128 KB each.
LANGUAGES_AT_ONCE = 256
# Languages counted in a task before it passes its counts on.
_COUNTED_AT_ONCE = 64
# A text's share of a language below this is not counted for markup, suffix, domain and host.
LEAST_SHARE = 1e-9


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts and the text each belongs to. Case and non-letters of ASCII are folded."""
    raw = [(t or b"").lower() for t in texts.cast(pa.binary()).to_pylist()]
    stream = np.frombuffer(b"".join(b"  " + t for t in raw) + b"  ", np.uint8).copy()
    stream[(stream < 97) | ((stream > 122) & (stream < 128))] = 32
    doc = np.append(np.repeat(np.arange(len(raw)), [len(t) + 2 for t in raw]), [-1, -1])
    three = stream[:-2].astype(np.uint64) << np.uint64(16) | stream[1:-1].astype(np.uint64) << np.uint64(8) | stream[2:]
    owner = doc[:-2]
    same = (doc[2:] == owner) & (three != np.uint64(0x202020))
    three, owner = three[same], owner[same]
    ids = [three, (three >> np.uint64(8)) | np.uint64(1 << 24), (three >> np.uint64(16)) | np.uint64(2 << 24)]
    return np.concatenate(ids), np.tile(owner, 3)


def _slots(grams: np.ndarray) -> np.ndarray:
    return (mix(grams, np.uint64(5)) >> np.uint64(64 - BITS)).astype(np.int64)


def _counter(batches):
    totals: dict[str, np.ndarray] = {}

    def counted():
        for lang, n in totals.items():
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()),
                                              pa.array(n[used], pa.int64())], ["lang", "slot", "n"])

    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            langs = np.array(part["lang"].to_pylist(), object)
            grams, owner = _grams(one_array(part["text"]))
            slots = _slots(grams)
            for lang in set(langs):
                mine = (langs == lang)[owner]
                totals[lang] = totals.get(lang, 0) + np.bincount(slots[mine], minlength=1 << BITS)
                if len(totals) > _COUNTED_AT_ONCE:
                    yield from counted()
                    totals.clear()
    yield from counted()


def train_text(labelled: DataFrame) -> tuple[list[str], DataFrame]:
    """Languages, and the counts ``lang, slot, n`` of their n-grams, from rows ``text, lang``. Null languages are left out."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    counts = rows.mapInArrow(_counter, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    counts = staged(counts, "grams")
    return sorted(r["lang"] for r in rows.select("lang").distinct().collect()), counts


def log_table(langs: list[str], counts: DataFrame) -> np.ndarray:
    """Log probability of each slot in each of some languages."""
    found = counts.where(F.col("lang").isin(langs)).toPandas()
    table = np.full((len(langs), 1 << BITS), 0.5)
    table[np.searchsorted(langs, found["lang"].to_numpy(str)), found["slot"].to_numpy(int)] += found["n"].to_numpy(int)
    return np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def text_evidence(rows: DataFrame, langs: list[str], counts: DataFrame, text: str = "text", name: str = "ll") -> DataFrame:
    """``rows`` with ``text`` replaced by ``name``: a log likelihood for each of ``langs``, 0 at the likeliest."""
    out = fresh("sums", rows.columns)
    keep = [c for c in rows.columns if c != text]
    parts = [langs[i:i + LANGUAGES_AT_ONCE] for i in range(0, len(langs), LANGUAGES_AT_ONCE)]

    def scored(df: DataFrame, some: list[str], first: bool, last: bool) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(log_table(some, counts))
        kept = keep if last else [text, *keep]

        def run(batches):
            for batch in batches:
                for part in slices(batch, text, SLICE_BYTES):
                    grams, owner = _grams(one_array(part[text]))
                    slots = _slots(grams)
                    sums = np.stack([np.bincount(owner, lang[slots], part.num_rows) for lang in shared.value], axis=1) * TEMPER
                    if not first:
                        before = np.frombuffer(b"".join(part[out].to_pylist())).reshape(part.num_rows, -1)
                        sums = np.concatenate([before, sums], axis=1)
                    if last:
                        sums = np.maximum(sums - sums.max(axis=1, keepdims=True), -TEXT_CAP)
                        column = pa.FixedSizeListArray.from_arrays(pa.array(sums.ravel()), sums.shape[1]).cast(pa.list_(pa.float64()))
                    else:
                        column = pa.array([r.tobytes() for r in sums], pa.binary())
                    yield from part.select(kept).append_column(name if last else out, column).combine_chunks().to_batches()

        fields = [f for f in rows.schema.fields if f.name in kept]
        fields.sort(key=lambda f: kept.index(f.name))
        added = T.StructField(name, T.ArrayType(T.DoubleType())) if last else T.StructField(out, T.BinaryType())
        return df.mapInArrow(run, T.StructType([*fields, added]))

    for k, some in enumerate(parts):
        rows = scored(rows, some, k == 0, k == len(parts) - 1)
        if k < len(parts) - 1:
            rows = staged(rows, "text-sums")
    return rows


def declared_language(html: Column) -> Column:
    """First part of the language that the ``html`` tag declares, in lower case; null if there is none."""
    found = F.lower(F.regexp_extract(html, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([a-z]+)""", 1))
    return F.when(found != "", found)


def visible_text(html: Column) -> Column:
    """Text between the tags, roughly: scripts, styles, comments, tags and entities become blanks."""
    return F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[#\w]+;", " ")


def page_rows(pages: DataFrame) -> DataFrame:
    """``text, declared, host, domain, suffix`` (and ``id``) of pages with ``page_id, url, html``."""
    host = F.nullif(host_of(F.col("url")), F.lit(""))
    rows = pages.select(F.col("page_id").alias("id"), visible_text(F.col("html")).alias("text"),
                        declared_language(F.col("html")).alias("declared"), host.alias("host"))
    domain, suffix = levels_of(F.col("host"))
    return rows.withColumns({"domain": domain, "suffix": suffix})


def _shares(rows: DataFrame, key: str, soft: str, name: str) -> DataFrame:
    """``key`` and ``name``, a map from the number of a language to the rows the texts of the key suggest for it."""
    each = rows.where(F.col(key).isNotNull()).select(key, F.posexplode(soft).alias("_lang", "_share")).where(F.col("_share") >= LEAST_SHARE)
    # As many entries as there are languages at most.
    return (each.groupBy(key, "_lang").agg(F.sum("_share").alias("_n")).groupBy(key)
            .agg(F.map_from_entries(F.collect_list(F.struct("_lang", "_n"))).alias(name)))


def identify(rows: DataFrame, langs: list[str], counts: DataFrame) -> DataFrame:
    """``rows`` without ``text``, with ``lang``, its ``posterior`` and ``text_lang`` (the text alone).

    ``rows`` has ``text, declared, host, domain, suffix``, all of which may be null, and any other columns; those named
    like a new one are replaced. Ties go to the first language in code point order. Without trained languages all three
    new columns are null.
    """
    new = ("lang", "posterior", "text_lang")
    kept = [c for c in rows.columns if c != "text" and c.lower() not in new]
    rows = rows.select("text", *kept)
    if not langs:
        null = F.lit(None)
        return rows.drop("text").withColumns({"lang": null.cast("string"), "posterior": null.cast("double"),
                                              "text_lang": null.cast("string")})
    n, keys = len(langs), ("declared", "suffix", "domain", "host")
    taken = [*rows.columns, "_lang", "_share", "_n", "_salt", "_copies"]
    ll, soft, logs = (fresh(c, taken) for c in ("ll", "soft", "logs"))
    count_of = {key: fresh(f"{key}_n", taken) for key in keys}
    chance = {key: fresh(f"{key}_p", taken) for key in keys}
    seen = text_evidence(rows, langs, counts, name=ll)
    weight = F.transform(ll, lambda x: F.exp(x))
    total = F.aggregate(weight, F.lit(0.0), lambda a, x: a + x)
    evidence = seen = staged(seen.withColumn(soft, F.transform(weight, lambda x: x / total)), "evidence")
    # One number per language.
    sums = dict(seen.select(F.posexplode(soft).alias("_lang", "_share")).groupBy("_lang").agg(F.sum("_share")).collect())
    scale = sum(sums.values()) + n
    overall = F.array(*[F.lit((sums.get(i, 0.0) + 1) / scale) for i in range(n)])
    for key in keys:
        shares = _shares(evidence, key, soft, count_of[key])
        seen = spread_join(seen, shares, [key], hot_keys(evidence, key), "left")
        # Less the row's own share: evidence must not be its own echo.
        other = lambda x, i: F.greatest(F.coalesce(F.element_at(F.col(count_of[key]), i), F.lit(0.0)) - x, F.lit(0.0))  # noqa: E731,B023
        own = F.transform(soft, other)
        seen = seen.withColumn(count_of[key], F.when(F.col(count_of[key]).isNull(), F.transform(soft, lambda x: F.lit(0.0))).otherwise(own))

    def smoothed(counted: str, prior: Column, strength: float) -> Column:
        every = F.aggregate(counted, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(counted, prior, lambda c, p: (c + strength * p) / (every + strength))

    seen = seen.withColumn(chance["domain"], smoothed(count_of["domain"], overall, DOMAIN_STRENGTH))
    seen = seen.withColumn(chance["host"], smoothed(count_of["host"], F.col(chance["domain"]), HOST_STRENGTH))
    for key in ("declared", "suffix"):
        # Likelihood of the value in each language, up to a factor: the language's share of the rows with the value.
        seen = seen.withColumn(chance[key], F.zip_with(smoothed(count_of[key], overall, SMOOTH), overall, lambda a, b: a / b))
    both = F.zip_with(chance["declared"], chance["suffix"], lambda a, b: F.log(a) + F.log(b))
    of_host = F.zip_with(chance["host"], both, lambda a, b: F.log(a) + b)
    seen = seen.withColumn(logs, F.zip_with(ll, of_host, lambda a, b: a + b))
    names = F.array(*map(F.lit, langs))
    best = F.array_max(logs)
    posterior = 1 / F.aggregate(F.transform(logs, lambda x: F.exp(x - best)), F.lit(0.0), lambda a, x: a + x)
    pick = lambda c: F.get(names, (F.array_position(c, F.array_max(c)) - 1).cast("int"))
    return seen.select(*kept, pick(logs).alias("lang"), posterior.alias("posterior"), pick(ll).alias("text_lang"))


def identify_corpus(docs: DataFrame, pages: DataFrame, folds: int = 5) -> DataFrame:
    """Every document and every page: ``kind, doc_id, page_id, held_out, lang, posterior, text_lang``.

    The text model learns from documents with a language outside fold 0. A document has neither markup nor address;
    its source takes the place of the host. Null texts, sources, urls and pages are missing evidence; repeated rows stay;
    an empty table adds no rows; without documents that have a language all languages are null.
    """
    langs, counts = train_text(docs.where(fold("doc_id", folds) != 0))
    null = F.lit(None).cast("string")
    rows = docs.select(F.lit("document").alias("kind"), F.col("doc_id"), F.lit(None).cast("long").alias("page_id"),
                       (fold("doc_id", folds) == 0).alias("held_out"), "text", null.alias("declared"),
                       F.concat(F.lit("source:"), "source").alias("host"), null.alias("domain"), null.alias("suffix"))
    found = page_rows(pages).select(F.lit("page").alias("kind"), F.lit(None).cast("long").alias("doc_id"),
                                    F.col("id").alias("page_id"), F.lit(True).alias("held_out"), "text", "declared",
                                    "host", "domain", "suffix")
    return identify(rows.unionByName(found), langs, counts).select(
        "kind", "doc_id", "page_id", "held_out", "lang", "posterior", "text_lang")
