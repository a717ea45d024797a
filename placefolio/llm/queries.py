"""One query per operator, over the whole of its table."""

from __future__ import annotations

import re
import uuid
from pathlib import Path

from pyspark.sql import functions as F

from placefolio.llm import (decontaminate, exact_dedup, language, lm_score, mixing, near_dedup, negatives, packing, quality,
                            substring_dedup, url_filter, warc, whitening)
from placefolio.llm.common import table
from placefolio.session import shared_folder


def op1_exact_dedup(spark, sf):
    return exact_dedup.duplicate_groups(table(spark, sf, "documents"))


def op2_minhash_near_dedup(spark, sf):
    return near_dedup.near_duplicates(table(spark, sf, "documents"))


def op3_language_id(spark, sf):
    return language.identify_corpus(table(spark, sf, "documents"), table(spark, sf, "pages"))


def op4_quality_classifier(spark, sf):
    return quality.score_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op5_lm_scoring(spark, sf):
    return lm_score.score_documents(table(spark, sf, "documents"), lambda ids: lm_score.in_fold(ids, 7, 2))


def op6_source_mixing(spark, sf):
    return mixing.mix(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_substring_dedup(spark, sf):
    found = substring_dedup.remove_repeats(table(spark, sf, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256)
                        .alias("kept_sha256"))


def page_outcomes(pages, labels):
    """``host, bad`` of every page. A page shows the document whose number is in its path; it is bad if that document is
    of low quality or toxic, and without an outcome if there is no label."""
    number = F.regexp_extract(url_filter.path_of(F.col("url")), r"/(\d{1,18})\b", 1)
    shown = pages.select(url_filter.host_of(F.col("url")).alias("host"),
                         F.nullif(number, F.lit("")).cast("long").alias("shown"))
    bad = (F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))).cast("long")
    outcomes = (labels.where(F.col("quality").isNotNull() | F.col("toxic").isNotNull())
                .groupBy(F.col("doc_id").alias("shown")).agg(F.max(bad).alias("bad")))
    return shown.join(outcomes, "shown", "left").select("host", "bad")


def op8_url_filter(spark, sf):
    pages = table(spark, sf, "pages")
    outcomes = page_outcomes(pages, table(spark, sf, "labels"))
    return url_filter.judge_urls(pages.select("page_id", "url"), outcomes).select(
        "page_id", "host", "path", "rule", "verdict")


def op9_decontamination(spark, sf):
    return decontaminate.judge_documents(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op10_warc(spark, sf):
    path = f"{shared_folder(spark)}/placefolio/warc-{uuid.uuid4().hex}"
    warc.write_archives(table(spark, sf, "pages"), path)
    return warc.read_archives(spark, path).select(
        "page_id", "payload_bytes", F.coalesce(F.sha2("payload", 256), "record_digest").alias("payload_digest"),
        "record_type", "refers_to")


def op11_embedding_whitening(spark, sf):
    return whitening.component_rows(table(spark, sf, "embeddings").select("vec_id", "embedding"), 4)


def op12_packing(spark, sf):
    import public_tokenizers
    packed = packing.pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op13_hard_negatives(spark, sf):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, label=moved)


QUERIES = {fn.__name__: fn for fn in (
    op1_exact_dedup, op2_minhash_near_dedup, op3_language_id, op4_quality_classifier, op5_lm_scoring, op6_source_mixing,
    op7_substring_dedup, op8_url_filter, op9_decontamination, op10_warc, op11_embedding_whitening, op12_packing,
    op13_hard_negatives)}


def oracle_sql() -> dict[str, str]:
    text = (Path(__file__).parent / "oracles.sql").read_text(encoding="utf-8")
    parts = re.split(r"^-- name: (\w+)\s*$", text, flags=re.M)
    return {name: body.strip().rstrip(";") for name, body in zip(parts[1::2], parts[2::2])}
