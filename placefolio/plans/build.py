"""The whole run: recorded search pages and fetches -> the five tables and a summary."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from placefolio import schemas
from placefolio.functions.text import object_key
from placefolio.operators import discover, extraction, fetches, items, reports, robots, status
from placefolio.operators.hot_keys import join_on_unique
from placefolio.params import RunParams
from placefolio.session import staged, staging
from placefolio.sources.folders import delete
from placefolio.sources.objects import latest_files, new_files, place_objects
from placefolio.sources.tables import append_rows, drop_table, repeated_keys, replace_keys, table_state, write_table

# Names of the stored tables.
BRONZE, SILVER, DOCUMENTS, ITEMS, CATALOGUE = (
    "restaurants_bronze", "restaurants_silver", "menu_documents", "menu_items", "restaurants")
OBJECTS = "raw_objects"
CALL_ERRORS = "call_errors"


# Answers kept over runs, and files parsed by runs that begin with stored objects.
ANSWERS = "extraction_answers"
PARSED_OBJECTS = "parsed_objects"
REJECTS = "response_rejects"
ALL_TABLES = (BRONZE, SILVER, DOCUMENTS, ITEMS, CATALOGUE, CALL_ERRORS, OBJECTS, ANSWERS, PARSED_OBJECTS, REJECTS)

SOURCE_TEXTS = "source-texts"
_shown: dict[str, str | None] = {}


def pdf_log(fetch_log: DataFrame) -> DataFrame:
    """Log rows that can be documents; the test on type and URL keeps all other bodies out of the parser."""
    return fetch_log.where(fetches.is_pdf(F.col("url"), F.col("content_type"))
                           & fetches.is_fetched(F.col("http_status"), F.col("error")))


def build_catalogue(spark: SparkSession, search_pages: DataFrame, fetch_log: DataFrame, rules: DataFrame,
                    namespace: str, params: RunParams = RunParams(),
                    parse_fn: Callable[[bytes], dict] = extraction.utf8_parser,
                    extract_fn: Callable[[str], str] = extraction.rule_extractor,
                    location: str | None = None, keep_objects: bool = False,
                    call_partitions: int | None = None, rule_answers: DataFrame | None = None,
                    objects: str | None = None) -> DataFrame:
    """Write the tables of one run into ``namespace`` and return the one-row summary.

    ``keep_objects`` also stores the fetched bytes per place. It is off because the fetch log holds them already
    and this is the only step that moves whole bodies between executors. ``call_partitions`` is the number of
    tasks for document parser and extraction function. ``rule_answers`` are ``(robots_url, http_status)`` of sites
    whose rules could not be read. ``objects`` names a folder of stored documents (``…/raw/<place_id>/<file>``): texts
    of documents then come from its files, and only files that no run has parsed yet are read.
    A fetch log with retries has ``attempt_no``.

    With ``params.reset_tables`` all tables and their folders are dropped before the run begins. With ``params.upsert``
    the places this run finds are its scope: what the tables hold of them becomes what this run gives for them, nothing
    if that is nothing, and all other places keep their rows and files. A place that is not found stays as it was.

    Every stage reads what the one before has written, so no costly call (document parser, extraction
    function) runs twice, and a lost executor never reaches back beyond its own stage. What is staged in between is
    deleted at the end, but for the texts of the view ``menu_source_text``, which last until the next run.
    """
    if params.reset_tables:
        for name in ALL_TABLES:
            drop_table(spark, f"{namespace}.{name}", purge=True)
    with staging(spark, keep=(SOURCE_TEXTS,)):
        return _build(spark, search_pages, fetch_log, rules, namespace, params, parse_fn, extract_fn, location, keep_objects,
                      call_partitions, rule_answers, objects)


def _build(spark, search_pages, fetch_log, rules, namespace, params, parse_fn, extract_fn, location, keep_objects,
           call_partitions, rule_answers, objects) -> DataFrame:
    def stored(name: str) -> tuple[str, str | None]:
        return f"{namespace}.{name}", f"{location}/{name}" if location else None

    def save(df: DataFrame, name: str, unique: bool = True, counts: list[Column] | None = None) -> DataFrame:
        """Write a table by place and return the rows of this run as they were stored. ``counts`` are taken on the way if the
        table is written as a whole."""
        table, path = stored(name)
        if unique:
            df = staged(df, name)
            if not repeated_keys(df, "place_id").isEmpty():
                raise ValueError(f"{name}: more than one row for a place_id")
        if params.upsert and table_state(spark, table):
            return replace_keys(df, table, scope, params.keep_versions).join(scope, "place_id", "left_semi")
        if counts:
            taken[name] = Observation()
        return write_table(df, table, path, "place_id", params.table_buckets, params.keep_versions,
                           (taken[name], counts) if counts else None)

    taken: dict[str, Observation] = {}
    if rule_answers is not None:
        rules = rules.unionByName(robots.rules_from_answers(rule_answers))
    if params.search_queries:
        search_pages = discover.number_queries(search_pages, params.search_queries)
    found = staged(discover.discover(search_pages, params.target_count, params.max_pages_per_query), "found")
    scope = found.select("place_id")
    save(found.select("place_id", "raw_json", F.current_timestamp().alias("ingested_at")), BRONZE)
    places = discover.flatten_places(found.drop("place_id"))
    silver = save(places.select(*schemas.SILVER.fieldNames()), SILVER)

    # The order of discovery is not part of the silver table, so the queue is taken from the staged rows.
    queue = fetches.fetch_queue(places, [*discover.DISCOVERY_ORDER, "place_id"], params.max_sites)
    documents = save(fetches.fetch_outcomes(queue, fetch_log, rules, params), DOCUMENTS)
    if keep_objects:
        save(place_objects(queue, documents, fetch_log, params.object_root, params.max_bytes), OBJECTS, unique=False)

    of_documents, failed_documents = (
        _texts_of_objects(spark, documents, objects, *stored(PARSED_OBJECTS), parse_fn, call_partitions, params) if objects else
        _texts_of_log(documents, fetch_log, parse_fn, call_partitions, params))
    texts = staged(extraction.source_texts(extraction.html_texts(documents), of_documents, params.min_text_chars), SOURCE_TEXTS)
    _show_texts(texts)
    responses = staged(_responses(spark, texts, *stored(ANSWERS), extract_fn, call_partitions, params), "responses")
    item_table = save(items.items_from_responses(responses, params.currency), ITEMS, unique=False,
                      counts=[F.count(F.lit(1)).alias("menu_items")])

    if params.keep_rejects:
        # A failed call has no answer; it is among the call errors.
        save(extraction.response_rejects(responses.where(F.col("error").isNull())), REJECTS, unique=False)
    failed = (failed_documents.select(F.lit("document").alias("stage"), "place_id", "source_url", "error")
              .unionByName(responses.select(F.lit("extraction").alias("stage"), "place_id", "source_url", "error")))
    save(failed.where(F.col("error").isNotNull()), CALL_ERRORS, unique=False)
    save(status.place_status(silver, item_table, documents), CATALOGUE, counts=reports.summary_counts())
    if len(taken) == 2:
        return reports.summary_of_counts(spark, taken[CATALOGUE].get, taken[ITEMS].get["menu_items"])
    # An upsert writes a part of the tables, so all of them is counted.
    return reports.run_summary(spark.table(stored(CATALOGUE)[0]), spark.table(stored(ITEMS)[0]))


def _show_texts(texts: DataFrame) -> None:
    """Put the view over the texts of this run, and delete those of the run before in this session."""
    spark = texts.sparkSession
    folder = texts.inputFiles()[0].rpartition("/")[0] if texts.inputFiles() else None
    before = _shown.get(spark.sparkContext.applicationId)
    texts.createOrReplaceTempView("menu_source_text")
    _shown[spark.sparkContext.applicationId] = folder
    if before:
        delete(spark, before)


def _texts_of_log(documents, fetch_log, parse_fn, call_partitions, params) -> tuple[DataFrame, DataFrame]:
    """Texts of the documents chosen for a place, parsed once per URL from the log, and what failed."""
    chosen = documents.where("doc_type = 'pdf'").select(F.col("source_url").alias("url")).distinct()
    wanted = pdf_log(fetches.asked_rows(fetch_log, chosen)).select(F.col("url").alias("path"), "content")
    parsed = staged(extraction.parse_documents(wanted, parse_fn, call_partitions, params.max_text_chars, params.call_attempts)
                    .withColumnRenamed("path", "url"), "parsed-documents")
    errors = parsed.where(F.col("error").isNotNull()).select(F.col("url").alias("source_url"), "error")
    failed = join_on_unique(documents.where("doc_type = 'pdf'").select("place_id", "source_url"), errors, "source_url")
    return extraction.pdf_texts_by_url(documents, parsed), failed


def _texts_of_objects(spark, documents, folder, table, path, parse_fn, call_partitions, params) -> tuple[DataFrame, DataFrame]:
    """The same from stored files, joined by the path they share with the documents. Files parsed before are not read."""
    known = spark.table(table) if table_state(spark, table) else None
    fresh = new_files(spark, folder, known, "*.pdf")
    key = F.to_json(F.struct("path", F.unix_micros("modificationTime").alias("t"), "length"))
    parsed = extraction.parse_documents(fresh.select(key.alias("path"), "content"), parse_fn, call_partitions,
                                        params.max_text_chars, params.call_attempts)
    part = F.from_json("path", "path STRING, t BIGINT, length BIGINT")
    append_rows(parsed.withColumn("_k", part).select("_k.path", F.timestamp_micros("_k.t").alias("modificationTime"), "_k.length",
                                                     "source_text", "error"), table, path, params.keep_versions)
    objects = staged(latest_files(spark.table(table)).select("path", "source_text", "error"), "parsed-objects")
    of_documents = documents.where("doc_type = 'pdf'").select("place_id", "source_url", object_key(F.col("stored_path")).alias("key"))
    errors = objects.where(F.col("error").isNotNull()).select(object_key(F.col("path")).alias("key"), "error")
    return extraction.pdf_texts(documents, objects), of_documents.join(errors, "key")


def _responses(spark, texts, table, path, extract_fn, call_partitions, params) -> DataFrame:
    """Answers for all texts; with ``params.answers_of`` those that an earlier run got are taken from the table."""
    label = params.answers_of
    ask = lambda known: extraction.new_answers(texts, extract_fn, call_partitions, label=label, known=known,
                                               attempts=params.call_attempts)
    if not label:
        return extraction.with_answers(texts, ask(None))
    known = spark.table(table) if table_state(spark, table) else None
    asked = staged(ask(known), "answers")
    # Failed calls are not kept, so the next run tries them again.
    kept = append_rows(asked.where(F.col("error").isNull()).select("answer_key", "menu_json"), table, path, params.keep_versions)
    failed = asked.where(F.col("error").isNotNull())
    return extraction.with_answers(texts, kept.withColumn("error", F.lit(None).cast("string")).unionByName(failed), label=label)
