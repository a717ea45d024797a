"""Recorded fetches -> one document row per place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from placefolio import schemas
from placefolio.functions.html import html_parts
from placefolio.functions.text import first_bytes, first_chars, object_path, slug
from placefolio.functions.urls import is_pdf_url
from placefolio.operators.hot_keys import join_on_unique
from placefolio.operators.links import explode_links, link_candidates, resolve_links
from placefolio.operators.robots import with_permission
from placefolio.operators.topn import first_rows
from placefolio.params import DEFAULT_SITE_CAP, MAX_NOTE_CHARS, MIN_TEXT_CHARS, RunParams
from placefolio.session import staged

# The notes of a document row.
NOTE_DISALLOWED = "homepage disallowed"
NOTE_HOMEPAGE = "homepage fallback"
NOTE_NOTHING = "no menu link / thin homepage (likely JS widget)"

NOTE_NOT_RECORDED = "NotRecorded: no response in the fetch log"
HOMEPAGE_FILE = "homepage.html"
# URLs that are looked up by a filter instead of a join.
MAX_LITERALS = 1000


def fetch_queue(places: DataFrame, order: list[str], cap: int | None = DEFAULT_SITE_CAP) -> DataFrame:
    """First ``cap`` places with a website, in discovery order. A blank website is none."""
    return first_rows(places.where(F.coalesce("website_uri", F.lit("")) != ""), order, cap)


# -- one visit -------------------------------------------------------------------------------------------

def is_fetched(http_status: Column, error: Column) -> Column:
    return error.isNull() & http_status.isNotNull() & (http_status < 400)


def is_pdf(url: Column, content_type: Column) -> Column:
    return F.contains(F.coalesce(content_type, F.lit("")), F.lit("pdf")) | is_pdf_url(url)


def is_page(url: Column, content_type: Column) -> Column:
    """Not a PDF, and of a page's type or of none."""
    kind = F.coalesce(content_type, F.lit(""))
    return ~is_pdf(url, content_type) & (F.contains(kind, F.lit("html")) | (kind == ""))


def content_kind(url: Column, content_type: Column, n_chars: Column, min_chars: int = MIN_TEXT_CHARS) -> Column:
    """``pdf``, ``html``, or null for what is no use: another type, or a page with too little text."""
    return (F.when(is_pdf(url, content_type), "pdf")
            .when(is_page(url, content_type) & (n_chars > min_chars), "html"))


def best_candidate(min_chars: int) -> Column:
    """The visit if it is a candidate that was allowed, fetched and is of use; the smallest by rank is the best."""
    kind = content_kind(F.col("url"), F.col("content_type"), F.col("n_chars"), min_chars)
    useful = ((F.col("rank") > 0) & F.col("robots_allowed")
              & is_fetched(F.col("http_status"), F.col("error")) & kind.isNotNull())
    return F.when(useful, F.struct("rank", "url", kind.alias("kind"), "http_status", "content_type", "n_chars"))


def first_success(visits: DataFrame, min_chars: int = MIN_TEXT_CHARS) -> DataFrame:
    """Best visited candidate per site; those before it that are of no use leave no trace.

    ``(site_url, rank, url, robots_allowed, http_status, error, content_type, n_chars)`` ->
    ``(site_url, rank, url, kind, http_status, content_type, n_chars)``.
    """
    return (visits.groupBy("site_url").agg(F.min(best_candidate(min_chars)).alias("_best"))
            .where(F.col("_best").isNotNull()).select("site_url", "_best.*"))


def short_error(error: Column) -> Column:
    """``Type: message`` with the message cut to the note length."""
    return F.regexp_extract(error, rf"(?s)^((?:[A-Za-z_.]+: )?.{{0,{MAX_NOTE_CHARS}}})", 1)


# -- the whole fetch stage -------------------------------------------------------------------------------

def parse_log(fetch_log: DataFrame, params: RunParams = RunParams()) -> DataFrame:
    """``(url, http_status, error, content_type, content)`` -> ``n_chars``, ``text`` and ``links`` for ``content``.

    A map-only pass. ``n_chars`` is the length of the whole text, ``text`` is cut to the text limit.
    """
    parsed = fetch_log.withColumn("_parts", html_parts(first_bytes(F.col("content"), params.max_bytes)))
    return parsed.select("url", F.col("http_status").cast("int").alias("http_status"), "error", "content_type",
                         F.length("_parts.text").alias("n_chars"),
                         first_chars(F.col("_parts.text"), params.max_text_chars).alias("text"),
                         F.col("_parts.links").alias("links"))


def latest_attempts(fetch_log: DataFrame) -> DataFrame:
    """The attempt that counts for each URL of a log with retries (``attempt_no``): the last success, else the last try.

    A log without ``attempt_no`` has one row per URL and is returned as it is. The choice is an aggregate on one number, so
    it needs neither sorting nor bodies. Attempts with the same number are settled by their content; those without a number
    come before all others. Rows without a URL are dropped.
    """
    if "attempt_no" not in fetch_log.columns:
        return fetch_log
    # A success outweighs every number of tries.
    weight = (F.coalesce(F.col("attempt_no").cast("long"), F.lit(-1))
              + F.when(is_fetched(F.col("http_status"), F.col("error")), F.lit(1 << 61)).otherwise(F.lit(0)))
    tries = fetch_log.where(F.col("url").isNotNull()).withColumn("_at", weight)
    best = (tries.groupBy("url", "_at").agg(F.count("*").alias("_n")).groupBy("url")
            .agg(F.max("_at").alias("_best"), F.max_by("_n", "_at").alias("_same")))
    chosen = join_on_unique(tries, best, "url").where(F.col("_at") == F.col("_best")).drop("_at", "_best")
    order = [name for name in fetch_log.columns if name not in ("url", "attempt_no")]
    row = F.row_number().over(W.partitionBy("url").orderBy(*order))
    several = chosen.where(F.col("_same") > 1).withColumn("_row", row).where(F.col("_row") == 1)
    return chosen.where(F.col("_same") == 1).unionByName(several.drop("_row")).select(*fetch_log.columns)


def asked_rows(fetch_log: DataFrame, urls: DataFrame, most_literals: int = MAX_LITERALS) -> DataFrame:
    """Log rows of the distinct ``urls``, one for each: nobody parses what nobody asks for.

    Up to ``most_literals`` URLs become literals of a filter that reaches the scan, so that Parquet skips row groups by
    their statistics and Bloom filters (see ``sources.fetch_log``). More are joined. Both give the same rows.
    """
    few = [r["url"] for r in urls.where(F.col("url").isNotNull()).limit(most_literals + 1).collect()]
    if len(few) > most_literals:
        return latest_attempts(fetch_log.join(urls, "url", "left_semi"))
    return latest_attempts(fetch_log.where(F.col("url").isin(few)) if few else fetch_log.where("false"))


def site_visits(sites: DataFrame, parsed: DataFrame, params: RunParams = RunParams()) -> DataFrame:
    """What a crawler asks for: the homepage (rank 0) and the ranked candidates of every ``site_url``."""
    home = parsed.where(is_fetched(F.col("http_status"), F.col("error"))).select(
        F.col("url").alias("site_url"), "links")
    links = resolve_links(explode_links(home.join(sites, "site_url", "left_semi")))
    candidates = link_candidates(links, params.hints, params.links_per_site).drop("score")
    homes = sites.select("site_url", F.lit(0).alias("rank"), F.col("site_url").alias("url"))
    return homes.unionByName(candidates, allowMissingColumns=True)


def visit_log(visits: DataFrame, parsed: DataFrame, rules: DataFrame, user_agent: str) -> DataFrame:
    """Visits with crawl permission and the recorded response without its text, looked up once per distinct URL."""
    allowed = with_permission(visits.select("url").where(F.col("url").isNotNull()).distinct(), rules, user_agent)
    recorded = parsed.select("url", "http_status", "error", "content_type", "n_chars", F.lit(True).alias("recorded"))
    return join_on_unique(visits, allowed.drop("robots_url").join(recorded, "url", "left"), "url", "left")


def site_outcomes(visits: DataFrame, min_chars: int = MIN_TEXT_CHARS) -> DataFrame:
    """One outcome per site from its few visits, with the URL of its text (``text_url``).

    Conditions are tried in the order they stand in.
    """
    home = F.when(F.col("rank") == 0, F.struct(
        "robots_allowed", "http_status", "error", "content_type", "n_chars", "recorded"))
    bad_link = F.when(F.col("link_error").isNotNull(), F.struct("rank", "link_error"))
    site = (visits.groupBy("site_url")
            .agg(F.min(home).alias("home"), F.min(best_candidate(min_chars)).alias("best"),
                 F.min(bad_link).alias("bad_link"))
            .select("site_url", "home.*", "best", "bad_link.link_error"))

    http_error = F.coalesce(F.col("http_status") >= 400, F.lit(False))
    fetched = F.coalesce("recorded", F.lit(False)) & is_fetched(F.col("http_status"), F.col("error"))
    site = site.withColumn("outcome", (
        F.when(~F.col("robots_allowed"), "robots_blocked")
        .when(~fetched | F.col("link_error").isNotNull(), "fetch_failed")
        .when(F.col("best").isNotNull(), F.col("best.kind"))
        .when(F.col("n_chars") > min_chars, "homepage")
        .otherwise("none")))

    outcome = F.col("outcome")
    blocked, homepage, candidate = outcome == "robots_blocked", outcome == "homepage", outcome.isin("pdf", "html")
    status_text = F.coalesce("error", F.concat(F.lit("HTTP Error "), F.col("http_status").cast("string")))
    failure = F.when(http_error, first_chars(status_text, MAX_NOTE_CHARS)).otherwise(F.coalesce(
        short_error(F.col("error")), short_error(F.col("link_error")), F.lit(NOTE_NOT_RECORDED)))
    return site.select(
        "site_url", "outcome", "robots_allowed",
        F.when(candidate, F.col("best.url")).otherwise(F.col("site_url")).alias("source_url"),
        F.when(homepage, "html").otherwise(outcome).alias("doc_type"),
        F.when(candidate, F.col("best.http_status")).when(~blocked, F.col("http_status")).alias("http_status"),
        F.when(candidate, F.col("best.content_type")).when(~blocked & fetched, F.col("content_type"))
        .alias("content_type"),
        F.when(outcome == "html", F.col("best.url")).when(homepage, F.col("site_url")).alias("text_url"),
        F.when(blocked, NOTE_DISALLOWED).when(outcome == "fetch_failed", failure)
        .when(homepage, NOTE_HOMEPAGE).when(outcome == "none", NOTE_NOTHING).alias("note"))


def place_documents(queue: DataFrame, outcomes: DataFrame, object_root: str) -> DataFrame:
    """Outcome of each queued place. Places sharing a site share its outcome; only the stored path differs."""
    outcome = F.col("outcome")
    name = (F.when(outcome == "homepage", HOMEPAGE_FILE)
            .when(outcome.isin("pdf", "html"), F.concat(F.lit("menu_"), slug(F.col("source_url")), F.lit("."), outcome)))
    wanted = queue.select("place_id", F.col("website_uri").alias("site_url"))
    return (join_on_unique(wanted, outcomes, "site_url").withColumn("_name", name)
            .withColumn("stored_path", F.when(F.col("_name").isNotNull(),
                                              object_path(object_root, F.col("place_id"), F.col("_name"))))
            .select(*schemas.DOCUMENTS.fieldNames()))


def answered_visits(queue: DataFrame, fetch_log: DataFrame, rules: DataFrame,
                    params: RunParams = RunParams()) -> tuple[DataFrame, DataFrame]:
    """All visits of the queued sites with permission and response, and the parsed log rows they read.

    Homepages of the queue are parsed first, then those candidates that can be pages; all other bodies of the log
    never reach Python. Both are staged, and so are the visits, because their frequent URLs are counted first.
    """
    sites = queue.select(F.col("website_uri").alias("site_url")).distinct()
    homes = staged(parse_log(asked_rows(fetch_log, sites.withColumnRenamed("site_url", "url")), params), "homepages")
    visits = staged(site_visits(sites, homes, params), "visits")
    others = visits.where((F.col("rank") > 0) & F.col("url").isNotNull()).select("url").distinct()
    others = asked_rows(fetch_log, others.join(sites, F.col("url") == F.col("site_url"), "left_anti"))
    readable = is_page(F.col("url"), F.col("content_type")) & is_fetched(F.col("http_status"), F.col("error"))
    others = staged(parse_log(others.withColumn("content", F.when(readable, F.col("content"))), params), "candidates")
    parsed = homes.unionByName(others)
    again = parsed.groupBy("url").agg(F.count("*").alias("n")).where("n > 1").select("url").first()
    if again:
        raise ValueError(f"the fetch log has several rows for {again['url']}: number them in attempt_no")
    return visit_log(visits, parsed, rules, params.user_agent), parsed


def with_texts(outcomes: DataFrame, parsed: DataFrame) -> DataFrame:
    """Each site's outcome with the one text that was chosen for it."""
    texts = parsed.select(F.col("url").alias("text_url"), F.col("text").alias("raw_text"))
    return join_on_unique(outcomes, texts, "text_url", "left").drop("text_url")


def fetch_outcomes(queue: DataFrame, fetch_log: DataFrame, rules: DataFrame,
                   params: RunParams = RunParams()) -> DataFrame:
    """Document rows of all queued places from a log with one row per fetched URL, or several with ``attempt_no``.

    All page work is done once per site. What a site comes to is decided on lengths, its text joins at the end.
    """
    visits, parsed = answered_visits(queue, fetch_log, rules, params)
    outcomes = staged(site_outcomes(visits, params.min_text_chars), "outcomes")
    return place_documents(queue, with_texts(outcomes, parsed), params.object_root)


def document_yield(documents: DataFrame) -> DataFrame:
    return documents.agg(F.count("*").alias("documents"),
                         F.count_if(F.col("doc_type").isin("html", "pdf")).alias("with_source"))
