"""The driver's tables read as the inputs of the operators.

=================  ========================================================================================
places             ``customer`` with its nation; the page of the same number is its website
search_pages       the same places as recorded search pages, every place listed by two pages
fetch_log          ``pages`` as recorded homepages, ``documents`` as the bodies behind links of theirs, numbered by their ids
rules              crawl rules of every host in ``pages``
responses          every ``lineitem`` as one extraction answer about its part; part k belongs to place k
=================  ========================================================================================

What a crawler or a model would have recorded is stored once per application and read from there, as the jobs
would find it. Every document is mapped: four of them are linked from each page, and a site is asked for three at most. Odd inputs
(failed pages, refused fetches, broken answers) hang on column values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from placefolio.functions.html import html_parts
from placefolio.operators import extraction, fetches, items as item_ops, links
from placefolio.params import LinkHints, RunParams
from placefolio.session import staged

# The pages are invented prose without any of the default words and with hardly a short text.
PARAMS = RunParams(target_count=None, max_sites=None, min_text_chars=1_000,
                   hints=LinkHints(words=("the", "tion", "en"), whole_words=("and",), strong="the"))
RUN_TS = "2024-01-01 00:00:00"

_staged: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Tables that an earlier stage of a run writes: built and stored once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _staged:
        _staged[key] = staged(build(), name)
    return _staged[key]


def _numbered(prefix: str, number: str) -> Column:
    return F.concat(F.lit(prefix), F.col(number).cast("string"))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    segment, country = F.lower("c_mktsegment"), F.col("n_name")
    return (table(spark, sf_dir, "customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .join(pages, F.col("c_custkey") == F.col("page_id"), "left")
            .select(
                F.col("c_custkey").alias("discovery_rank"),
                _numbered("p", "c_custkey").alias("place_id"),
                F.col("c_name").alias("name"),
                F.concat_ws(", ", "n_name", "r_name").alias("formatted_address"),
                F.col("n_nationkey").cast("double").alias("latitude"),
                F.col("n_regionkey").cast("double").alias("longitude"),
                segment.alias("primary_type"),
                F.concat_ws(",", segment, F.lower(country)).alias("types"),
                F.col("c_acctbal").alias("rating"),
                F.col("n_nationkey").cast("bigint").alias("user_rating_count"),
                F.col("c_mktsegment").alias("price_level"),
                F.when(F.col("url").isNotNull() & (F.col("c_acctbal") < 0), "").otherwise(F.col("url"))
                .alias("website_uri"),
                F.when(F.col("c_mktsegment") != "MACHINERY", _numbered("+", "c_custkey")).alias("phone"),
                F.when(F.col("c_mktsegment") != "FURNITURE",
                       F.concat_ws(" | ", F.concat(F.lit("Mon: "), country), F.lit("Tue: closed")))
                .alias("opening_hours"),
                F.lit("OPERATIONAL").alias("business_status")))


def place_json(place_id: Column) -> Column:
    """A silver row as the nested place object of a search response."""
    return F.struct(
        place_id.alias("id"),
        F.struct(F.col("name").alias("text")).alias("displayName"),
        F.col("formatted_address").alias("formattedAddress"),
        F.struct("latitude", "longitude").alias("location"),
        F.col("rating").alias("rating"),
        F.col("user_rating_count").alias("userRatingCount"),
        F.col("price_level").alias("priceLevel"),
        F.split("types", ",").alias("types"),
        F.col("primary_type").alias("primaryType"),
        F.col("website_uri").alias("websiteUri"),
        F.col("phone").alias("nationalPhoneNumber"),
        F.struct(F.split("opening_hours", r" \| ").alias("weekdayDescriptions")).alias("currentOpeningHours"),
        F.col("business_status").alias("businessStatus"))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places(spark, sf_dir).select("discovery_rank", "place_id", F.to_json(place_json(F.col("place_id"))).alias("raw_json"))


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, sf_dir, "search-pages", lambda: _search_pages(spark, sf_dir))


def _search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of up to 20 places, five per query, one recorded row per listed place."""
    def listing(shift: int, first_pos: int) -> Column:
        at = F.col("discovery_rank") + shift
        return F.struct(F.floor(at / 50).alias("query_ord"), F.floor(at % 50 / 10).alias("page_no"),
                        (at % 10 + first_pos).alias("first_pos"))

    listed = places(spark, sf_dir).select("*", F.inline(F.array(listing(0, 0), listing(35, 10))))
    place_id = (F.when(F.col("rating").between(-950, -900), F.lit(None)).when(F.col("rating").between(-900, -850), "")
                .otherwise(F.col("place_id")))
    last_page = (F.col("page_no") == 4) | (F.col("page_no") == 1) & (F.col("query_ord") % 11 == 3)
    response = F.to_json(F.struct(F.array(place_json(place_id)).alias("places"),
                                  F.when(~last_page, "more").alias("nextPageToken")))
    return listed.select(
        "query_ord", "page_no", "first_pos",
        F.when(F.col("rating") < -980, F.lit(None)).when(F.col("rating") < -950, '{"places": [')
        .otherwise(response).alias("response"),
        F.when(F.col("rating") < -980, "HTTP 500").alias("error"))


def page_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "pages").withColumn("_parts", html_parts(F.col("html")))
            .select("page_id", "url", F.col("_parts.text").alias("visible_text"), F.col("_parts.links").alias("links")))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(site_url, pos, href, text)`` of all pages."""
    return links.explode_links(page_parts(spark, sf_dir), "url")


def shaped_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page URL as the base of links of all shapes (the links in the pages are rooted paths only)."""
    url = F.col("url")
    hrefs = F.array(
        url, F.regexp_replace(url, "^https?://", "ftp://"), F.upper(url), F.regexp_replace(url, "(example.[a-z]+)", "$1:8080"),
        F.lit("mailto:hello@example.com"), F.lit("//other.example.com/a"), F.lit("?page=9"), F.lit("#part"),
        F.lit("list/today.html"), F.lit("../up"), F.lit("/a/./b/../c.pdf"))
    return table(spark, sf_dir, "pages").select(
        url.alias("site_url"), F.posexplode(hrefs).alias("pos", "href"), F.lit("link").alias("text"))


def page_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    homes = homepages(spark, sf_dir).withColumn("_parts", html_parts(F.col("html")))
    found = links.explode_links(homes.select("url", F.col("_parts.links").alias("links")), "url")
    return links.link_candidates(links.resolve_links(found), PARAMS.hints)


def document_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, page_id, href, label, url)``: documents 4k to 4k+3 lie on the site of page k, every seventh as PDF, and
    two thirds of the links have a label that looks right. Without that page a document lies on a site nobody asks."""
    number = F.col("doc_id").cast("string")
    href = F.concat(F.lit("/doc/"), number, F.when(F.col("doc_id") % 7 == 0, ".pdf").otherwise(".html"))
    root = F.regexp_extract("url", "^(https?://[^/?#]+)", 1)
    pages = table(spark, sf_dir, "pages").select("page_id", root.alias("root"))
    return (table(spark, sf_dir, "documents")
            .select("doc_id", F.floor(F.col("doc_id") / 4).alias("page_id"), href.alias("href"),
                    F.when(F.col("doc_id") % 3 == 1, F.concat(F.lit("paper "), number))
                    .otherwise(F.concat(F.lit("the text "), number)).alias("label"))
            .join(pages, "page_id", "left")
            .withColumn("url", F.concat(F.coalesce("root", F.lit("http://nosite.example.com")), "href")).drop("root"))


def homepages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` with the links of their documents in front."""
    anchor = F.concat(F.lit('<a href="'), "href", F.lit('">'), "label", F.lit("</a>"))
    added = (document_links(spark, sf_dir).groupBy("page_id")
             .agg(F.array_sort(F.collect_list(F.struct("doc_id", anchor.alias("a")))).alias("_links"))
             .select("page_id", F.array_join("_links.a", "").alias("_links")))
    return (table(spark, sf_dir, "pages").join(added, "page_id", "left")
            .select("page_id", "url", F.concat(F.coalesce("_links", F.lit("")), "html").alias("html")))


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, sf_dir, "fetch-log", lambda: _fetch_log(spark, sf_dir))


def _fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    refused = F.col("url").rlike("cheap-pills|free-bets|casino-win")
    lost = F.endswith(F.col("url"), F.lit(".html"))
    # Pages may share a URL: each is an attempt of its own, the last one counts.
    homes = homepages(spark, sf_dir).select(
        "url", F.col("page_id").alias("attempt_no"), F.when(refused, 403).when(~lost, 200).alias("http_status"),
        F.when(refused, "HTTP Error 403: Forbidden").when(lost, "URLError: timed out").alias("error"),
        F.lit("text/html").alias("content_type"), F.col("html").cast("binary").alias("content"))

    timed_out = F.col("lang") == "de"
    where = document_links(spark, sf_dir).select("doc_id", "url")
    linked = where.join(table(spark, sf_dir, "documents"), "doc_id").select(
        "url", F.col("doc_id").alias("attempt_no"), F.when(~timed_out, 200).alias("http_status"), F.when(timed_out, "URLError: timed out").alias("error"),
        F.when(F.col("source").isin("src0", "src1", "src2", "src3"), "application/pdf")
        .when(F.col("source").isin("src4", "src5"), "image/png")
        .when(F.col("source") == "src6", "").otherwise("text/html").alias("content_type"),
        F.concat(F.lit("<html><body><p>"), F.coalesce("text", F.lit("")), F.lit("</p></body></html>")).cast("binary").alias("content"))
    return homes.unionByName(linked)


def attempt_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fetch log with retries, by the length of the URL: the recorded row comes alone, behind a lost first try, before
    a refused second one, or behind an older success; some rows are recorded twice under one number."""
    row = lambda n, status, error, content: F.struct(
        F.lit(n).alias("attempt_no"), status.cast("int").alias("http_status"), error.cast("string").alias("error"),
        content.cast("binary").alias("content"))
    own = lambda n: row(n, F.col("http_status"), F.col("error"), F.col("content"))
    lost = row(1, F.lit(None), F.lit("URLError: timed out"), F.lit(None))
    refused = row(2, F.lit(503), F.lit("HTTP Error 503: Service Unavailable"), F.lit(None))
    older = row(1, F.lit(200), F.lit(None), F.concat(F.lit("older "), F.col("url")))
    kind = F.length("url") % 5
    tries = (F.when(kind == 0, F.array(own(1))).when(kind == 1, F.array(lost, own(2))).when(kind == 2, F.array(own(1), refused))
             .when(kind == 3, F.array(older, own(2))).otherwise(F.array(own(3), lost, own(3))))
    return fetch_log(spark, sf_dir).select("url", "content_type", F.explode(tries).alias("_try")).select("url", "content_type", "_try.*")


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, sf_dir, "rules", lambda: _rules(spark, sf_dir))


def _rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = (table(spark, sf_dir, "pages")
             .select(F.regexp_extract("url", "^(https?://[^/?#]+)", 1).alias("root")).distinct()
             .select(F.concat("root", F.lit("/robots.txt")).alias("robots_url"),
                     F.regexp_extract("root", "://(.*)$", 1).alias("host")))

    def rule(hosts: str, group_ord: int, agent: str, rule_ord: int, path_prefix: str, allow: bool) -> Column:
        return F.when(F.col("host").like(hosts), F.struct(
            F.lit(group_ord).alias("group_ord"), F.lit(agent).alias("agent"), F.lit(rule_ord).alias("rule_ord"),
            F.lit(path_prefix).alias("path_prefix"), F.lit(allow).alias("allow")))

    every_site = F.array(
        rule("%", 0, "otherbot", 1, "/", False),
        rule("m.%", 1, "*", 1, "/en/2", True), rule("m.%", 1, "*", 2, "/en/", False),
        rule("th%", 1, "*", 1, "/fr", False), rule("th%", 1, "*", 2, "/fr/", True), rule("th%", 1, "*", 3, "/The", False),
        rule("th%", 1, "*", 4, "/doc/1", False),
        rule("blog.%", 1, "*", 1, "/", False), rule("blog.%", 2, "Placefolio", 1, "/de/", False),
        rule("blog.%", 2, "Placefolio", 2, "/es/", True))
    return (sites.select("robots_url", F.explode(F.filter(every_site, lambda r: r.isNotNull())).alias("rule"))
            .select("robots_url", "rule.*"))


def queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetches.fetch_queue(places(spark, sf_dir), ["discovery_rank"], None).select("place_id", "website_uri")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document table as the fetch stage leaves it."""
    return once(spark, sf_dir, "documents", lambda: fetches.fetch_outcomes(
        queue(spark, sf_dir), fetch_log(spark, sf_dir), rules(spark, sf_dir), PARAMS))


def stored_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored bytes of all PDF documents, under the path a file scan would report."""
    stored = documents(spark, sf_dir).where("doc_type = 'pdf'").select(
        F.concat(F.lit("file:/"), "stored_path").alias("path"), F.col("source_url").alias("url"))
    bodies = fetches.asked_rows(fetch_log(spark, sf_dir), stored.select("url").distinct()).select("url", "content")
    return stored.join(bodies, "url").select("path", "content")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, sf_dir, "responses", lambda: _responses(spark, sf_dir))


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One answer per line item: most with two items, some broken, missing, empty or with the price as text."""
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    name = F.when(F.col("p_size") <= 25, F.lit(None)).when(F.col("p_size") <= 28, "  ").otherwise(F.col("p_name"))

    def item(section: Column, price: Column) -> Column:
        return F.struct(section.cast("string").alias("section"), name.alias("item_name"),
                        F.col("l_returnflag").alias("description"), price.alias("price"))

    price = F.when(F.col("l_tax") > 0, F.col("l_quantity"))
    both = F.array(item(F.col("p_type"), price), item(F.lit(None), F.col("l_quantity")))
    as_text = F.array(item(F.col("p_type"), F.col("l_quantity").cast("string")))
    return lines.select(
        _numbered("p", "l_partkey").alias("place_id"),
        F.concat(F.lit("http://line/"), "l_linestatus").alias("source_url"),
        F.when(F.col("l_discount") == 0.1, "not json").when(F.col("l_discount") == 0.09, F.lit(None))
        .when(F.col("l_discount") == 0.08, '{"items":[]}')
        .when(F.col("l_discount") == 0.07, F.to_json(F.struct(as_text.alias("items"))))
        .otherwise(F.to_json(F.struct(both.alias("items")))).alias("menu_json"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, sf_dir, "items", lambda: item_ops.items_from_responses(
        responses(spark, sf_dir), run_ts=F.lit(RUN_TS).cast("timestamp")))


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        _numbered("p", "doc_id").alias("place_id"), F.col("source").alias("source_url"),
        F.col("text").alias("source_text"))


def answer_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, and a text for every line item: most name a part with an amount, some an amount only or none."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    amount = F.format_string("%.2f", "l_extendedprice")
    text = (F.when(F.col("l_linenumber") % 5 == 4, F.concat("p_name", F.lit(" on request")))
            .otherwise(F.concat(F.lit("today "), "p_name", F.lit(" $"), amount, F.lit(" or "), F.lower("p_type"), F.lit("  "), amount)))
    of_lines = lines.select(_numbered("p", "l_partkey").alias("place_id"), _numbered("http://line/", "l_orderkey").alias("source_url"),
                            text.alias("source_text"))
    return document_texts(spark, sf_dir).unionByName(of_lines)


def parsed_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.parse_documents(stored_objects(spark, sf_dir))
