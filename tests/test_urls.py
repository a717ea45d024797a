import itertools
import random
from urllib.parse import quote, urljoin, urlsplit

from pyspark.sql import functions as F

from placefolio.functions import text, urls
from placefolio.operators.links import resolve_links

BASES = ["http://h.example.com", "http://h.example.com/", "https://h.example.com/a/b", "https://h.example.com/a/b/",
         "http://h.example.com:81/a/b.html?x=1&y=2#top", "http://h.example.com/a//b", "http://h.example.com/a/../b",
         "http://h.example.com?q=/x", "http://h.example.com/a;p/b", "HTTP://H.example.com/A"]
HREFS = ["/x", "/", "//o.example.com/y", "x", "x/y", "./x", "../x", "../../x", "/a/./b/../c", "?q=1", "?", "#f", "#",
         "mailto:a@b.c", "javascript:void(0)", "tel:1", "http://o.example.com", "https://o.example.com/a?b#c", "HTTP://o/a",
         "ftp://o/x", "x?y=../z", "x#../z", "/x?y#z", "x;p", " /x ", "x y", "/ü/é", "x//y", "a:b", "/a:b", "http:x", "..", ".",
         "/..", "/.", "x/..", "/x?", "/x#", "/a\\b", "x\ty", "&", "/m.pdf#p2", "http://[bad", "//[x/y", ".hidden", "/.well-known/x",
         "...", "x/.../y", "-", "~u", "http://o.example.com/../x", "http://o.example.com/?"]


def expected(base, href):
    try:
        url = urljoin(base, href)
        urlsplit(url)
        return url, None
    except ValueError as problem:
        return None, f"ValueError: {problem}"


def test_links_resolve_as_in_the_standard_library(spark):
    rng = random.Random(7)
    pieces = ["a", "b.html", "..", ".", "", "?q=1", "#f", "/", "é", ";p", ":", "//", "%20"]
    made = ["".join(rng.choice(pieces) + rng.choice(["/", "", ""]) for _ in range(rng.randint(1, 5))) for _ in range(300)]
    pairs = [(b, h) for b, h in itertools.product(BASES, HREFS + made) if h]
    df = resolve_links(spark.createDataFrame(pairs, "site_url string, href string"))
    wrong = [(r["site_url"], r["href"], r["url"], r["link_error"]) for r in df.collect()
             if (r["url"], r["link_error"]) != expected(r["site_url"], r["href"])]
    assert wrong == []


def test_plain_links_stay_in_the_jvm(spark):
    df = spark.createDataFrame([("http://h.example.com/a/b?x#y", h) for h in ("/x", "x/y", "?q", "#f", "http://o/x", "/ü")],
                               "b string, h string")
    assert df.where(urls.join_plain(F.col("b"), F.col("h")).isNull()).count() == 0


def test_pdf_test_cuts_the_query_but_not_the_fragment(spark):
    cases = {"/menu.pdf": True, "/menu.PDF?v=1": True, "/menu.pdf#p2": False, "/menu.pdf?x#p": True, "/a?m.pdf": False}
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    assert {r["u"]: r["p"] for r in df.select("u", urls.is_pdf_url(F.col("u")).alias("p")).collect()} == cases


def test_same_site_counts_case_and_port(spark):
    base = "http://h.example.com/a"
    cases = {"http://h.example.com/b": True, "https://h.example.com": True, "http://H.example.com/b": False,
             "http://h.example.com:80/b": False, "ftp://h.example.com/b": False, "mailto:x@h.example.com": False}
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    got = {r["u"]: r["s"] for r in df.select("u", urls.is_same_site(F.col("u"), F.lit(base)).alias("s")).collect()}
    assert got == cases


def test_escapes_are_decoded_one_by_one(spark):
    from urllib.parse import unquote
    texts = ["/a%20b%zz", "%", "%4", "/100%/%41", "a+b%2B", "%%41", "plain", "%C3%BC%"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["d"] for r in df.select("t", urls.percent_decoded(F.col("t")).alias("d")).collect()}
    assert got == {t: unquote(t) for t in texts}


def test_slug_equals_full_quoting(spark):
    cases = ["http://h.example.com/a b?c=d&e=~f*g+h", "ü/é(1)'!", "a" * 200, "x-y_z.~"]
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    got = [r["s"] for r in df.select(text.slug(F.col("u")).alias("s")).collect()]
    assert got == [quote(u, safe="")[:120] for u in cases]


def test_lists_and_defaults(spark):
    row = spark.createDataFrame([(" a, ,b\t,, c d ,", "  ", "")], "l string, c string, e string").select(
        text.split_param_list(F.col("l")).alias("l"), text.blank_to_default(F.col("c"), "AUD").alias("c"),
        text.first_non_empty(F.col("e"), F.col("c")).alias("f")).first()
    assert (row["l"], row["c"], row["f"]) == (["a", "b", "c d"], "AUD", "  ")
