import pytest
from pyspark.sql import functions as F

from placefolio.functions.html import html_parts
from placefolio.functions.text import bytes_to_text

CASES = {
    "anchor_reset": ('<a href="/m">Menu</a> hello', "Menu hello", [("/m", "Menu")]),
    "two_nodes": ('<a href="/m"><b>Our</b> menu</a>', "Our menu", [("/m", "Our"), ("/m", "menu")]),
    "image_only": ('<a href="/m"><img></a>x<p>', "x", []),
    "skipped": ("<script>x</script>a<noscript>b</noscript>", "a", []),
    "nested_skipped": ("<svg><noscript>a</noscript>b</svg>c<p>", "c", []),
    "stray_end": ("</svg>a<style>b</style>c<p>", "a c", []),
    "link_in_skipped": ('<svg><a href="/x">a</a></svg><p>b</p>', "b", []),
    "no_href_keeps_last": ('<a href="/1">a<a>b</a>c<p>', "a b c", [("/1", "a"), ("/1", "b")]),
    "empty_href": ('<a href="">a</a>b<p>', "a b", []),
    "last_href": ('<a href="/1" href="/2">a</a>', "a", [("/2", "a")]),
    "entities": ("<p>a &amp; b&nbsp;</p><p>&lt;b&gt;</p>", "a & b <b>", []),
    "comment": ("a<!-- b -->c<p>", "a c", []),
    "unfinished": ("<p>a</p><p clas", "a", []),
    "inner_space": ("<p>\n a  b \t</p>", "a  b", []),
}


@pytest.mark.parametrize("binary", [False, True])
def test_parts(spark, binary):
    rows = [(name, page) for name, (page, _, _) in CASES.items()] + [("null", None)]
    page = F.col("page").cast("binary") if binary else F.col("page")
    got = {r["name"]: r["p"] for r in spark.createDataFrame(rows, "name string, page string")
           .select("name", html_parts(page).alias("p")).collect()}
    for name, (_, text, links) in CASES.items():
        assert (got[name]["text"], [tuple(link) for link in got[name]["links"]]) == (text, links), name
    assert got["null"]["text"] is None and got["null"]["links"] is None


def test_bad_bytes_are_left_out(spark):
    raws = [b"ab\xffcd\xc3", "ü�€".encode(), b"\xf0\x9f\x8d", b"", b"\xed\xa0\x80x", None]
    df = spark.createDataFrame([(i, raw) for i, raw in enumerate(raws)], "i int, raw binary")
    got = {r["i"]: r["t"] for r in df.select("i", bytes_to_text(F.col("raw")).alias("t")).collect()}
    assert [got[i] for i in range(len(raws))] == [None if r is None else r.decode("utf-8", "ignore") for r in raws]
    assert spark.createDataFrame([(b"a\xff<p>",)], "raw binary").select(
        html_parts(F.col("raw"))["text"].alias("t")).first()["t"] == "a"
