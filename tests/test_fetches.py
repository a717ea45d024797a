from placefolio import schemas
from placefolio.operators import fetches
from placefolio.params import RunParams

LONG = "word " * 60  # 299 characters behind strip
RULES = "robots_url string, group_ord int, agent string, rule_ord int, path_prefix string, allow boolean"
LOG = "url string, http_status int, error string, content_type string, content binary"


def page(*hrefs, text=""):
    links = "".join(f'<a href="{h}">Menu</a>' for h in hrefs)
    return f"<html><body>{links}<p>{text}</p></body></html>".encode()


def run(spark, sites, log, rules=(), params=RunParams(max_sites=None), order=None):
    places = spark.createDataFrame(
        [(f"p{i}", i, site) for i, site in enumerate(sites)], "place_id string, n int, website_uri string")
    docs = fetches.fetch_outcomes(
        fetches.fetch_queue(places, ["n"], params.max_sites), spark.createDataFrame(list(log), LOG),
        spark.createDataFrame(list(rules), RULES), params)
    assert docs.schema.fieldNames() == schemas.DOCUMENTS.fieldNames()
    assert [f.dataType for f in docs.schema] == [f.dataType for f in schemas.DOCUMENTS]
    rows = docs.collect()
    assert len({r["place_id"] for r in rows}) == len(rows)
    return {int(r["place_id"][1:]): r for r in rows}


def ok(url, content, kind="text/html", status=200):
    return (url, status, None, kind, content)


def test_every_outcome(spark):
    s = [f"http://s{i}.example.com/" for i in range(14)]
    log = [
        ok(s[0], page("/menu", text=LONG)), ok(s[0] + "menu", page(text=LONG)),           # denied
        (s[1], 404, "HTTP Error 404: " + "x" * 200, None, None),                          # HTTP error
        (s[2], None, "URLError: " + "y" * 200, None, None),                               # no answer
        ok(s[3], page("/menu.pdf")), ok(s[3] + "menu.pdf", b"tiny", "application/pdf"),   # PDF, no size test
        ok(s[4], page("/menu", text=LONG)), ok(s[4] + "menu", page(text=LONG + "end")),   # candidate page
        ok(s[5], page("/menu", text=LONG)), ok(s[5] + "menu", page(text="thin")),         # thin candidate
        ok(s[6], page(text="thin")),                                                      # nothing
        ok(s[7], page("/menu1", "/menu2", "/menu3", "/menu4", text=LONG)),                # three tries only
        (s[7] + "menu1", 500, "HTTP Error 500: x", None, None), ok(s[7] + "menu2", page(text=LONG), "image/png"),
        ok(s[7] + "menu4", page(text=LONG)),
        ok(s[8], page("/menu1", "/menu2")), ok(s[8] + "menu1", page(text=LONG)),          # first by rank is denied
        ok(s[8] + "menu2", page(text=LONG), ""),
        ok(s[9], page("/menu1", "/menu2")), ok(s[9] + "menu1", page(text=LONG)),          # page before PDF: rank decides
        ok(s[9] + "menu2", b"x", "application/pdf"),
        ok(s[10], page("http://[bad", text=LONG)),                                        # unreadable link
        ok(s[11], page(text="x" * 200)), ok(s[12], page(text="x" * 201)),                 # the text limit
    ]
    rules = [(s[0] + "robots.txt", 0, "*", 0, "/", False), (s[8] + "robots.txt", 0, "*", 0, "/menu1", False)]
    got = run(spark, s, log, rules)

    def row(i):
        r = got[i]
        return (r["source_url"].removeprefix(s[i]), r["doc_type"], r["http_status"], r["stored_path"] and r["stored_path"].split("/")[-1],
                r["robots_allowed"], r["note"])

    def quoted(i, name):
        return f"menu_http%3A%2F%2Fs{i}.example.com%2F{name}"

    assert row(0) == ("", "robots_blocked", None, None, False, "homepage disallowed")
    assert row(1) == ("", "fetch_failed", 404, None, True, ("HTTP Error 404: " + "x" * 200)[:160])
    assert row(2) == ("", "fetch_failed", None, None, True, "URLError: " + "y" * 160)
    assert row(3) == ("menu.pdf", "pdf", 200, quoted(3, "menu.pdf.pdf"), True, None)
    assert row(4) == ("menu", "html", 200, quoted(4, "menu.html"), True, None)
    assert row(5) == ("", "html", 200, "homepage.html", True, "homepage fallback")
    assert row(6) == ("", "none", 200, None, True, fetches.NOTE_NOTHING)
    assert row(7)[1:4] == ("html", 200, "homepage.html")
    assert row(8)[:2] == ("menu2", "html") and got[8]["content_type"] == ""
    assert row(9)[:2] == ("menu1", "html")
    assert row(10)[1:3] == ("fetch_failed", 200) and got[10]["note"].startswith("ValueError: ")
    assert got[10]["content_type"] == "text/html"
    assert (row(11)[1], row(12)[1]) == ("none", "html")
    assert row(13) == ("", "fetch_failed", None, None, True, fetches.NOTE_NOT_RECORDED)
    assert got[3]["raw_text"] is None and got[4]["raw_text"].endswith("end") and got[0]["content_type"] is None


def test_shared_sites_and_blank_websites(spark):
    site = "http://chain.example.com/"
    got = run(spark, [site, "", None, site], [ok(site, page(text=LONG))])
    assert sorted(got) == [0, 3]
    assert [got[i]["stored_path"] for i in (0, 3)] == ["raw/p0/homepage.html", "raw/p3/homepage.html"]
    capped = run(spark, [None, "http://a.example.com/", "http://b.example.com/"], [], params=RunParams(max_sites=1))
    assert sorted(capped) == [1]


def test_text_and_byte_limits(spark):
    site = "http://s.example.com/"
    body = b"<p>" + b"z" * 30_000 + b"</p>" + b" " * 3_000_000 + b"<p>beyond</p>"
    got = run(spark, [site], [ok(site, body)])
    assert got[0]["raw_text"] == "z" * 20_000


def test_yield(spark):
    docs = spark.createDataFrame([("html",), ("pdf",), ("none",), ("fetch_failed",)], "doc_type string")
    assert tuple(fetches.document_yield(docs).first()) == (4, 2)


def test_pages_may_share_a_url(spark, tmp_path):
    from datetime import date

    from placefolio.plans.registry import QUERIES

    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    def prose(word):
        return f"<html><body><p>{(word + ' ') * 300}</p></body></html>"

    shared, own = "https://www.example.com/en/1", "https://www.example.com/en/2"
    write("region", [(0, "ASIA")], "r_regionkey int, r_name string")
    write("nation", [(0, "INDIA", 0)], "n_nationkey int, n_name string, n_regionkey int")
    write("customer", [(k, f"c{k}", 0, 1.0, "MACHINERY") for k in range(4)],
          "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    # Pages 0 and 2 share a URL. The documents, one of them recorded twice, are PDFs on the site of page 1.
    write("pages", [(0, shared, prose("older")), (1, own, prose("own")), (2, shared, prose("newer"))], "page_id long, url string, html string")
    write("documents", [(k, "pdf text " * 300, "en", "src0") for k in (4, 6, 7, 7)], "doc_id long, text string, lang string, source string")
    write("part", [(1, "part", 30, "type")], "p_partkey long, p_name string, p_size int, p_type string")
    write("lineitem", [(1, 1, 1, 2.0, 9.0, 0.0, 0.0, "N", "O", date(2024, 1, 1))],
          "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
          "l_tax double, l_returnflag string, l_linestatus string, l_shipdate date")
    sf = str(tmp_path)
    got = {r["place_id"]: r for r in QUERIES["fetch_outcome"](spark, sf).collect()}
    assert sorted(got) == ["p0", "p1", "p2"]
    # The page recorded last counts for both places.
    assert got["p0"]["raw_text"] == got["p2"]["raw_text"] == ("newer " * 300).strip()
    assert got["p1"]["doc_type"] == "pdf"
    assert [r["site_url"] for r in QUERIES["first_success"](spark, sf).collect()] == [own]
    assert tuple(QUERIES["fetch_yield"](spark, sf).first()) == (3, 3)
    # A document that is recorded again is one object with one text.
    texts = QUERIES["source_text_union"](spark, sf).collect()
    assert sorted(r["place_id"] for r in texts) == ["p0", "p1", "p2"]
    assert {r["place_id"]: r["has_source"] for r in QUERIES["doc_flags"](spark, sf).collect()} == {"p0": True, "p1": True, "p2": True}
    for name in ("place_status", "status_from_buckets"):
        assert {r["place_id"]: r["menu_status"] for r in QUERIES[name](spark, sf).collect()} == {
            "p0": "source_found_no_items", "p1": "menu_extracted", "p2": "source_found_no_items", "p3": "no_website"}
    assert QUERIES["not_attempted_anti"](spark, sf).count() == 0
    assert {r["menu_status"]: r["restaurants"] for r in QUERIES["status_breakdown"](spark, sf).collect()} == {
        "source_found_no_items": 2, "menu_extracted": 1, "no_website": 1}
    assert QUERIES["run_summary"](spark, sf).first()["restaurants_with_menu"] == 1
