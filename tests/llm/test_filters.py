import gzip
import hashlib
import itertools
import re

from pyspark.sql import functions as F

import corpus_pipeline
from placefolio.llm import decontaminate, mixing, queries, url_filter, warc
from placefolio.llm.common import table


def brute_contaminated(text, item, window=13, subs=3):
    w, b = (re.findall(r"[^\W_]+", (t or "").lower()) for t in (text, item))
    if len(b) < 6:
        return False
    n = min(window, len(b))
    for shift in range(-len(b), len(w)):
        same = [0 <= shift + k < len(w) and w[shift + k] == b[k] for k in range(len(b))]
        if any(sum(same[s:s + n]) >= n - n * subs // window for s in range(len(b) - n + 1)):
            return True
    return False


def test_masks_hit_every_window_with_three_substitutions():
    places = [sum(1 << (at + i) for i, c in enumerate(mask) if c == "1")
              for mask in decontaminate.MASKS for at in range(13 - len(mask) + 1)]
    for bad in itertools.combinations(range(13), 3):
        assert any(not p & sum(1 << b for b in bad) for p in places)


def test_leaks_match_brute_force(spark, docs):
    item = " ".join(f"k{i}" for i in range(20))
    swap = lambda *at: " ".join("zz" if i in at else f"k{i}" for i in range(20))
    texts = ["clean words only " * 9, f"before {item} after", swap(3, 8, 13), swap(0, 3, 6, 9, 12, 15, 18), item[:36], None, "",
             "K0, k1; " + item[6:] + "!!!", " ".join(f"k{i}" for i in range(13)), "k0 k1 k2 k3 k4 k5", " ".join(["k1"] * 300),
             "s1 s2 s3 s4 s5 s6 s7"]
    items = [(1, item), (2, "s1 s2 s3 s4 s5 s6 s7"), (3, None), (4, "too short"), (5, item), (1, item)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {i: sorted({k for k, b in items if brute_contaminated(t, b)}) for i, t in enumerate(texts)}
    assert want[1] == [1, 5] and want[2] == [1, 5] and not want[3] and want[11] == [2]
    for most in (decontaminate.MAX_BROADCAST_SEEDS, 0):
        rows = decontaminate.judge_documents(docs(texts), bench, max_broadcast=most).collect()
        assert {r["doc_id"]: r["item_ids"] for r in rows} == want
        assert all(r["contaminated"] == bool(r["item_ids"]) and r["n_items"] == len(r["item_ids"]) for r in rows)


def test_repetitive_texts_verify_each_alignment_once(spark, docs):
    """One word over and over, in document and item: positions times positions hit, but there are only so many alignments."""
    import time
    bench = spark.createDataFrame([(1, "a " * 60), (2, "b a " * 40), (3, "c " * 30)], "item_id long, text string")
    texts = ["a " * 4000, "a b " * 2000, "a " * 12, "a " * 13 + "z", "b a a b a a " * 100]
    judge = lambda: {r["doc_id"]: r["item_ids"] for r in decontaminate.judge_documents(docs(texts), bench).collect()}
    items = {1: "a " * 60, 2: "b a " * 40, 3: "c " * 30}
    small = [t if len(t) < 2000 else " ".join(t.split()[:200]) for t in texts]
    assert judge() == {i: sorted(k for k, b in items.items() if brute_contaminated(t, b)) for i, t in enumerate(small)}
    started = time.perf_counter()
    judge()
    # 4,000 times 60 verified alignments of 60 words took many times as long.
    assert time.perf_counter() - started < 10


def test_short_items_are_found_with_every_allowed_substitution(spark, docs):
    items, texts, want = [], [], []
    for n in range(1, 13):
        words, allowed = [f"n{n}w{i}" for i in range(n)], 3 * n // 13
        items.append((n, " ".join(words)))
        for count, hit in ((allowed, True), (allowed + 1, False)):
            for bad in itertools.combinations(range(n), count):
                swapped = ["zz" if i in bad else w for i, w in enumerate(words)]
                texts.append(" ".join(["left", *swapped, "right"]))
                want.append([n] if hit else [])
    bench = spark.createDataFrame(items, "item_id long, text string")
    for most in (decontaminate.MAX_BROADCAST_SEEDS, 0):
        rows = decontaminate.judge_documents(docs(texts), bench, max_broadcast=most).collect()
        assert [r["item_ids"] for r in sorted(rows, key=lambda r: r["doc_id"])] == want


def test_null_item_ids_are_items(spark, docs):
    item, other = (" ".join(f"{c}{i}" for i in range(15)) for c in "kq")
    bench = spark.createDataFrame([(None, item), (None, "u v w x y z u v"), (7, other)], "item_id long, text string")
    rows = docs([f"a {item} b", f"{other} {item}", other, "clean words", "u v w x y z u v"])
    for most in (decontaminate.MAX_BROADCAST_SEEDS, 0):
        got = {r["doc_id"]: r for r in decontaminate.judge_documents(rows, bench, max_broadcast=most).collect()}
        assert [got[i]["item_ids"] for i in range(5)] == [[None], [None, 7], [7], [], [None]]
        assert [(got[i]["contaminated"], got[i]["n_items"]) for i in range(5)] == [(True, 1), (True, 2), (True, 1), (False, 0), (True, 1)]
        assert [r["doc_id"] for r in decontaminate.drop_contaminated(rows, bench, max_broadcast=most).collect()] == [3]


def test_decontamination_odd_rows(spark, odd, empty):
    bench = table(spark, "/root/testdata/sf0.001", "benchmark")
    assert decontaminate.judge_documents(odd, bench).count() == odd.count()
    left = decontaminate.drop_contaminated(odd, bench)
    assert left.columns == odd.columns and left.count() == odd.count()
    assert decontaminate.judge_documents(empty, bench).count() == 0
    assert decontaminate.judge_documents(odd, bench.limit(0)).where("contaminated").count() == 0


def test_mix_odd_rows(odd, empty):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    for source in {r["source"] for r in rows}:
        mine = [r for r in rows if r["source"] == source]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= max(r["size"] for r in mine) / 2 + 1
    again = mixing.mix(odd).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    mixed = mixing.mixed_rows(odd)
    assert mixed.columns == [*odd.columns, "_repetition"]
    assert mixing.mix(empty).count() == 0 and mixing.mixed_rows(empty).count() == 0


def test_water_filling_stops_at_the_caps(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 100), (None, 0)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    assert got["a"] == 30 and got["c"] == 300 or abs(sum(got.values()) - 1110) < 1e-6
    assert abs(sum(got.values()) - 1110) < 1e-6 and got[None] == 0
    # a is full; what is left goes by weight 2 : 1 until c is full as well.
    assert got["c"] == 300 and abs(got["b"] - 780) < 1e-6
    none = spark.createDataFrame([("a", 0)], "source string, size long")
    assert mixing.source_targets(none).first()["target"] == 0


def test_url_rules_and_reputation(spark):
    urls = ["http://A.com/x", "https://www.Example.com/en/1", "http://example.com/en/", "http://sub.example.com/en/2?x",
            "http://a.net/es/1", "http://net/fr/x", "http://anet/fr/", "no address", None, "", "http://a.com", "x://bad.org/1#f",
            "x://good.org/2", "x://new.bad.org/"]
    pages = spark.createDataFrame([(i, u, "own") for i, u in enumerate(urls)], "page_id long, url string, host string")
    outcomes = spark.createDataFrame([("bad.org", 1)] * 40 + [("good.org", 0)] * 40 + [("good.org", None)], "host string, bad int")
    got = {r["page_id"]: r for r in url_filter.judge_urls(pages, outcomes).collect()}
    assert [got[i]["rule"] for i in range(7)] == ["com/", "www.example.com/en/", "example.com/en/", "example.com/en/", "net/es/",
                                                  "net/fr/", None]
    assert [got[i]["verdict"] for i in range(6)] == ["allow", "allow", "block", "block", "block", "block"]
    assert [(got[i]["host"], got[i]["path"]) for i in (7, 8, 9, 10)] == [("", "")] * 3 + [("a.com", "")]
    assert got[11]["verdict"] == "block" and got[12]["verdict"] == "allow" and got[13]["verdict"] == "block"
    assert got[13]["host"] == "new.bad.org" and 0 < got[12]["reputation"] < 0.1
    assert url_filter.judge_urls(pages.limit(0), outcomes).count() == 0
    assert {r["verdict"] for r in url_filter.judge_urls(pages.where("page_id > 10"), outcomes.limit(0)).collect()} == {"allow"}


def test_one_bad_host_is_blocked_among_any_number(spark):
    for n_hosts in (60, 5000):
        hosts = spark.range(n_hosts).select(F.concat(F.lit("h"), "id", F.lit(".d"), "id", F.lit(".s"), F.col("id") % 7).alias("host"), "id")
        # 15 of 15 pages of host 0 are bad, 4 of 16 of all others.
        rows = hosts.select("host", "id", F.explode(F.sequence(F.lit(0), F.when(F.col("id") == 0, 14).otherwise(15))).alias("k"))
        outcomes = rows.select("host", F.when(F.col("id") == 0, 1).otherwise((F.col("k") % 4 == 0).cast("int")).alias("bad"))
        blocked = url_filter.host_reputation(outcomes).where("blocked").collect()
        assert [(r["host"], r["n"], r["bad"]) for r in blocked] == [("h0.d0.s0", 15, 15)]


def test_levels_of_hosts(spark):
    want = {"a.co.uk": ("a.co.uk", "co.uk"), "x.a.co.uk": ("a.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "www.example.com": ("example.com", "com"),
            "a.com:8080": ("a.com", "com"), "me@a.com": ("a.com", "com"), "me:pw@x.a.com:1": ("a.com", "com"), "a.com.": ("a.com", "com"),
            "a.com.:80": ("a.com", "com"), "10.0.0.1": ("10.0.0.1", "10.0.0.1"), "10.0.0.1:80": ("10.0.0.1", "10.0.0.1"),
            "[::1]:80": ("[::1]", "[::1]"), "localhost": ("localhost", "localhost"), "": ("", "")}
    hosts = spark.createDataFrame([(h,) for h in want], "host string")
    got = {r["host"]: (r["domain"], r["suffix"]) for r in hosts.select("host", *[
        c.alias(n) for c, n in zip(url_filter.levels_of(F.col("host")), ("domain", "suffix"))]).collect()}
    assert got == want
    own = url_filter.levels_of(F.col("host"), ("a.com",))[0]
    assert hosts.where("host = 'a.com:8080'").select(own).first()[0] == "a.com"


def test_query_and_sql_agree_where_hosts_are_bad(spark, tmp_path):
    """Some hosts, domains and addresses are bad among hundreds that are not; the SQL finds the same ones."""
    import duckdb

    from compare import compare
    hosts = [f"h{i}.d{i % 90}.{('org', 'co.uk', 'com.au', 'de')[i % 4]}" for i in range(300)]
    hosts += ["worst.d1.co.uk:8080", "10.0.0.1", "me@bad.example.net", "a.spam.org", "b.spam.org", "c.spam.org.", "quiet.spam.org", "localhost"]
    pages, labels, n = [], [], 0
    for k, host in enumerate(hosts):
        for j in range(20):
            n += 1
            pages.append((n, f"https://{host}/{'es' if j % 2 else 'p'}/{n}", None))
            bad = k >= 300 and host not in ("quiet.spam.org", "localhost") or (k + j) % 8 == 0
            if host != "quiet.spam.org":
                labels.append((n, int(not bad), 0 if j % 3 else None))
    pages += [(n + 1, None, None), (n + 2, "no address", None), (n + 3, "http://[::1]:80/x", None)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    con = duckdb.connect()
    for name in ("pages", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    found = queries.op8_url_filter(spark, str(tmp_path))
    assert compare(found, con, queries.oracle_sql()["op8_url_filter"]) is None
    blocked = {r["host"] for r in found.where("verdict = 'block' AND rule IS NULL").collect()}
    assert blocked == {"worst.d1.co.uk:8080", "10.0.0.1", "me@bad.example.net", "a.spam.org", "b.spam.org", "c.spam.org.", "quiet.spam.org"}
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") < 20


def test_warc_round_trip(spark, tmp_path):
    big = "é" * 30_000 + "\r\n\r\nWARC/1.1\r\n"
    rows = [(1, "u", None), (2, None, ""), (3, "a\r\nX: y", "x" * 99), (4, "u", "x" * 99), (5, "u", big), (6, "u", big),
            (None, "u", big), (7, "u", "y" * 8000), (7, "u", "y" * 8000), (8, "u", "0\r\n\r\n" * 20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    warc.write_archives(pages, str(tmp_path / "w"), segment_bytes=1000)
    got = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert len(got) == len(rows) and all(r["error"] is None for r in got)
    stored = {(r["page_id"], bytes(r["payload"]).decode()) for r in got if r["record_type"] == "response"}
    assert stored == {(i, h or "") for i, _, h in rows if i not in (6, None)}
    assert {(r["page_id"], r["refers_to"]) for r in got if r["record_type"] == "revisit"} == {(6, 5), (None, 5)}


def test_warc_query_with_repeated_ids(spark, tmp_path):
    short, long = "s" * 200, "l" * 300
    rows = [(1, "u", short), (1, "v", long), (2, "u", long), (3, None, short), (3, None, short), (4, "u", "x" * 99), (4, "u", "x" * 99),
            (None, "u", long), (5, "u", "b" * 9000), (6, "u", "b" * 9000), (7, "u", None)]
    full = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name, df in (("some", full.repartition(3)), ("none", full.limit(0))):
        df.write.parquet(str(tmp_path / name / "pages.parquet"))
    got = [tuple(r) for r in queries.op10_warc(spark, str(tmp_path / "some")).collect()]

    def row(i, html):
        html = html or ""
        same = [j for j, _, h in rows if h == html and j is not None]
        first = min(same) if len(html) >= 100 and same else None
        again = first is not None and first != i
        return i, len(html), hashlib.sha256(html.encode()).hexdigest(), "revisit" if again else "response", first if again else None

    assert sorted(got, key=str) == sorted((row(i, h) for i, _, h in rows), key=str)
    assert queries.op10_warc(spark, str(tmp_path / "none")).count() == 0


def test_archives_are_read_once_and_by_record(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", "text " * i) for i in range(400)], "page_id long, url string, html string")
    warc.write_archives(pages.repartition(2), str(tmp_path / "w"), segment_bytes=500)
    text = warc.read_archives(spark, str(tmp_path / "w"))._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in text and "binaryFile" not in text


def test_broken_archives(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"page {i} \r\n\r\n " * 50) for i in range(6)], "page_id long, url string, html string")
    warc.write_archives(pages.coalesce(1), str(tmp_path / "w"))
    part = next((tmp_path / "w").glob("*.gz"))
    whole = gzip.decompress(part.read_bytes())
    folder = tmp_path / "broken"
    folder.mkdir()
    (folder / "a.gz").write_bytes(part.read_bytes())
    (folder / "b.gz").write_bytes(gzip.compress(whole[:len(whole) // 2 - 100]))
    (folder / "c.gz").write_bytes(gzip.compress(b"no archive\r\n\r\n" + whole))
    # One member per record, as most archives have them.
    at = [m.start() for m in re.finditer(rb"WARC/1\.1\r\nWARC-Type", whole)] + [len(whole)]
    (folder / "d.gz").write_bytes(b"".join(gzip.compress(whole[i:j]) for i, j in zip(at, at[1:])))
    (folder / "e.gz").write_bytes(gzip.compress(whole.replace(b"page 3", b"PAGE 3")))
    (folder / "f.gz").write_bytes(gzip.compress(whole.replace(b"X-Page-ID: 2", b"X-Page-ID: two")))
    (folder / "g.gz").write_bytes(gzip.compress(b""))
    rows = warc.read_archives(spark, str(folder)).collect()
    good = [r["page_id"] for r in rows if not r["error"]]
    # The first two of the half archive, in whatever order they were written.
    first = [int(i) for i in re.findall(rb"X-Page-ID: (\d)", whole)][:2]
    assert sorted(good) == sorted([*range(6), *first, *range(6), 0, 1, 2, 4, 5, 0, 1, 3, 4, 5])
    assert len(rows) == len(good) + 4 and all(r["payload"] is None for r in rows if r["error"])
    assert any("digest" in (r["error"] or "") for r in rows) and any("no WARC" in (r["error"] or "") for r in rows)
    assert any("bytes, not" in (r["error"] or "") for r in rows)


def test_records_stream_whatever_the_pieces():
    blocks = [b"", b"a\r\n", b"\r\n\r\n", b"x" * 50 + b"\r\n\r\n\r\nWARC/1.1\r\n", b"\r\n"]
    data = b"".join(warc._record([(b"N", b"%d" % i)], b) + b"\r\n\r\n" for i, b in enumerate(blocks))
    pieces = data.split(b"\r\n\r\n")
    got = list(warc.records_in([("one", p) for p in pieces] + [("two", p) for p in pieces]))
    assert [(h[b"n"], b, e) for h, b, e in got] == [(b"%d" % i, b, None) for i, b in enumerate(blocks)] * 2


def test_broken_segments_are_reported():
    whole = warc.chunked(b"payload")
    head = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"

    def decode(parts, total, digest=None):
        return warc.joined_segments("response", digest, total, [{"segment": n, "block": b} for n, b in parts])

    assert decode([(1, head), (2, whole)], len(head + whole)) == (b"payload", None)
    assert decode([(1, head), (3, whole)], len(head + whole))[1] == "segments are missing or repeated"
    assert "not 7" in decode([(1, head), (2, whole)], 7)[1]
    assert decode([(1, head), (2, whole[:-9])], len(head + whole) - 9)[0] is None
    assert "digest" in decode([(1, head), (2, whole)], len(head + whole), "0" * 64)[1]


def test_pipeline_stages_keep_columns_and_take_effect(spark):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    columns, left = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, left, sf)
        assert out.columns == columns
        kept, before = {r["doc_id"] for r in out.collect()}, {r["doc_id"]: r["text"] for r in left.collect()}
        assert kept <= set(before)
        if name == "exact_dedup":
            first = {}
            for i in sorted(before):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", before[i]), i)
            assert kept == set(first.values())
        if name == "decontamination":
            items = [r["text"] for r in table(spark, sf, "benchmark").collect()]
            assert kept == {i for i, t in before.items() if not any(brute_contaminated(t, b) for b in items)}
        left = left.where(F.col("doc_id").isin(sorted(kept)))
    rows = corpus_pipeline.run(spark, sf)
    assert rows.columns == [*columns, "repetition"] and {r["doc_id"] for r in rows.collect()} <= {r["doc_id"] for r in left.collect()}


def test_every_sql_twin_belongs_to_a_query():
    assert set(queries.oracle_sql()) <= set(queries.QUERIES)
