import dataclasses
import uuid

import pytest
from pyspark.sql import functions as F

from placefolio.operators import extraction, reports
from placefolio.params import DEFAULT_CURRENCY, RunParams
from placefolio.plans import build, driver_tables as d
from placefolio.session import shared_folder, staged, staging
from placefolio.sources import folders, objects, tables
from placefolio import schemas


@pytest.fixture
def name(spark):
    name = f"t_{uuid.uuid4().hex}"
    yield name
    tables.drop_table(spark, name, purge=True)


def test_refresh_replaces_rows_and_schema(spark, name):
    path = f"{shared_folder(spark)}/{name}"
    tables.write_table(spark.range(3), name, path)
    again = tables.write_table(spark.createDataFrame([("a", 1)], "s string, n int"), name, path)
    assert again.columns == ["s", "n"] and spark.table(name).count() == 1
    assert tables.write_table(spark.range(4), name, path).columns == ["id"]
    assert tables.write_table(spark.table(name).where("id > 0"), name, path).count() == 3
    managed = tables.write_table(spark.range(2), f"{name}_own")
    assert managed.count() == 2
    tables.drop_table(spark, f"{name}_own")


def test_failed_write_leaves_the_old_table(spark, name):
    path = f"{shared_folder(spark)}/{name}"
    tables.write_table(spark.range(3), name, path)
    with pytest.raises(Exception):
        tables.write_table(spark.range(5).selectExpr("raise_error('broken') AS id"), name, path)
    assert spark.table(name).count() == 3


def test_failure_between_write_and_pointer(spark, name, monkeypatch):
    """Readers find the old rows, the next write goes on, and no folder of the failed one stays for long."""
    path = f"{shared_folder(spark)}/{name}"
    tables.write_table(spark.range(3), name, path)
    point = tables._point
    monkeypatch.setattr(tables, "_point", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        tables.write_table(spark.range(5), name, path)
    monkeypatch.setattr(tables, "_point", point)
    assert spark.table(name).count() == 3 and len(folders.subfolders(spark, path)) == 2
    reader = spark.table(name)
    assert tables.write_table(spark.range(6), name, path).count() == 6
    # The version before is still there for a reader that has begun; the failed one is gone.
    assert reader.count() == 3 and len(folders.subfolders(spark, path)) == 2
    for n in range(4):
        tables.write_table(spark.range(n), name, path, keep=3)
    assert len(folders.subfolders(spark, path)) == 3 and spark.table(name).count() == 3
    tables.drop_table(spark, name, purge=True)
    assert folders.subfolders(spark, path) == [] and not spark.catalog.tableExists(name)


def test_replaced_keys_rewrite_their_buckets_only(spark, name):
    path = f"{shared_folder(spark)}/{name}"
    rows = spark.range(200).selectExpr("concat('p', id % 40) AS place_id", "id AS v")
    old = tables.write_table(rows, name, path, key="place_id", buckets=8)
    assert old.columns == ["place_id", "v"] and old.count() == 200
    before = set(old.inputFiles())
    new = spark.createDataFrame([("p3", 1), ("p3", 2)], "place_id string, v long")
    # p4 is in scope and has no row any more.
    scope = spark.createDataFrame([("p3",), ("p4",)], "place_id string")
    now = tables.replace_keys(new, name, scope)
    want = {tuple(r) for r in rows.where("place_id NOT IN ('p3', 'p4')").collect()} | {("p3", 1), ("p3", 2)}
    assert {tuple(r) for r in now.collect()} == want
    buckets = {r[0] for r in scope.select(tables.bucket_of("place_id", 8)).collect()}
    kept = {f for f in before if f.split("_bucket=")[1].split("/")[0] not in map(str, buckets)}
    assert len(kept) > 1 and kept <= set(now.inputFiles()) and len(before - set(now.inputFiles())) == len(buckets)
    with pytest.raises(ValueError):
        tables.replace_keys(new.withColumn("more", F.lit(1)), name, scope)


def test_replaced_keys_of_odd_tables(spark, name):
    path = f"{shared_folder(spark)}/{name}"
    schema = "place_id string, v long"
    none = spark.createDataFrame([], schema)
    assert tables.write_table(none, name, path, key="place_id", buckets=4).collect() == []
    scope = spark.createDataFrame([("a",)], "place_id string")
    assert tables.replace_keys(none, name, scope).collect() == []
    rows = spark.createDataFrame([("a", 1), (None, 2), ("b", 3), ("b", 3)], schema)
    assert tables.replace_keys(rows, name, scope).count() == 4
    # A bucket may end up empty; rows without a key stay.
    left = tables.replace_keys(none, name, rows.select("place_id"))
    assert [tuple(r) for r in left.collect()] == [(None, 2)]
    tables.write_table(rows, name, path)
    with pytest.raises(ValueError):
        tables.replace_keys(rows, name, scope)


def test_added_rows_become_one_folder_after_a_while(spark, name, monkeypatch):
    monkeypatch.setattr(tables, "MAX_PARTS", 3)
    path = f"{shared_folder(spark)}/{name}"
    sizes = []
    for n in range(1, 6):
        assert tables.append_rows(spark.range(n), name, path).count() == n * (n + 1) // 2
        sizes.append(len(tables.table_state(spark, name)["versions"][-1]))
    assert sizes == [1, 2, 3, 1, 2]


def test_staged_folders_go_at_the_end_of_their_scope(spark):
    with pytest.raises(ZeroDivisionError), staging(spark, keep=("kept",)):
        gone, kept = staged(spark.range(2), "gone"), staged(spark.range(3), "kept")
        folder = gone.inputFiles()[0].rpartition("/")[0]
        raise ZeroDivisionError
    assert kept.count() == 3 and folders.subfolders(spark, folder) == []
    with pytest.raises(Exception):
        gone.count()


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    assert {tuple(r) for r in tables.upsert(old, new, "k").collect()} == {("a", 1), ("b", 3), ("c", 4)}


def test_only_new_files_are_read(spark, tmp_path):
    import os
    for n, name in enumerate(("a.pdf", "b.pdf", "c.txt")):
        (tmp_path / name).write_bytes(b"x" * (n + 1))
        os.utime(tmp_path / name, (1000 + n, 1000 + n))
    first = objects.new_files(spark, str(tmp_path), None, "*.pdf")
    known = staged(first.select("path", "modificationTime", "length"), "known")
    assert known.count() == 2 and objects.new_files(spark, str(tmp_path), known, "*.pdf").collect() == []
    # An old file that came late, and one that changed.
    (tmp_path / "late.pdf").write_bytes(b"late")
    os.utime(tmp_path / "late.pdf", (500, 500))
    (tmp_path / "b.pdf").write_bytes(b"changed")
    again = objects.new_files(spark, str(tmp_path), known, "*.pdf").select("path", "modificationTime", "length", "content")
    assert {(r["path"].rsplit("/", 1)[1], bytes(r["content"])) for r in again.collect()} == {("late.pdf", b"late"), ("b.pdf", b"changed")}
    both = known.unionByName(again.drop("content"))
    assert {(r["path"].rsplit("/", 1)[1], r["length"]) for r in objects.latest_files(both).collect()} == {
        ("a.pdf", 1), ("b.pdf", 7), ("late.pdf", 4)}


def test_file_scan(spark, tmp_path):
    (tmp_path / "p1").mkdir()
    (tmp_path / "p1" / "menu_a%2Fb.pdf").write_bytes(b"12345")
    (tmp_path / "big.pdf").write_bytes(b"x" * 50)
    (tmp_path / "other.txt").write_bytes(b"x")
    got = {r["path"].rsplit("/", 1)[1]: (r["length"], r["content"] and bytes(r["content"]))
           for r in objects.scan_files(spark, str(tmp_path), "*.pdf").collect()}
    assert got == {"menu_a%2Fb.pdf": (5, b"12345"), "big.pdf": (50, b"x" * 50)}


@pytest.mark.parametrize("whole_bytes", [0, 999, 1000, objects.WHOLE_BYTES])
def test_digests_of_files_read_in_pieces(spark, tmp_path, whole_bytes):
    import gzip
    import hashlib
    import random
    body, mark = random.Random(7).randbytes(200_000), b"\xef\xbb\xbf"
    contents = {
        "ends_with_feed": body + b"\n", "ends_without": body + b"x", "mark": mark + body + b"\n", "mark_without": mark + body + b"x",
        "two_marks": mark + mark + b"\n" + body, "mark_line": mark + b"\n" * 3_000, "feeds": b"\n" * 90_000, "no_feed": b"\0" * 90_000,
        "crlf": b"a\r\n" * 30_000, "odd %41#?": body[::-1], "p1/same": body, "p2/same": body[1:], "small": b"y" * 1_000,
        "tiny_mark": mark + b"\n", "packed.gz": gzip.compress(body), "not_packed.gz": body}
    for name, content in contents.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 15))  # a file has several splits
    try:
        got = objects.file_digests(spark, str(tmp_path), whole_bytes=whole_bytes).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r["path"].split(f"{tmp_path}/")[1], *r[1:]) for r in got) == sorted(
        (name, len(c), len(c), hashlib.sha256(c).hexdigest()) for name, c in contents.items())


def test_large_files_are_never_one_value(spark, tmp_path):
    import hashlib
    import random

    from placefolio.plans.registry import QUERIES
    contents = {"a.parquet": random.Random(8).randbytes(objects.WHOLE_BYTES + 1), "b.parquet": b"x" * 2_000}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    # Spark refuses to make a value of a file over this size.
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", str(objects.WHOLE_BYTES))
    try:
        got = QUERIES["binary_docs_scan"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert sorted(map(tuple, got)) == [
        (name, len(c), len(c), hashlib.sha256(c).hexdigest()) for name, c in sorted(contents.items())]


def test_parameters():
    params = RunParams.from_strings(" a, ,b,", "10", "20", "  ", "true")
    assert (params.search_queries, params.target_count, params.max_sites, params.currency, params.reset_tables) == (
        ("a", "b"), 10, 20, DEFAULT_CURRENCY, True)
    assert RunParams.from_strings(currency=" EUR ").currency == "EUR"
    uncapped = RunParams.from_strings(target_count=" ", max_sites="")
    assert uncapped.target_count is None and uncapped.max_sites is None


@pytest.fixture
def schema(spark):
    namespace = f"run_{uuid.uuid4().hex}"
    location = f"{shared_folder(spark)}/{namespace}"
    spark.sql(f"CREATE SCHEMA {namespace} LOCATION '{location}'")
    yield namespace, location
    spark.sql(f"DROP SCHEMA {namespace} CASCADE")


def test_whole_run(spark, sf_dir, schema):
    namespace, location = schema

    def extract(prompt):
        text = prompt.removeprefix(extraction.PROMPT)
        return '{"items":[]}' if "the" not in text else \
            '{"items":[{"section":"s","item_name":"%s","description":null,"price":1.5}]}' % len(text)

    params = RunParams(target_count=60, max_sites=40, hints=d.PARAMS.hints, table_buckets=4)
    run = lambda p: build.build_catalogue(
        spark, d.search_pages(spark, sf_dir), d.fetch_log(spark, sf_dir), d.rules(spark, sf_dir), namespace, p,
        extract_fn=extract, location=location, keep_objects=True, call_partitions=6).first()
    staging_folder = f"{shared_folder(spark)}/placefolio"
    for table in (d.search_pages, d.fetch_log, d.rules):
        table(spark, sf_dir)
    before_run = set(folders.subfolders(spark, staging_folder))
    for _ in range(2):  # a second run replaces the first
        summary = run(params)
    # The summary was counted while the tables were written, and is what a second look gives.
    assert summary == reports.run_summary(spark.table(f"{namespace}.restaurants"), spark.table(f"{namespace}.menu_items")).first()
    left = set(folders.subfolders(spark, staging_folder)) - before_run
    assert len(left) == 1 and next(iter(left)).startswith(build.SOURCE_TEXTS)
    assert spark.table("menu_source_text").count() > 0
    # A smaller run that replaces only its own places.
    before = {r["place_id"] for r in spark.table(f"{namespace}.restaurants").collect()}
    again = run(dataclasses.replace(params, target_count=20, upsert=True))
    assert again["restaurants"] == 60 and {r["place_id"] for r in spark.table(f"{namespace}.restaurants").collect()} == before
    assert again == summary
    places = spark.table(f"{namespace}.restaurants")
    assert summary["restaurants"] == places.count() == 60
    assert summary["menu_items"] == spark.table(f"{namespace}.menu_items").count() > 0
    assert spark.table(f"{namespace}.menu_documents").count() <= 40
    assert places.columns == schemas.SILVER.fieldNames() + ["menu_status", "menu_item_count"]
    for table, schema_of in (("restaurants_bronze", schemas.BRONZE), ("restaurants_silver", schemas.SILVER),
                             ("menu_documents", schemas.DOCUMENTS), ("menu_items", schemas.ITEMS)):
        assert [(f.name, f.dataType) for f in spark.table(f"{namespace}.{table}").schema] == [(f.name, f.dataType) for f in schema_of]
    kept = {r["stored_path"]: r["n"] for r in spark.table(f"{namespace}.raw_objects")
            .selectExpr("stored_path", "octet_length(content) AS n").collect()}
    stored = {r["stored_path"] for r in spark.table(f"{namespace}.menu_documents").where("stored_path IS NOT NULL").collect()}
    assert stored and stored <= set(kept) and min(kept.values()) > 0
    assert {r["menu_status"] for r in places.select("menu_status").distinct().collect()} >= {"menu_extracted", "no_website"}
    assert spark.table(f"{namespace}.call_errors").columns == ["stage", "place_id", "source_url", "error"]
    for name in build.ALL_TABLES[:7]:
        assert len({f.split("/")[-3] for f in spark.table(f"{namespace}.{name}").inputFiles()}) <= 3
    # A reset leaves nothing of the run before, tables that the new run does not write included.
    fewer = dataclasses.replace(params, target_count=10, reset_tables=True)
    assert build.build_catalogue(spark, d.search_pages(spark, sf_dir), d.fetch_log(spark, sf_dir), d.rules(spark, sf_dir), namespace,
                                 fewer, extract_fn=extract, location=location).first()["restaurants"] == 10
    assert not spark.catalog.tableExists(f"{namespace}.raw_objects")
    assert folders.subfolders(spark, f"{location}/raw_objects") == []


def page(text):
    return f"<html><body><p>{text}</p></body></html>".encode()


def recorded(spark, bodies, attempts=()):
    """Search page and fetch log of places p1, p2, …; a body is a page, None a failed fetch."""
    places = ", ".join(f'{{"id": "p{n}", "displayName": {{"text": "Place {n}"}}, "websiteUri": "http://s{n}.example.com/"}}'
                       for n in bodies)
    pages = spark.createDataFrame([(0, 0, 0, f'{{"places": [{places}]}}', None)],
                                  "query_ord long, page_no long, first_pos long, response string, error string")
    rows = [(f"http://s{n}.example.com/", 200 if b else None, None if b else "URLError: timed out", "text/html", b, 0)
            for n, b in bodies.items()]
    log = spark.createDataFrame(rows + list(attempts), "url string, http_status int, error string, content_type string, "
                                                       "content binary, attempt_no int")
    rules = spark.createDataFrame([], "robots_url string, group_ord long, agent string, rule_ord long, path_prefix string, allow boolean")
    return pages, log if attempts else log.drop("attempt_no"), rules


def test_upsert_takes_away_what_a_place_no_longer_has(spark, schema):
    namespace, location = schema
    rows = lambda name, *columns: {tuple(r) for r in spark.table(f"{namespace}.{name}").select(*columns).collect()}

    def extract(prompt):
        if "broken" in prompt:
            raise ValueError("no answer")
        return '{"items":[5]}' if "odd" in prompt else extraction.rule_extractor(prompt)

    def run(bodies, **kw):
        params = RunParams(min_text_chars=5, table_buckets=4, keep_rejects=True, **kw)
        return build.build_catalogue(spark, *recorded(spark, bodies), namespace, params, extract_fn=extract, location=location,
                                     keep_objects=True).first()

    run({1: page("Red Soup 4.50"), 2: page("Green Soup 5.50"), 3: page("broken text"), 4: page("Blue Soup 6.50")})
    # The default extractor knows neither section nor description.
    assert rows("response_rejects", "place_id", "pos", "rule") == {
        (p, 0, f"{name} missing") for p in ("p1", "p2", "p4") for name in ("section", "description")}
    assert rows("call_errors", "place_id") == {("p3",)}
    assert len(rows("menu_items", "place_id")) == 3 and len(rows("raw_objects", "place_id")) == 4
    untouched = {f for f in spark.table(f"{namespace}.menu_items").inputFiles()}
    # p1 has no items any more, p2 cannot be fetched, p4 has lost its website's text; p3 is not found.
    summary = run({1: page("nothing priced"), 2: None, 4: page("")}, upsert=True)
    assert rows("menu_items", "place_id") == set()
    assert rows("raw_objects", "place_id") == {("p1",), ("p3",), ("p4",)}
    assert rows("call_errors", "place_id", "error") == {("p3", "ValueError: no answer")}
    assert rows("restaurants", "place_id", "menu_status") == {
        ("p1", "source_found_no_items"), ("p2", "fetch_failed"), ("p3", "source_found_no_items"), ("p4", "no_menu_found")}
    assert rows("menu_documents", "place_id", "doc_type") == {("p1", "html"), ("p2", "fetch_failed"), ("p3", "html"), ("p4", "none")}
    assert summary["restaurants"] == 4 and summary["menu_items"] == 0 and untouched
    # p3 comes back with items: its error goes.
    assert rows("response_rejects", "rule") == set()
    run({1: page("odd text")}, upsert=True)
    assert rows("response_rejects", "place_id", "pos", "rule") == {("p1", 0, "item is no object")}
    run({3: page("Gold Soup 7.50")}, upsert=True)
    assert rows("menu_items", "place_id", "item_name") == {("p3", "Gold Soup")} and rows("call_errors", "place_id") == set()


def test_a_later_success_wins(spark, schema):
    namespace, location = schema
    url = "http://s1.example.com/"
    tries = [(url, None, "URLError: timed out", None, None, 1), (url, 200, None, "text/html", page("Red Soup 4.50"), 2),
             (url, 503, "HTTP Error 503", None, None, 3), ("http://other.example.com/", 200, None, "text/html", page("x"), 1)]
    pages, log, rules = recorded(spark, {1: None}, tries)
    build.build_catalogue(spark, pages, log, rules, namespace, RunParams(min_text_chars=5, table_buckets=2), location=location,
                          keep_objects=True)
    assert [r["menu_status"] for r in spark.table(f"{namespace}.restaurants").collect()] == ["menu_extracted"]
    assert spark.table(f"{namespace}.raw_objects").count() == 1
    # Without numbers the log must have one row per URL.
    with pytest.raises(ValueError):
        build.build_catalogue(spark, pages, log.drop("attempt_no"), rules, namespace, RunParams(min_text_chars=5), location=location)


def test_answers_are_asked_for_once(spark, schema, tmp_path):
    namespace, location = schema
    calls = str(tmp_path)

    def extract(prompt):
        import os
        import uuid as u
        open(os.path.join(calls, u.uuid4().hex), "w").close()
        if "broken" in prompt:
            raise ValueError("no answer")
        return '{"items":[{"section":"s","item_name":"n","description":null,"price":1.5}]}'

    def run(bodies, label, **kw):
        before = len(os.listdir(calls))
        params = RunParams(min_text_chars=5, table_buckets=2, answers_of=label, **kw)
        build.build_catalogue(spark, *recorded(spark, bodies), namespace, params, extract_fn=extract, location=location)
        return len(os.listdir(calls)) - before

    import os
    bodies = {1: page("same text"), 2: page("same text"), 3: page("other text"), 4: page("broken text")}
    assert run(bodies, "model-1") == 3
    items = {tuple(r) for r in spark.table(f"{namespace}.menu_items").select("place_id", "item_name").collect()}
    # Failed calls are tried again, and only they; a new text and a new name are asked for.
    assert run(bodies, "model-1") == 1 and spark.table(f"{namespace}.call_errors").count() == 1
    assert {tuple(r) for r in spark.table(f"{namespace}.menu_items").select("place_id", "item_name").collect()} == items
    assert run({1: page("same text"), 5: page("new text")}, "model-1") == 1
    assert run({1: page("same text")}, "model-2") == 1
    assert run({4: page("broken text")}, "model-1", call_attempts=3) == 3
    assert run({1: page("same text")}, "") == 1


def test_run_over_stored_objects(spark, sf_dir, schema, tmp_path):
    namespace, location = schema
    log, pages, rules = d.fetch_log(spark, sf_dir), d.search_pages(spark, sf_dir), d.rules(spark, sf_dir)
    params = dataclasses.replace(d.PARAMS, table_buckets=2)
    read, files = str(tmp_path / "read"), tmp_path / "store" / "raw"
    files.mkdir(parents=True)

    def parse(content):
        import os
        import uuid as u
        os.makedirs(read, exist_ok=True)
        open(os.path.join(read, u.uuid4().hex), "w").close()
        if content.endswith(b"broken"):
            raise ValueError("not a document")
        return {"text": content.decode("utf-8", "ignore")}

    run = lambda **kw: build.build_catalogue(spark, pages, log, rules, namespace, params, parse_fn=parse,
                                             location=location, **kw)
    run()
    of_log = {tuple(r) for r in spark.table("menu_source_text").collect()}
    # The chosen documents as files, and one that no place has chosen.
    stored = (spark.table(f"{namespace}.menu_documents").where("doc_type = 'pdf'").select("stored_path", F.col("source_url").alias("url"))
              .join(log.select("url", "content"), "url").collect())
    for r in stored:
        target = tmp_path / "store" / r["stored_path"]
        target.parent.mkdir(parents=True, exist_ok=True)
        target.with_name(target.name if target.name.endswith(".pdf") else target.name + ".pdf").write_bytes(bytes(r["content"]))
    (files / "nobody.pdf").write_bytes(b"x")
    count = lambda: len(os.listdir(read))
    import os
    before = count()
    run(objects=str(tmp_path / "store"))
    assert {tuple(r) for r in spark.table("menu_source_text").collect()} == of_log and stored
    assert count() - before == len(stored) + 1
    # Nothing new, then one file that changes and cannot be read any more.
    before = count()
    run(objects=str(tmp_path / "store"))
    assert count() == before and {tuple(r) for r in spark.table("menu_source_text").collect()} == of_log
    broken = tmp_path / "store" / stored[0]["stored_path"]
    broken.write_bytes(b"broken")
    run(objects=str(tmp_path / "store"))
    assert count() == before + 1 and len(of_log) - spark.table("menu_source_text").count() == 1
    assert [r["error"] for r in spark.table(f"{namespace}.call_errors").where("stage = 'document'").collect()] == [
        "ValueError: not a document"]


def test_no_text_limit_keeps_whole_documents(spark, sf_dir):
    namespace = f"run_{uuid.uuid4().hex}"
    location = f"{shared_folder(spark)}/{namespace}"
    spark.sql(f"CREATE SCHEMA {namespace} LOCATION '{location}'")
    params = dataclasses.replace(d.PARAMS, max_text_chars=None)
    build.build_catalogue(spark, d.search_pages(spark, sf_dir), d.fetch_log(spark, sf_dir), d.rules(spark, sf_dir),
                          namespace, params, parse_fn=lambda content: {"text": "x" * 30_000}, location=location)
    documents = spark.table(f"{namespace}.menu_documents").where("doc_type = 'pdf'").select("place_id", "source_url")
    texts = {r["source_text"] for r in spark.table("menu_source_text").join(documents, ["place_id", "source_url"]).collect()}
    assert texts == {'{"text":"' + "x" * 30_000 + '"}'}
    spark.sql(f"DROP SCHEMA {namespace} CASCADE")


def test_command_line(spark, sf_dir):
    import json

    from placefolio.__main__ import main
    root = f"{shared_folder(spark)}/cli-{uuid.uuid4().hex}"
    inputs = {"search-pages": d.search_pages(spark, sf_dir), "fetch-log": d.fetch_log(spark, sf_dir), "rules": d.rules(spark, sf_dir)}
    for name, df in inputs.items():
        df.write.parquet(f"{root}/{name}")
    namespace = f"cli_{uuid.uuid4().hex}"
    result = main([f"--{name}={root}/{name}" for name in inputs]
                  + [f"--namespace={namespace}", f"--location={root}/tables", "--target-count=30", "--max-sites=10",
                     "--answers-of=rules", "--keep-rejects"])
    assert json.loads(result)["restaurants"] == 30
    assert spark.table(f"{namespace}.extraction_answers").count() > 0 and spark.catalog.tableExists(f"{namespace}.response_rejects")
    spark.sql(f"DROP SCHEMA {namespace} CASCADE")
