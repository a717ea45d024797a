import json

from pyspark.sql import functions as F

from placefolio import schemas
from placefolio.operators import extraction, items

ANSWERS = "place_id string, source_url string, menu_json string"


def answer(*rows):
    return json.dumps({"items": [dict(zip(("section", "item_name", "description", "price"), row)) for row in rows]})


def names_and_types(df):
    return [(f.name, f.dataType) for f in df.schema]


def test_items_from_responses(spark):
    glass, bottle = ("Wine", "Red", "house", 9.5), ("Wine", "Red", "house", 40)
    df = spark.createDataFrame([
        ("p1", "u2", answer(glass, bottle, glass)), ("p1", "u1", answer(glass, ("Wine", None, "x", 1), ("Wine", "  ", "x", 1))),
        ("p2", "u3", answer(glass, (None, "\n", None, None), (None, "\n", None, None))),
        ("p3", "u4", "not json"), ("p3", "u5", None), ("p3", "u6", '{"items":[]}'), ("p3", "u7", '{"other":1}'),
        ("p4", "u8", '{"items":[{"item_name":"Tea","price":"12.5"}]}')], ANSWERS)
    out = items.items_from_responses(df, "EUR")
    assert names_and_types(out) == [(f.name, f.dataType) for f in schemas.ITEMS]
    got = {tuple(r)[:7] for r in out.collect()}
    assert got == {
        ("p1", "u1", "Wine", "Red", "house", 9.5, "EUR"), ("p1", "u2", "Wine", "Red", "house", 40.0, "EUR"),
        ("p2", "u3", "Wine", "Red", "house", 9.5, "EUR"), ("p2", "u3", None, "\n", None, None, "EUR"),
        ("p4", "u8", None, "Tea", None, None, "EUR")}
    again = items.clean_items(out)
    assert again.count() == len(got)


def test_empty_items_have_the_same_columns(spark):
    filled = items.items_from_responses(spark.createDataFrame([("p", "u", answer(("s", "n", "d", 1)))], ANSWERS))
    empty = items.empty_items(spark)
    assert names_and_types(empty) == names_and_types(filled)
    assert empty.count() == 0 and empty.union(filled).count() == 1


def test_response_quality(spark):
    df = spark.createDataFrame([
        ("p", "u", answer(("s", "n", "d", 1), (None, None, "d", None))), ("p", "u", "not json"), ("p", "u", None),
        ("p", "u", '{"items":[]}'), ("p", "u", '{"items":[{"section":"s","item_name":"n","description":"d","price":"1"}]}')],
        ANSWERS)
    assert extraction.response_quality(df).first().asDict() == {
        "responses": 5, "null_responses": 1, "unreadable_responses": 1, "empty_responses": 1, "items": 3,
        "items_without_section": 1, "items_without_name": 1, "items_without_description": 0, "items_without_price": 2}


def test_one_call_per_distinct_text(spark):
    calls, start = spark.sparkContext.accumulator(0), extraction.PROMPT

    def extract(prompt):
        calls.add(1)
        if "broken" in prompt:
            raise RuntimeError("no answer")
        return json.dumps({"items": [{"item_name": prompt.removeprefix(start)}]})

    texts = spark.createDataFrame([(f"p{i}", f"u{i}", text) for i, text in enumerate(["a", "b", "a", "broken", "a", "broken"])],
                                  "place_id string, source_url string, source_text string").repartition(4)
    got = {r["place_id"]: r for r in extraction.extract_items(texts, extract).collect()}
    assert calls.value == 3
    assert len(got) == 6 and got["p3"]["menu_json"] is None and got["p5"]["error"] == "RuntimeError: no answer"
    assert json.loads(got["p2"]["menu_json"])["items"][0]["item_name"] == "a" and got["p2"]["error"] is None


def test_default_extractor_finds_priced_words(spark):
    text = extraction.PROMPT + "Soup of the day $7.50\nbread 2.00, 3.5 x 1.25"
    assert [(i["item_name"], i["price"]) for i in json.loads(extraction.rule_extractor(text))["items"]] == [
        ("Soup of the day", 7.5), ("bread", 2.0), ("x", 1.25)]


def test_document_parser_errors_become_rows(spark):
    def parse(content):
        if content == b"bad":
            raise ValueError("unreadable")
        return {"text": content.decode()}

    df = spark.createDataFrame([("a", b"x" * 30_000), ("b", b"bad"), ("c", None)], "path string, content binary")
    got = {r["path"]: (r["source_text"], r["error"]) for r in extraction.parse_documents(df, parse).collect()}
    assert got["a"] == (('{"text":"' + "x" * 30_000)[:20_000], None)
    assert got["b"] == (None, "ValueError: unreadable") and got["c"] == (None, None)
    whole = {r["path"]: r["source_text"] for r in extraction.parse_documents(df, parse, max_chars=None).collect()}
    assert json.loads(whole["a"]) == {"text": "x" * 30_000} and whole["b"] is None and whole["c"] is None


def test_source_texts(spark):
    docs = spark.createDataFrame([
        ("p1", "u1", "html", None, "a" * 201), ("p2", "u2", "html", None, "a" * 200), ("p3", "u3", "html", None, None),
        ("p4", "u4", "pdf", "/data/raw/p4/menu.pdf", None), ("p5", "u5", "pdf", None, None), ("p6", "u6", "none", None, "a" * 300)],
        "place_id string, source_url string, doc_type string, stored_path string, raw_text string")
    parsed = spark.createDataFrame([("s3a://bucket/data/p4/menu.pdf", "no root"), ("s3a://bucket/data/raw/p4/menu.pdf", "b" * 300), ("s3a://bucket/data/raw/p9/menu.pdf", "c" * 300)],
                                   "path string, source_text string")
    texts = extraction.source_texts(extraction.html_texts(docs), extraction.pdf_texts(docs, parsed))
    assert {(r["place_id"], r["source_text"][0]) for r in texts.collect()} == {("p1", "a"), ("p4", "b")}
    by_url = extraction.pdf_texts_by_url(docs, parsed.select(F.lit("u4").alias("url"), "source_text").limit(1))
    assert by_url.count() == 1
