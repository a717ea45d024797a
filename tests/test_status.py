from placefolio.operators import reports, status

PLACES = "place_id string, name string, rating double, website_uri string"
DOCS = "place_id string, doc_type string"
ITEMS = "place_id string, section string, item_name string, description string, price double, currency string"


def tables(spark):
    kinds = {"a": "html", "b": "pdf", "c": "robots_blocked", "d": "fetch_failed", "e": "none"}
    places = [(k, f"name {k}", 1.0, f"http://{k}") for k in kinds] + [
        ("f", "name f", 1.0, "http://f"), ("g", "name g", 1.0, ""), ("h", "name h", 1.0, None), ("i", "name i", None, "http://i"),
        ("j", "name j", 1.0, None)]
    docs = list(kinds.items()) + [("i", "none"), ("orphan", "html")]
    items = [("i", "s", "n", "d", 1.0, "AUD"), ("i", "s", "n", "d", 2.0, "AUD"), ("j", "s", "n", "d", 1.0, "AUD"),
             ("orphan", "s", "n", "d", None, "AUD")]
    return (spark.createDataFrame(places, PLACES), spark.createDataFrame(items, ITEMS), spark.createDataFrame(docs, DOCS))


def test_precedence(spark):
    places, items, docs = tables(spark)
    rows = status.place_status(places, items, docs).collect()
    got = {r["place_id"]: (r["menu_status"], r["menu_item_count"]) for r in rows}
    assert len(rows) == places.count()
    assert got == {
        "a": ("source_found_no_items", 0), "b": ("source_found_no_items", 0), "c": ("robots_blocked", 0),
        "d": ("fetch_failed", 0), "e": ("no_menu_found", 0), "f": ("not_attempted", 0), "g": ("not_attempted", 0),
        "h": ("no_website", 0), "i": ("menu_extracted", 2), "j": ("no_website", 1)}
    assert {r["place_id"] for r in status.not_attempted(places, docs).collect()} == {"f", "g"}


def test_reports(spark):
    places, items, docs = tables(spark)
    catalogue = status.place_status(places, items, docs)
    breakdown = reports.status_breakdown(catalogue).collect()
    assert sum(r["restaurants"] for r in breakdown) == places.count()
    assert [r["menu_status"] for r in breakdown][:3] == ["no_website", "not_attempted", "source_found_no_items"]
    summary = reports.run_summary(catalogue, items).first()
    assert tuple(summary)[:4] == (10, 8, 4, 1)
    assert summary["status_breakdown"] == ('{"fetch_failed":1,"menu_extracted":1,"no_menu_found":1,"no_website":2,'
                                           '"not_attempted":2,"robots_blocked":1,"source_found_no_items":2}')
    assert [(r["name"], r["price"]) for r in reports.priced_items(items, catalogue).collect()] == [
        ("name i", 1.0), ("name i", 2.0), ("name j", 1.0)]
    assert [r["price"] for r in reports.item_sample(items, catalogue, 2).collect()] == [1.0, 2.0]


def test_summary_of_nothing(spark):
    places, items, docs = (t.limit(0) for t in tables(spark))
    summary = reports.run_summary(status.place_status(places, items, docs), items).first()
    assert tuple(summary) == (0, 0, 0, 0, "{}")
