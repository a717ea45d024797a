import json
import random

from placefolio import schemas
from placefolio.operators import discover

PAGES = "query_ord bigint, page_no bigint, first_pos bigint, response string, error string"


def naive(queries, target):
    """Page through the queries one by one as a client would."""
    found = []
    for pages in queries:
        if len(found) >= target:
            break
        for page in pages[:3]:
            if page is None or len(found) >= target:
                break
            places, has_next = page
            found += [p for i, p in enumerate(places) if p and p not in found and p not in places[:i]]
            if not has_next:
                break
    return found[:target]


def recorded(queries):
    rows = []
    for q, pages in enumerate(queries):
        for n, page in enumerate(pages):
            if page is None:
                rows.append((q, n, 0, None, "HTTP 500") if (q + n) % 2 else (q, n, 0, '{"places": [', None))
                continue
            places, has_next = page
            body = {"places": [{"id": p} if p is not None else {} for p in places]} if places else {}
            rows.append((q, n, 0, json.dumps(body | ({"nextPageToken": "t"} if has_next else {})), None))
    return rows


def test_discovery_equals_a_paging_loop(spark):
    rng = random.Random(5)
    for _ in range(3):
        queries = [[None if rng.random() < 0.1 else
                    ([rng.choice([None, ""] + [f"p{i}" for i in range(40)]) for _ in range(rng.randint(0, 6))], rng.random() < 0.8)
                    for _ in range(rng.randint(0, 5))] for _ in range(8)]
        df = spark.createDataFrame(recorded(queries), PAGES).repartition(3)
        for target in (5, 17, 1000):
            rows = discover.discover(df, target).orderBy(*discover.DISCOVERY_ORDER).collect()
            assert [r["place_id"] for r in rows] == naive(queries, target)


def test_a_query_ends_at_a_page_that_was_not_recorded(spark):
    rows = [(0, 0, 0, '{"places": [{"id": "a"}], "nextPageToken": "t"}', None),
            (0, 2, 0, '{"places": [{"id": "c"}]}', None), (1, 1, 0, '{"places": [{"id": "d"}]}', None)]
    got = discover.with_place_id(discover.replay_search(spark.createDataFrame(rows, PAGES))).collect()
    assert [r["place_id"] for r in got] == ["a"]


def test_flatten_places(spark):
    full = {"id": "p1", "displayName": {"text": "N"}, "formattedAddress": "A", "location": {"latitude": 1, "longitude": 2.5},
            "rating": 4, "userRatingCount": 7, "priceLevel": "P", "types": ["a", "b"], "primaryType": "a", "websiteUri": "u",
            "nationalPhoneNumber": "1", "currentOpeningHours": {"weekdayDescriptions": ["Mon", "Tue"]}, "businessStatus": "O",
            "unknown": {"kept": True}}
    bare = {"id": "p2", "currentOpeningHours": {"weekdayDescriptions": []}}
    pages = spark.createDataFrame([(0, 0, 0, json.dumps({"places": [full, bare]}), None)], PAGES)
    found = discover.discover(pages)
    assert {json.dumps(json.loads(r["raw_json"])) for r in found.collect()} == {json.dumps(full), json.dumps(bare)}
    flat = discover.flatten_places(found.select("raw_json"))
    assert [(f.name, f.dataType) for f in flat.schema] == [(f.name, f.dataType) for f in schemas.SILVER]
    one, two = (r.asDict() for r in flat.orderBy("place_id").collect())
    assert list(one.values()) == ["p1", "N", "A", 1.0, 2.5, "a", "a,b", 4.0, 7, "P", "u", "1", "Mon | Tue", "O"]
    assert {k: v for k, v in two.items() if v is not None} == {"place_id": "p2", "types": ""}


def test_queries_are_numbered_by_the_parameter_list(spark):
    pages = spark.createDataFrame([("b", 0), ("a", 0), ("other", 0)], "search_query string, page_no bigint")
    got = discover.number_queries(pages, ("a", "b")).collect()
    assert {(r["search_query"], r["query_ord"]) for r in got} == {("a", 0), ("b", 1)}


def test_page_sample(spark):
    body = json.dumps({"places": [{"id": f"p{i}", "displayName": {"text": f"n{i}"}} for i in range(7)], "nextPageToken": "t"})
    pages = spark.createDataFrame([(0, 0, 0, body, None), (0, 1, 0, None, "x")], PAGES)
    rows = discover.page_sample(pages).orderBy("pos").collect()
    assert [(r["name"], r["returned"], r["has_next_page_token"]) for r in rows] == [(f"n{i}", 7, True) for i in range(5)]
