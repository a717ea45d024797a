import random
from urllib.robotparser import RobotFileParser

from placefolio.operators.robots import rules_from_answers, with_permission

AGENT = "Placefolio/1.0 (+x)"
RULES = "robots_url string, group_ord int, agent string, rule_ord int, path_prefix string, allow boolean"


def as_file(groups):
    lines = []
    for agents, rules in groups:
        lines += [f"User-agent: {agent}" for agent in agents]
        lines += [f"{'Allow' if allow else 'Disallow'}: {path}" for path, allow in rules] + [""]
    return lines


def test_permission_equals_the_standard_library(spark):
    rng = random.Random(11)
    agents = ["*", "otherbot", "place", "PLACEFOLIO", "folio/2", "placefolio/1.0"]
    paths = ["", "/", "/a", "/a/", "/a/b", "/a?x", "/%61", "/ü", "/%C3%BC", "/a%2Fb", "*", "/a?"]
    urls = ["", "/", "/a", "/a/", "/a/b/c", "/a?x=1", "/%61/b", "/ü", "/%C3%BC/1", "/b", "?x", "/a+b", "/a#c", "/b#c", "/%zz"]
    rules, wanted, asked = [], {}, []
    for site in range(40):
        host = f"http://h{site}.example.com"
        groups = [(rng.sample(agents, rng.randint(1, 2)), [(rng.choice(paths), rng.random() < 0.4) for _ in range(rng.randint(1, 5))])
                  for _ in range(rng.randint(0, 4))]
        parser = RobotFileParser()
        parser.parse(as_file(groups))
        for g, (names, lines) in enumerate(groups):
            rules += [(f"{host}/robots.txt", g, name, i, path, allow) for name in names for i, (path, allow) in enumerate(lines)]
        for url in urls:
            asked.append((host + url,))
            wanted[host + url] = parser.can_fetch(AGENT, host + url)
    df = with_permission(spark.createDataFrame(asked, "url string"), spark.createDataFrame(rules, RULES), AGENT)
    got = {r["url"]: r["robots_allowed"] for r in df.collect()}
    assert len(got) == len(asked)
    assert {u: (got[u], wanted[u]) for u in wanted if got[u] != wanted[u]} == {}


def test_server_answers(spark):
    answers = spark.createDataFrame([(f"http://h{code}.example.com/robots.txt", code) for code in (401, 403, 404, 429, 500, 503)],
                                    "robots_url string, http_status int")
    urls = spark.createDataFrame([(f"http://h{code}.example.com/x",) for code in (401, 403, 404, 429, 500, 503)]
                                 + [("http://unknown.example.com/",)], "url string")
    got = {r["url"]: r["robots_allowed"] for r in with_permission(urls, rules_from_answers(answers), AGENT).collect()}
    assert {u for u in got if not got[u]} == {f"http://h{code}.example.com/x" for code in (401, 403, 500, 503)}
    assert len(got) == 7
