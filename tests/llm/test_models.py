import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from placefolio.llm import language, lm_score, quality, queries
from placefolio.llm.common import table


def fold(parts, wanted):
    # A closure travels to the workers by value: they cannot import this module.
    return lambda ids: lm_score.in_fold(ids, parts, wanted)


held_out = fold(7, 2)


def plain(text):
    return b" ".join((text or "").encode().lower().split()) + b"\n"


def ppm(train, text, order):
    """log10 probability by the definition: longest context first, escape of method D, exclusion."""
    counts = defaultdict(Counter)
    for t in train:
        t = bytes(order) + plain(t)
        for i in range(order, len(t)):
            for k in range(order + 1):
                counts[t[i - k:i]][t[i]] += 1
    t, total = bytes(order) + plain(text), 0.0
    for i in range(order, len(t)):
        excluded = set()
        for k in range(order, -1, -1):
            seen = {s: c for s, c in counts.get(t[i - k:i], {}).items() if s not in excluded}
            if not seen:
                continue
            n = sum(seen.values())
            if t[i] in seen:
                total += math.log10((seen[t[i]] - 0.5) / n)
                break
            total += math.log10(len(seen) / (2 * n))
            excluded |= set(seen)
        else:
            total -= math.log10(256 - len(excluded))
    return total


def texts(seed, n=40):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdé") for _ in range(r.randint(1, 6))) for _ in range(30)]
    return [" ".join(r.choice(words).title() for _ in range(r.randint(0, 30))) for _ in range(n)]


def test_scores_match_the_definition(docs):
    rows = [*enumerate(texts(1)), (40, None), (41, ""), (41, ""), (None, "abc new")]
    got = lm_score.score_documents(docs(rows), held_out, order=3, block_bytes=500).collect()
    out = {i: bool(lm_score.in_fold(pa.chunked_array([pa.array([i], pa.int64())]), 7, 2)[0]) for i, _ in rows}
    train = [t for i, t in rows if not out[i]]
    c = Counter(w for t in train for w in [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()), None])
    n, v = sum(c.values()), len(c)
    text = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        w = [*re.findall(r"[^\x20\x09-\x0D]+", (text[r["doc_id"]] or "").lower()), None]
        assert r["held_out"] == out[r["doc_id"]] and r["n_tokens"] == len(w) and r["train_tokens"] == n
        assert r["n_known"] == sum(c[x] > 0 for x in w)
        assert abs(r["base_score"] - sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)) < 1e-6
        assert abs(r["score"] - ppm(train, text[r["doc_id"]], 3)) < 1e-3


def test_probabilities_of_a_context_add_up_to_one():
    seen = [b"\0\0\0ab", b"\0\0aba", b"\0abab", b"ababc"]
    key = np.array(sorted(int.from_bytes(g, "big") for g in seen), np.uint64)
    pairs, n = np.unique(key & np.uint64(0xFFFF), return_counts=True)
    for context in (b"\0aba", b"zzab", b"zzzz"):
        asked = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)], np.uint64)
        assert abs((10 ** lm_score.code_lengths(asked, key, np.ones(len(key)), pairs, n, 4)).sum() - 1) < 1e-9


def test_lm_without_rows_and_without_training(docs, empty, odd):
    assert lm_score.score_documents(empty, held_out).count() == 0
    assert lm_score.score_documents(odd, held_out).count() == odd.count()
    row = lm_score.score_documents(docs(["ab"]), lambda ids: np.ones(len(ids), bool)).first()
    assert row["n_known"] == 0 and row["train_tokens"] == 0 and abs(row["score"] + 3 * math.log10(256)) < 1e-5


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op4_quality_classifier(spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out")
    by = {r["quality"]: r for r in rows.groupBy("quality").agg(F.avg("predicted").alias("p"), F.avg(
        (F.col("score") > 0.5).cast("int")).alias("half")).collect()}
    assert by[1]["p"] > 0.98 and by[0]["p"] < 0.35 and by[0]["half"] < 0.1 and by[1]["half"] > 0.97


def test_quality_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, 0), (3, None, 0), (4, 7, 0), (None, 1, 0), (99, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = quality.score_documents(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert {r["score"] for r in quality.score_documents(odd, labels.limit(0)).collect()} == {0.5}
    left = quality.drop_low_quality(odd, labels.limit(0))
    assert left.columns == odd.columns and left.count() == odd.count()
    assert quality.score_documents(empty, labels).count() == 0


def test_languages_on_held_out_documents(spark, sf_dir):
    sf = sf_dir.replace("sf0.001", "sf0.01")
    rows = queries.op3_language_id(spark, sf).where("kind = 'document' and held_out")
    truth = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("truth"))
    assert rows.join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("truth")).cast("int"))).first()[0] > 0.97


def test_evidence_decides_where_the_text_says_nothing(spark):
    long = {"aa": "abab baba abba " * 30, "bb": "cdcd dcdc cddc " * 30}
    train = spark.createDataFrame([(t, lang) for lang, t in long.items()] + [(None, "aa"), ("x", None)], "text string, lang string")
    langs, slots = language.train_text(train)
    assert langs == ["aa", "bb"]
    rows = [(f"{lang}{i}", t, lang, f"{lang}.example.{lang}", f"example.{lang}", lang) for lang, t in long.items() for i in range(20)]
    rows += [("markup", None, "bb", None, None, None), ("suffix", "", None, None, None, "bb"),
             ("host", None, None, "aa.example.aa", "example.aa", None), ("domain", None, None, "new.example.bb", "example.bb", None),
             ("nothing", None, None, None, None, None)]
    df = spark.createDataFrame(rows, "name string, text string, declared string, host string, domain string, suffix string")
    got = {r["name"]: r for r in language.identify(df, langs, slots).collect()}
    assert len(got) == len(rows)
    assert [got[n]["lang"] for n in ("markup", "suffix", "host", "domain")] == ["bb", "bb", "aa", "bb"]
    assert abs(got["nothing"]["posterior"] - 0.5) < 0.05
    assert language.identify(df.limit(0), langs, slots).count() == 0
    assert {r["lang"] for r in language.identify(df, [], slots).collect()} == {None}
    page = spark.createDataFrame([(1, None, None), (2, "no address", "<html LANG='de-DE'><script>x</script>a<b>c")],
                                 "page_id long, url string, html string")
    assert [(r["declared"], r["host"]) for r in language.page_rows(page).orderBy("id").collect()] == [(None, None), ("de", None)]


def brute_languages(rows, train):
    """The fusion written out: one row at a time, with plain dictionaries."""
    def grams(text):
        stream = (text or "").encode().lower()
        stream = b"  " + bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in stream)
        threes = [stream[i:i + 3] for i in range(len(stream) - 2)]
        return [(k, t[:int(k)]) for t in threes if t != b"   " for k in "321"]

    def slot(gram):
        kind, g = gram
        number = int.from_bytes(g, "big") | {"3": 0, "2": 1 << 24, "1": 2 << 24}[kind]
        return int(language._slots(np.array([number], np.uint64))[0])

    langs = sorted({lang for t, lang in train if lang is not None and t is not None})
    counts = {lang: Counter() for lang in langs}
    for t, lang in train:
        if lang is not None and t is not None:
            counts[lang].update(slot(g) for g in grams(t))
    size = {lang: sum(c.values()) + 0.5 * (1 << language.BITS) for lang, c in counts.items()}
    lls, softs = [], []
    for r in rows:
        found = [slot(g) for g in grams(r["text"])]
        raw = [language.TEMPER * sum(math.log((counts[lang][s] + 0.5) / size[lang]) for s in found) for lang in langs]
        lls.append([max(x - max(raw), -language.TEXT_CAP) for x in raw])
        weight = [math.exp(x) for x in lls[-1]]
        softs.append([w / sum(weight) for w in weight])
    n = len(langs)
    overall = [(sum(s[i] for s in softs) + 1) / (len(rows) + n) for i in range(n)]
    out = []
    for k, r in enumerate(rows):
        def others(key):
            if r[key] is None:
                return [0.0] * n
            return [sum(s[i] for j, s in enumerate(softs) if j != k and rows[j][key] == r[key]) for i in range(n)]

        def smooth(c, prior, strength):
            return [(x + strength * p) / (sum(c) + strength) for x, p in zip(c, prior)]

        host = smooth(others("host"), smooth(others("domain"), overall, language.DOMAIN_STRENGTH), language.HOST_STRENGTH)
        score = [a + math.log(b) for a, b in zip(lls[k], host)]
        for key in ("declared", "suffix"):
            score = [a + math.log(b / p) for a, b, p in zip(score, smooth(others(key), overall, language.SMOOTH), overall)]
        best = max(score)
        out.append((langs[score.index(best)], 1 / sum(math.exp(x - best) for x in score), langs[lls[k].index(max(lls[k]))]))
    return out


def language_rows(seed=1, n=60):
    r = random.Random(seed)
    alphabet = {"aa": "abé", "bb": "cdé", "cc": "eaf"}
    word = lambda lang: "".join(r.choice(alphabet[lang]) for _ in range(r.randint(1, 5)))
    train = [(" ".join(word(lang) for _ in range(30)), lang) for lang in alphabet for _ in range(5)] + [(None, "aa"), ("x", None)]
    rows = []
    for i in range(n):
        lang = r.choice(sorted(alphabet))
        text = r.choice([None, "", " ".join(word(lang).title() for _ in range(r.randint(1, 6)))])
        domain = r.choice([None, f"{lang}.org", "all.net"])
        rows.append({"id": i, "text": text, "declared": r.choice([None, lang, "zz"]), "domain": domain,
                     "host": domain and r.choice([f"w{r.randint(1, 3)}.", ""]) + domain, "suffix": domain and domain[-3:]})
    return train, [*rows, rows[0], rows[5]]


@pytest.mark.parametrize("at_once", [256, 2])
def test_language_fusion_matches_the_definition(spark, monkeypatch, at_once):
    monkeypatch.setattr(language, "LANGUAGES_AT_ONCE", at_once)
    train, rows = language_rows()
    langs, counts = language.train_text(spark.createDataFrame(train, "text string, lang string"))
    # Columns with the names the operator works with.
    named = [r | {"ll": 1.0, "soft": "s", "logs": "l", "host_n": "h", "lang": "own", "host_p": "p", "sums": "u"} for r in rows]
    df = spark.createDataFrame(named, "id int, text string, declared string, domain string, host string, suffix string, ll double, "
                                      "soft string, logs string, host_n string, lang string, host_p string, sums string")
    got = language.identify(df.repartition(3), langs, counts)
    assert got.columns == [c for c in df.columns if c not in ("text", "lang")] + ["lang", "posterior", "text_lang"]
    by_id = {r["id"]: r for r in got.collect()}
    assert got.count() == len(rows)
    for r, (lang, posterior, text_lang) in zip(rows, brute_languages(rows, train)):
        assert by_id[r["id"]]["lang"] == lang and abs(by_id[r["id"]]["posterior"] - posterior) < 1e-5
        assert by_id[r["id"]]["text_lang"] == text_lang and by_id[r["id"]]["host_n"] == "h"


def test_a_lone_page_is_no_evidence_for_its_host(spark):
    train, _ = language_rows()
    langs, counts = language.train_text(spark.createDataFrame(train, "text string, lang string"))
    rows = [("alone", "ab ba", "only.org", "only.org"), ("without", "ab ba", None, None)]
    df = spark.createDataFrame([(n, t, None, h, d, None) for n, t, h, d in rows],
                               "name string, text string, declared string, host string, domain string, suffix string")
    got = {r["name"]: r["posterior"] for r in language.identify(df, langs, counts).collect()}
    assert abs(got["alone"] - got["without"]) < 1e-9


def test_more_languages_than_are_counted_at_once(spark, monkeypatch):
    monkeypatch.setattr(language, "_COUNTED_AT_ONCE", 3)
    monkeypatch.setattr(language, "LANGUAGES_AT_ONCE", 4)
    rows = [(" ".join([chr(97 + i) * 4] * 20), f"l{i:02}") for i in range(15)]
    langs, counts = language.train_text(spark.createDataFrame(rows, "text string, lang string").coalesce(1))
    assert langs == [f"l{i:02}" for i in range(15)]
    df = spark.createDataFrame([(t, lang, None, None, None, None) for t, lang in rows],
                               "text string, truth string, declared string, host string, domain string, suffix string")
    assert {(r["lang"], r["truth"]) for r in language.identify(df, langs, counts).collect()} == {(lang, lang) for _, lang in rows}


def test_languages_of_odd_tables(spark, odd, empty, sf_dir):
    pages = spark.createDataFrame([(1, None, None), (None, "no address", ""), (1, "http://a.com:80/", "<html lang=x>b</html>")],
                                  "page_id long, url string, html string")
    rows = language.identify_corpus(odd, pages)
    assert rows.count() == odd.count() + 3
    assert language.identify_corpus(empty, pages.limit(0)).count() == 0
    assert {r["lang"] for r in language.identify_corpus(empty, pages).collect()} == {None}


def test_grams_take_few_bytes_of_memory_each():
    import tracemalloc

    def peak(fn):
        tracemalloc.start()
        try:
            return fn(), tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    rng = random.Random(3)
    texts = pa.array([" ".join("".join(rng.choices("etaoinshr", k=rng.randint(1, 9))) for _ in range(2_000)) for _ in range(400)])
    (every, sizes), used = peak(lambda: lm_score.grams(texts, lm_score.ORDER))
    assert len(every) == sizes.sum() > 4_000_000
    # The result alone takes eight, the texts before and after they are joined some four.
    assert used < 20 * len(every)
    keys = np.unique(every)
    at, used = peak(lambda: lm_score.places(keys, every))
    assert (keys[at] == every).all()
    assert used < 20 * len(every), used / len(every)
