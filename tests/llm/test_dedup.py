import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from placefolio.llm import exact_dedup, near_dedup, substring_dedup
from placefolio.llm.components import components
from placefolio.llm.words import words
import pyarrow as pa

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def ids(df):
    return sorted((r["doc_id"] for r in df.collect()), key=lambda i: (i is None, i))


def copies(seed, n=60):
    """Random texts, exact and near copies, and shared passages."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcde") for _ in range(r.randint(1, 4)))
    texts = [" ".join(word() for _ in range(r.randint(0, 120))) for _ in range(n)]
    for _ in range(n):
        w = r.choice(texts).split()
        for _ in range(r.randint(0, 4)):
            if w:
                w[r.randrange(len(w))] = word()
        texts.append(" ".join(w))
        other = r.choice(texts).split()
        at = r.randrange(len(w) + 1)
        texts.append(" ".join(w[:at] + other[:30] + w[at:]))
    return texts


def test_words_match_the_pattern():
    texts = ["", None, " a  b\t", "é\u00a0x\x0b", "x" * 40, "\x00 \x85", "end"]
    w = words(pa.array(texts))
    got = [[bytes(w.buffer[s:e]).decode() for s, e in zip(w.start[a:b], w.end[a:b])] for a, b in zip(w.first, w.first[1:])]
    assert got == [SPLIT.findall(t or "") for t in texts]
    assert len(set(w.hashes().tolist())) == len({x for g in got for x in g})


def test_exact_odd_rows(odd, empty):
    rows = exact_dedup.duplicate_groups(odd).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r["text_sha256"], []).append(r)
    for digest, group in by.items():
        assert sum(r["kept"] for r in group) == 1 and {r["group_size"] for r in group} == {len(group)}
        known = [r["doc_id"] for r in group if r["doc_id"] is not None]
        assert {r["keep_id"] for r in group} == {min(known) if known else None}
    assert hashlib.sha256(b"a b").hexdigest() in by and len(by[hashlib.sha256(b"").hexdigest()]) == 2
    left = exact_dedup.drop_duplicates(odd)
    assert left.columns == odd.columns and ids(left) == [1, 3, 5, 6, 8, 9, 10, 11, None]
    assert exact_dedup.duplicate_groups(empty).count() == 0 and exact_dedup.drop_duplicates(empty).count() == 0


def test_hot_digest_is_decided_without_a_shuffle_of_its_rows(docs):
    df = docs(["same"] * 400 + [f"t{i}" for i in range(100)])
    rows = exact_dedup.duplicate_groups(df).collect()
    assert sum(r["kept"] for r in rows) == 101 and max(r["group_size"] for r in rows) == 400
    frequent = exact_dedup.frequent_digests(df.select(exact_dedup.digest_of().alias("digest")), 1).collect()
    assert [r["digest"] for r in frequent] == [hashlib.sha256(b"same").hexdigest()]


def brute_components(texts, threshold):
    sets = []
    for t in texts:
        w = SPLIT.findall((t or "").lower())
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    root = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i in range(len(texts)):
            for j in range(i):
                both = len(sets[i] & sets[j])
                if sets[i] and sets[j] and 100 * both >= threshold * len(sets[i] | sets[j]):
                    low = min(root[i], root[j])
                    changed |= root[i] != low or root[j] != low
                    root[i] = root[j] = low
    return [len(s) for s in sets], root


@pytest.mark.parametrize("seed,threshold", [(1, 85), (2, 80)])
def test_near_duplicates_match_brute_force(docs, seed, threshold, monkeypatch):
    texts = copies(seed)
    # Small blocks, so that lists and families are dealt out in pairs of blocks.
    monkeypatch.setattr(near_dedup, "LIST_NODES", 8)
    monkeypatch.setattr(near_dedup, "FAMILY_SHINGLES", 300)
    rows = {r["doc_id"]: r for r in near_dedup.near_duplicates(docs(texts), threshold=threshold).collect()}
    sizes, root = brute_components(texts, threshold)
    assert [rows[i]["component_id"] for i in range(len(texts))] == root
    assert [rows[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert [rows[i]["kept"] for i in range(len(texts))] == [i == x for i, x in enumerate(root)]


def test_filters_lose_no_link_that_counts():
    for threshold in (80, 85):
        for kept in range(1, near_dedup.SKETCH + 1):
            least, t = near_dedup.least_overlap(kept, threshold), threshold / 100
            if 100 * kept <= threshold * near_dedup.SKETCH:
                # Sets that fit: any partner has a union that makes at least this many common values necessary.
                assert least == min(c for c in range(kept + 1) if 100 * c >= threshold * kept)
            else:
                tail = sum(math.comb(kept, i) * t ** i * (1 - t) ** (kept - i) for i in range(least))
                assert 1 <= least and tail <= near_dedup.LOSS


def test_giant_groups_hang_together_as_all_their_pairs_do(spark):
    """Numbers are linked if they differ by 3 at most; groups of one chain, of chains far apart, and of strangers."""
    groups = {1: list(range(0, 60)), 2: [*range(100, 130), *range(200, 204), 300], 3: list(range(1000, 1200, 10)), 4: [1, 3, 90]}
    rows = spark.createDataFrame([(g, n, 1, -(-len(m) // 5)) for g, m in groups.items() for n in m],
                                 "g int, node long, weight int, blocks int")
    dealt = []

    def link(df):
        dealt.append(df.count())
        a, b = df.select("g", "i", "j", F.col("node").alias("u")), df.select("g", "i", "j", F.col("node").alias("v"))
        return a.join(b, ["g", "i", "j"]).where("u > v AND u - v <= 3").select("u", "v")

    got = {r["u"]: r["v"] for r in near_dedup._linked(rows, "g", 5, link).collect()}
    want = {n: 0 for n in range(1, 60)} | {n: 100 for n in range(101, 130)} | {n: 200 for n in (201, 202, 203)}
    # 1 and 3 of group 4 are members of the first chain, 90 is alone.
    assert got == want and dealt[0] == sum(map(len, groups.values()))


def test_near_odd_rows(odd, empty):
    rows = near_dedup.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    got = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows}
    assert {(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (10, 1, 1, False), (7, 29_996, 6, False), (None, 1, 1, False)} <= got
    assert sum(r["kept"] for r in rows if r["doc_id"] == 8) == 1
    left = near_dedup.drop_near_duplicates(odd)
    assert left.columns == odd.columns and {3, 4, 5, 8, 11} <= set(ids(left)) and not {2, 7, 10} & set(ids(left))
    assert near_dedup.near_duplicates(empty).count() == 0 and near_dedup.drop_near_duplicates(empty).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (200, 201)], "u long, v long")
    assert {(r["u"], r["v"]) for r in components(edges).collect()} == {(i, 0) for i in range(1, 61)} | {(201, 200)}


def brute_removed(rows, window):
    first = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        w = SPLIT.findall(t or "")
        for p in range(len(w) - window + 1):
            first.setdefault(tuple(w[p:p + window]), i)
    out = []
    for i, t in rows:
        w = SPLIT.findall(t or "")
        gone = set()
        for p in range(len(w) - window + 1):
            owner = first[tuple(w[p:p + window])]
            if owner is not None and (i is None or owner < i):
                gone |= set(range(p, p + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


@pytest.mark.parametrize("window", [1, 5, 13, 50])
def test_substrings_match_brute_force(docs, window):
    rows = list(enumerate(copies(3)))
    got = substring_dedup.remove_repeats(docs(rows), window, block_bytes=2000).collect()
    assert sorted(map(tuple, got)) == sorted(brute_removed(rows, window))


def test_substring_odd_rows(odd, empty, docs):
    from llm_rows import ODD
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    got = sorted((tuple(r) for r in substring_dedup.remove_repeats(odd).collect()), key=key)
    assert got == sorted(brute_removed(ODD, 13), key=key)
    assert substring_dedup.remove_repeats(empty).count() == 0
    assert substring_dedup.remove_repeats(docs([None, ""])).collect()[0]["n_words"] == 0
    assert [substring_dedup.level_lengths(n) for n in (1, 6, 13, 50)] == [[1], [6], [4, 7, 13], [4, 7, 13, 25, 50]]


@pytest.mark.parametrize("shared,levels", [(0, 1), (5, 2), (9, 3), (13, 3)])
def test_levels_end_without_candidates(docs, monkeypatch, shared, levels):
    """Texts that share so many words are followed only as far as they repeat each other."""
    asked = []
    answer = substring_dedup.bl.answer
    monkeypatch.setattr(substring_dedup.bl, "answer", lambda df, fn, name: (asked.append(name), answer(df, fn, name))[1])
    common = " ".join(f"c{i}" for i in range(shared))
    texts = [" ".join([*(f"t{n}w{i}" for i in range(20)), common, *(f"t{n}v{i}" for i in range(20))]) for n in range(6)]
    got = substring_dedup.remove_repeats(docs(texts), block_bytes=300).collect()
    assert sorted(map(tuple, got)) == sorted(brute_removed(list(enumerate(texts)), 13))
    assert len(asked) == levels and sum(r["n_removed"] for r in got) == (65 if shared == 13 else 0)


def test_estimate_is_exact_when_the_union_fits():
    a = np.array([1, 2, 3, 0xFFFFFFFF], np.uint32)
    others = np.array([[1, 2, 3, 0xFFFFFFFF], [2, 3, 4, 0xFFFFFFFF], [9, 0xFFFFFFFF, 0xFFFFFFFF, 0xFFFFFFFF]], np.uint32)
    assert near_dedup._estimates(a, others, 4).tolist() == [1.0, 0.5, 0.0]


def test_question_rows_stay_filled_at_any_size():
    """Bytes of a question row on average, for tables from a few MB to 100 TB in blocks of 8 MB."""
    from placefolio.llm import blocks as bl
    for size in (1e6, 1e9, 1e11, 1e12, 1e13, 1e14):
        total, n_blocks = size * 0.4, int(size / bl.BLOCK_BYTES) + 1
        buckets = bl.buckets_for(total, n_blocks)
        assert total / buckets <= bl.MOST_BUCKET_BYTES
        if size <= 1e13:
            assert total / (buckets * n_blocks) >= bl.ROW_BYTES / 2 or buckets == 1


def test_a_shared_gram_adds_one_entry_per_block(spark, docs):
    """A thousand blocks with one word in common: the bucket of that word gets no more rows than any other bucket."""
    from placefolio.llm import blocks as bl
    n = 200
    texts = [f"same same same same own{i} more{i}" for i in range(n)]
    blocks = bl.pack_blocks(docs(texts).repartition(n), "doc_id", "text", block_bytes=10)
    assert blocks.count() == n

    def ask(block, content):
        from placefolio.llm.words import one_array, words
        keys = np.unique(words(one_array(content["text"])).hashes())
        yield from bl.questions(block, 0, keys, (keys % np.uint64(4)).astype(np.int64), 4)

    rows = bl.each_block(blocks, ask, bl.QUESTIONS)
    per = rows.groupBy("bucket").agg(F.count("*").alias("rows"), F.sum(F.octet_length("keys")).alias("bytes")).collect()
    assert max(r["rows"] for r in per) <= n and sum(r["bytes"] for r in per) == 8 * 3 * n
