import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from placefolio.llm import packing, queries
from placefolio.llm.common import table

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def checked(rows, ids_of, window=2048):
    """Every document whole, every sequence gapless and within the window; returns the sequences' lengths."""
    documents, sequences = {}, {}
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] > 0
        documents.setdefault(r["doc_id"], []).append((r["start"], ids.tolist(), r["doc_tokens"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc_id, want in ids_of.items():
        pieces, at = sorted(documents.pop(doc_id)), 0
        got = []
        for start, ids, total in pieces:
            assert start == at and total == len(want)
            got += ids
            at += len(ids)
        assert got == want
    assert not documents
    lengths = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        lengths.append(at)
    return lengths


def test_pieces_make_up_the_documents(docs, plain):
    r = random.Random(4)
    words = ["Ab", "don't", "x" * 300, "é ü", "12,5", "ẛ̣", "á", "<|endoftext|>", "日本語", "A\x1cB", "Σας", "!?"]
    texts = [" ".join(r.choice(words) for _ in range(r.choice((0, 1, 5, 40, 300)))) for _ in range(60)]
    texts += [None, "", " \t\x0b\n ", "a  b\r\nc"]
    rows = packing.pack(docs(texts, ("ids", "piece", "bucket")), PATH, window=256).collect()
    checked(rows, {i: plain(t) for i, t in enumerate(texts)}, 256)


def test_ids_equal_those_of_the_whole_text(plain):
    r = random.Random(3)
    parts = ["a", "B", "é", "'", "'s", "'ll", "s", "1", "(", ",", ".", "-", "<|", "|>", "endoftext", "<|endoftext|>", " ", "  ", "\u0301",
             "İ", "ß", "Σ", "\xa0", "\u2028", "日", "\x1c", "_", "ﬁ", "²", "'re", '"', "\\", "`", "~", "\u0958", "\u0338", "=", "\x85"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(4000)]
    texts += ["".join(chr(r.choice((r.randrange(32, 127), r.randrange(160, 0x400), r.randrange(0x400, 0xd000)))) for _ in range(12))
              for _ in range(2000)]
    definition = open(PATH, encoding="utf-8").read()
    ids, ends = packing.encode(pa.array(texts), definition, 1)
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [plain(t) for t in texts]
    # A tokenizer that does not mark the ends of words is asked word by word; words are its only bound.
    other = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    one = Tokenizer.from_str(other)
    ids, ends = packing.encode(pa.array(["ab", "cd,", ""]), other, 1)
    assert ids.tolist() == [*one.encode("ab").ids, 1, *one.encode("cd,").ids, 1, 1] and ends.tolist()[-1] == len(ids)


def test_long_texts_are_tokenised_in_parts(docs, plain, monkeypatch):
    monkeypatch.setattr(packing, "_SLICE_BYTES", 100)
    texts = [" ".join(f"word{i}" for i in range(400)), "y" * 900, "short"]
    assert b"".join(packing._parts(texts[0].encode(), 100)).decode() == texts[0]
    parts = [packing._long(pa.scalar(t), open(PATH).read(), 1)[0].tolist() for t in texts]
    assert parts == [plain(t) for t in texts]


def test_odd_rows(odd, empty, plain):
    rows = packing.pack(odd, PATH).collect()
    kept = {}
    for r in odd.collect():
        kept.setdefault(r["doc_id"], []).append(plain(r["text"]))
    total = sum(len(i) for v in kept.values() for i in v)
    assert sum(r["length"] for r in rows) == total and {r["doc_id"] for r in rows} == set(kept)
    for doc_id, copies in kept.items():
        if len(copies) == 1:
            checked([r.asDict() | {"offset": 0, "sequence_id": k} for k, r in enumerate(rows) if r["doc_id"] == doc_id],
                    {doc_id: copies[0]})
    assert packing.pack(empty, PATH).count() == 0


@pytest.mark.parametrize("sizes", [[8, 7, 6, 5, 4], [4, 5, 6, 7, 8] * 20, [1] * 50, [2048] * 7, [3], [1500, 1500, 1500, 10]])
def test_differencing_is_a_partition(sizes):
    for windows in (1, 2, 3, 7):
        found = packing.difference(np.array(sizes), windows)
        assert len(found) == len(sizes) and found.min() >= 0 and found.max() < windows
    # Two windows over 8 7 6 5 4: differencing gives 16 and 14.
    if sizes == [8, 7, 6, 5, 4]:
        assert sorted(np.bincount(packing.difference(np.array(sizes), 2), sizes, 2)) == [14, 16]


def test_window_count_rises_with_the_capacity():
    sizes = np.array([600, 600, 600])
    assert packing.windows_for(sizes, 1000, 2) is None
    assert sorted(packing.windows_for(sizes, 1000, 3)) == [0, 1, 2]
    # One percent more windows than needed do not do, so pieces are cut.
    packed = packing.pack_group(np.array([600] * 300), 1000)
    assert sum(p[2] for p in packed) == 180_000 and len({p[3] for p in packed}) <= 182


def test_query_has_little_padding(spark, sf_dir):
    rows = queries.op12_packing(spark, sf_dir)
    by = rows.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    one = by.agg(F.sum("n").alias("n"), F.count("*").alias("k"), F.max("n").alias("most")).first()
    assert one["most"] <= 2048 and one["k"] * 2048 < 1.02 * one["n"]
    text = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    tokenizer = Tokenizer.from_file(PATH)
    for r in rows.orderBy("doc_id", "start").limit(300).collect():
        ids = [*tokenizer.encode(text[r["doc_id"]] or "", add_special_tokens=False).ids, 1]
        part = np.array(ids[r["start"]:r["start"] + r["length"]], "<u4")
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and len(ids) == r["doc_tokens"]
