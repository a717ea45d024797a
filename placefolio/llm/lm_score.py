"""Language-model scores: prediction by partial matching over bytes, and a word unigram base.

The model is a byte-context trie of order ``ORDER``, with the counts of the training documents. The probability of a byte is
taken at the longest context that has seen it; every longer context pays its escape (method D: half a count per distinct
symbol), and symbols seen there are excluded below. A fixed trie gives every (context, byte) one code length, so blocks count their
distinct grams, tasks that own a gram add these counts up, tasks that own a part of the trie (all contexts with the same last
two bytes) price each gram once, and a document's score is the sum over its bytes. What a part of the trie gets are distinct
grams of the corpus: a frequent context is sent once, not once per block. The text is scored as its lower-cased words, one
space between, and one end byte.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from placefolio.llm import blocks as bl
from placefolio.llm.words import one_array, sketch_hash, words

ORDER = 5
# Text of a block: some 20 bytes of arrays per byte while it is worked on.
BLOCK_BYTES = 5 << 20
# Grams that are worked on at a time where they need several arrays each.
SLICE = 1 << 18
END, SYMBOLS = b"\n", 256
_WORDS, _GRAMS = 0, 1
_WORD_RATE, _GRAM_RATE = 0.3, 0.6


def _mask(n_bytes: int) -> np.uint64:
    return np.uint64((1 << (8 * n_bytes)) - 1)


def grams(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Each byte of the plain texts with the ``order`` bytes before it (zeros before the start) as one number, and the
    number of bytes of each text. A plain text is the lower-cased words with one space between, and an end byte."""
    plain = [b" ".join(t.lower().split()) + END for t in texts.cast(pa.binary()).fill_null(b"").to_pylist()]
    pad = bytes(order)
    stream = np.frombuffer(b"".join([pad + p for p in plain]) + bytes(8), np.uint8)
    sizes = np.array([len(p) for p in plain], np.int64)
    del plain
    eight = np.ndarray(len(stream) - 7, ">u8", stream, strides=(1,))
    out, ends = np.empty(int(sizes.sum()), np.uint64), np.cumsum(sizes)
    # In slices, so that places and copies of the whole block never lie beside the result.
    for low in range(0, len(out), SLICE):
        at = np.arange(low, min(low + SLICE, len(out)))
        at += order * np.searchsorted(ends, at, "right")
        out[low:low + len(at)] = eight[at]
    out >>= np.uint64(8 * (7 - order))
    return out, sizes


def places(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index in ``keys`` (distinct, sorted) of each wanted one, all of which are there: hashed, as searching is slow."""
    bits = max(10, int(len(keys)).bit_length() + 3)
    shift = np.uint64(64 - bits)
    slots = np.zeros(1 << bits, np.int32)
    slots[sketch_hash(keys) >> shift] = np.arange(len(keys))
    out = np.empty(len(wanted), np.int32)
    for low in range(0, len(wanted), SLICE):
        part = wanted[low:low + SLICE]
        found = slots[sketch_hash(part) >> shift]
        other = np.flatnonzero(keys[found] != part)
        found[other] = np.searchsorted(keys, part[other])
        out[low:low + len(part)] = found
    return out


class _Level:
    """Counts of one order: sorted (context, symbol) keys, and per context their total and number of symbols."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, inverse = np.unique(keys, return_inverse=True)
        self.counts = np.bincount(inverse, counts, len(self.keys)).astype(np.float64)
        self.contexts, first, self.symbols = np.unique(self.keys >> np.uint64(8), return_index=True, return_counts=True)
        self.first = first
        self.total = np.add.reduceat(self.counts, first) if len(first) else np.zeros(0)

    @staticmethod
    def find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Places of the keys, -1 where they are missing."""
        if not len(sorted_keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
        return np.where(sorted_keys[at] == keys, at, -1)


def code_lengths(asked: np.ndarray, seen: np.ndarray, counts: np.ndarray, pairs: np.ndarray, pair_counts: np.ndarray,
                 order: int) -> np.ndarray:
    """log10 probability of each asked gram.

    ``seen`` and ``counts`` are the training grams with at least the last two context bytes of the asked ones,
    ``pairs`` and ``pair_counts`` all (last byte, symbol) pairs of the training documents.
    """
    levels = [_Level(pairs & _mask(1), pair_counts), _Level(pairs, pair_counts)][:order + 1]
    levels += [_Level(seen & _mask(k + 1), counts) for k in range(2, order + 1)]
    out = np.zeros(len(asked))
    live = np.arange(len(asked))
    above = np.full(len(asked), -1)
    for k in range(order, -1, -1):
        level, key = levels[k], asked[live] & _mask(k + 1)
        context = level.find(level.contexts, key >> np.uint64(8))
        # What the context one byte longer has seen is excluded here.
        gone = gone_symbols = np.zeros(len(live))
        if k < order and len(levels[k + 1].keys):
            longer = levels[k + 1]
            own = level.counts[level.find(level.keys, longer.keys & _mask(k + 1))]
            excluded = np.add.reduceat(own, longer.first)
            gone = np.where(above >= 0, excluded[above], 0)
            gone_symbols = np.where(above >= 0, longer.symbols[above], 0)
        known = context >= 0
        total = np.where(known, level.total[context] if len(level.total) else 0, 0) - gone
        symbols = np.where(known, level.symbols[context] if len(level.symbols) else 0, 0) - gone_symbols
        place = level.find(level.keys, key)
        hit = known & (place >= 0)
        out[live[hit]] += np.log10((level.counts[place[hit]] - 0.5) / total[hit])
        escape = known & ~hit & (symbols > 0)
        out[live[escape]] += np.log10(symbols[escape] / (2 * total[escape]))
        live, above = live[~hit], context[~hit]
    rest = SYMBOLS - len(levels[0].keys)
    out[live] -= np.log10(rest) if rest else 0
    return out


def _suffix_bucket(grams_: np.ndarray, n: int) -> np.ndarray:
    suffix = (grams_ >> np.uint64(8)) & _mask(2)
    return ((sketch_hash(suffix) >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _bucket(keys: np.ndarray, n: int) -> np.ndarray:
    return ((sketch_hash(keys) >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


class _Block:
    def __init__(self, texts: pa.Table, train: Callable[[pa.ChunkedArray], np.ndarray]):
        self.texts = one_array(texts["text"])
        self.ids = texts["doc_id"]
        self.train = train(self.ids)

    def words(self):
        """Distinct words, their counts in training documents, and per word its number and its document's."""
        w = words(self.texts, lower=True)
        doc = w.document()
        keys, inverse = np.unique(w.hashes(), return_inverse=True)
        counts = np.bincount(inverse[self.train[doc]], minlength=len(keys)).astype(np.uint32)
        return keys, counts, inverse, doc, w.counts

    def grams(self, order: int):
        """Distinct grams and their counts in training documents."""
        every, sizes = grams(self.texts, order)
        every.sort()
        first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
        keys = every[first]
        if self.train.all():
            return keys, np.diff(first, append=len(every)).astype(np.uint32)
        del every
        counts = np.zeros(len(keys), np.uint32)
        own, _ = grams(self.texts.filter(pa.array(self.train)), order)
        own.sort()
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
        counts[np.searchsorted(keys, own[first])] = np.diff(first, append=len(own))
        return keys, counts


def in_fold(ids: pa.ChunkedArray, parts: int, wanted: int) -> np.ndarray:
    """Whether crc32 of each id as text is ``wanted`` modulo ``parts``; a null id counts as the empty text."""
    import zlib
    return np.array([zlib.crc32(b"" if i is None else b"%d" % i) % parts == wanted for i in ids.to_pylist()], bool)


def score_documents(docs: DataFrame, held_out: Callable[[pa.ChunkedArray], np.ndarray], doc_id: str = "doc_id",
                    text: str = "text", order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes``.

    ``held_out`` gets the ids of a block and says which documents the model does not learn from. ``base_score`` is the
    add-one unigram score of the words and the end token, ``score`` the byte model's, both as log10. Words are told
    apart by 64-bit hashes. Null and empty texts are the end alone. Without training documents all bytes are equally
    likely. Repeated rows count each.
    """
    if not 1 <= order <= 7:
        raise ValueError("order must be from 1 to 7")
    blocks, depth = bl.pack_blocks(docs, doc_id, text, block_bytes), order

    def train(ids):
        return ~held_out(ids)

    def low_orders(block, texts):
        b = _Block(texts, train)
        own = b.texts.filter(pa.array(b.train))
        n = np.bincount(grams(own, 1)[0].astype(np.int64), minlength=1)
        keys = np.flatnonzero(n)
        # Beside the pairs: training words at -1, training documents at -2.
        extra = [len(words(own).start), len(own)]
        yield pa.RecordBatch.from_arrays([pa.array([*keys.tolist(), -1, -2], pa.int32()),
                                          pa.array([*n[keys].tolist(), *extra], pa.int64())], ["pair", "n"])

    # At most 65,536 pairs and two totals.
    low = {r["pair"]: r["n"] for r in bl.each_block(blocks, low_orders, "pair int, n long")
           .groupBy("pair").agg(F.sum("n").alias("n")).collect()}
    train_words, train_docs = low.pop(-1, 0), low.pop(-2, 0)
    pairs, pair_counts = np.array(sorted(low), np.uint64), np.array([low[p] for p in sorted(low)], np.float64)
    n_words, n_grams = bl.bucket_count(blocks, _WORD_RATE), bl.bucket_count(blocks, _GRAM_RATE)

    def ask(block, texts):
        b = _Block(texts, train)
        keys, counts = b.words()[:2]
        yield from bl.questions(block, _WORDS, keys, _bucket(keys, n_words), n_words, counts)
        keys, counts = b.grams(order)
        yield from bl.questions(block, _GRAMS, keys, _bucket(keys, n_grams), n_grams, counts, pack=bl.steps,
                                pack_extra=bl.planes)

    def unpack_grams(table):
        keys = [bl.from_steps(k.as_py(), np.uint64) for k in table["keys"]]
        return (np.concatenate(keys), np.concatenate([bl.from_planes(e.as_py(), np.uint32) for e in table["extra"]]),
                np.cumsum([len(k) for k in keys])[:-1])

    def count(bucket, kind, table):
        """Training counts of words; of grams the place among the bucket's distinct ones, and these with their counts."""
        if kind == _GRAMS:
            keys, counts, ends = unpack_grams(table)
            found, inverse = np.unique(keys, return_inverse=True)
            counts = np.bincount(inverse, counts, len(found)).astype(np.uint64)
            return [bl.steps(part.astype(np.uint32)) for part in np.split(inverse, ends)], bl.steps(found) + bl.planes(counts)
        keys = [np.frombuffer(k.as_py(), np.uint64) for k in table["keys"]]
        found, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.concatenate([np.frombuffer(e.as_py(), np.uint32) for e in table["extra"]])
        counts = np.bincount(inverse, counts, len(found)).astype(np.int64)
        ends = np.cumsum([len(k) for k in keys])[:-1]
        return [p.tobytes() for p in np.split(counts[inverse], ends)], int(np.count_nonzero(counts)).to_bytes(8, "big")

    def own_grams(raw):
        half = len(raw) // 2
        return bl.from_steps(raw[:half], np.uint64), bl.from_planes(raw[half:], np.uint64)

    def to_trie(batches):
        for batch in batches:
            for bucket, raw in zip(batch["bucket"].to_pylist(), batch["answer"]):
                found, counts = own_grams(raw.as_py())
                yield from bl.questions(str(bucket), _GRAMS, found, _suffix_bucket(found, n_grams), n_grams, counts,
                                        pack=bl.steps, pack_extra=bl.planes)

    def price(bucket, kind, table):
        """Every gram is asked once."""
        keys = [bl.from_steps(k.as_py(), np.uint64) for k in table["keys"]]
        counts = np.concatenate([bl.from_planes(e.as_py(), np.uint64) for e in table["extra"]])
        ends, keys = np.cumsum([len(k) for k in keys])[:-1], np.concatenate(keys)
        order = np.argsort(keys)
        asked, counts = keys[order], counts[order]
        seen = counts > 0
        out = np.empty(len(keys), np.float32)
        out[order] = code_lengths(asked, asked[seen], counts[seen], pairs, pair_counts, depth)
        return [p.tobytes() for p in np.split(out, ends)], None

    def price_places(table):
        """Prices of a bucket's grams, handed to the blocks that hold them."""
        prices, holders, found = [], [], np.zeros(0, np.uint64)
        for bucket, block, part, raw in zip(*(table[c].to_pylist() for c in ("bucket", "block", "part", "answer"))):
            if part >= 0:
                prices.append((part, raw))
            elif block == "":
                found = own_grams(raw)[0]
            else:
                holders.append((block, raw))
        each = bl.answers_in_order(prices, _suffix_bucket(found, n_grams), np.float32)
        n = len(holders)
        return pa.table({"block": pa.array([b for b, _ in holders], pa.string()), "kind": pa.array([_GRAMS] * n, pa.int32()),
                         "bucket": pa.array([table["bucket"][0].as_py()] * n, pa.int32()),
                         "answer": pa.array([each[bl.from_steps(raw, np.uint32)].tobytes() for _, raw in holders], pa.binary())})

    answers = bl.answer(bl.each_block(blocks, ask, bl.QUESTIONS), count, "lm-counts")
    of_words, of_grams = answers.where(F.col("kind") == _WORDS), answers.where(F.col("kind") == _GRAMS)
    prices = bl.answer(of_grams.where("block = ''").select("bucket", "answer").mapInArrow(to_trie, bl.QUESTIONS), price, "lm-prices")
    priced = (of_grams.select("bucket", "block", F.lit(-1).alias("part"), "answer")
              .unionByName(prices.select(F.col("block").cast("int").alias("bucket"), F.lit("").alias("block"),
                                         F.col("bucket").alias("part"), "answer"))
              .groupBy("bucket").applyInArrow(price_places, bl.ANSWERS))
    distinct = of_words.where("block = ''").agg(
        F.coalesce(F.sum(F.conv(F.hex("answer"), 16, 10).cast("long")), F.lit(0)).alias("n")).first()["n"]
    n_train = train_words + train_docs
    size = n_train + distinct + (train_docs > 0) + 1

    def finish(block, texts, got):
        b = _Block(texts, train)
        keys, _, inverse, doc, n_words_of = b.words()
        n = len(n_words_of)
        count = bl.answers_in_order(got.pop(_WORDS, []), _bucket(keys, n_words), np.int64)[inverse]
        tokens = n_words_of + 1
        base = np.bincount(doc, np.log10(count + 1.0), n) + np.log10(train_docs + 1.0) - tokens * np.log10(float(size))
        n_known = np.bincount(doc[count > 0], minlength=n) + (train_docs > 0)
        # Words and grams do not lie in memory together.
        del keys, inverse, doc, count
        every, sizes = grams(b.texts, order)
        keys = np.unique(every)
        price = bl.answers_in_order(got.pop(_GRAMS, []), _bucket(keys, n_grams), np.float32)
        at = places(keys, every)
        del every, keys
        score = np.bincount(np.repeat(np.arange(n, dtype=np.int32), sizes), price[at], n)
        del at, price
        yield pa.RecordBatch.from_arrays([
            one_array(b.ids), pa.array(~b.train), pa.array(tokens, pa.int64()),
            pa.array(n_known, pa.int64()),
            pa.array(np.full(n, n_train), pa.int64()), pa.array(base), pa.array(score), pa.array(sizes)],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes"])

    return bl.with_answers(blocks, of_words.where("block <> ''").unionByName(priced), finish,
                           "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                           "base_score double, score double, n_bytes long")
