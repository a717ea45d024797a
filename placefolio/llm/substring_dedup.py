"""Substring de-duplication by level-wise doubling.

Windows of a few words are counted first. Only where such a window is repeated in another document can a window of
twice the length be repeated, so only those are extended, hashed anew and counted again, until the wanted length is reached
or a level finds no repeated window, which ends the search. At a level before the last it is enough to count, of each
window of the next length, its smallest window of this length (equal windows have the same one), which is a fraction
of all positions. The last level compares 96-bit hashes and asks in how small a document each window starts.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from placefolio.llm import blocks as bl
from placefolio.llm.words import Words, inside_document, one_array, sketch_hash, windows, words

WINDOW = 13
# Bytes asked per byte of text at a level: about one hash in four of 6.5-byte words, and 20 bytes for each candidate.
_FIRST_RATE, _NEXT_RATE = 0.4, 0.8
# Added to the number of a level: rows with the candidates a block has left at that level, for its next pass.
_STATE = 100


def level_lengths(window: int) -> list[int]:
    """Lengths of the levels: doubling from 4 to 6 words up to ``window``, of which each is half the next, rounded up."""
    lengths = [window]
    while lengths[0] > 6:  # 3 words and less are too common to leave few candidates
        lengths.insert(0, (lengths[0] + 1) // 2)
    return lengths


def _bucket(keys: np.ndarray, n: int) -> np.ndarray:
    return ((sketch_hash(keys) >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest of the ``width`` values from each position on (the first of equal ones)."""
    at = np.arange(len(values))
    done = 1
    while done < width:
        step = min(done, width - done)
        other = at[np.minimum(np.arange(len(values)) + step, len(values) - 1)]
        # Positions at the end see themselves; their windows do not lie in a document anyway.
        at = np.where(values[other] < values[at], other, at)
        done += step
    return at


class _Levels:
    """Candidate windows of a block, level by level. Everything follows from the texts and the answers so far."""

    def __init__(self, texts: pa.Table, window: int):
        self.texts = one_array(texts["text"])
        self.ids = bl.ids_of(texts)
        self.w: Words = words(self.texts)
        self.hashes = self.w.hashes()
        self.window = window
        self.lengths = level_lengths(window)
        self.doc_id = self.ids[self.w.document()]
        self.candidate = inside_document(self.w, window)

    def is_last(self, number: int) -> bool:
        return number == len(self.lengths) - 1

    def asked(self, number: int):
        """Positions a level asks about, their hashes, and at the first level the position each window hangs on."""
        hashes = windows(self.hashes, self.lengths[number], number + 1)
        if self.is_last(number):
            at = np.flatnonzero(self.candidate)
            second = windows(self.hashes, self.window, 1001)[at].astype(np.uint32)
            return at, hashes[at], second, None
        # Of each window of the next length the smallest window of this length; equal ones have the same.
        anchor = _smallest(hashes, self.lengths[number + 1] - self.lengths[number] + 1)
        at = np.unique(anchor[self.candidate])
        return at, hashes[at], np.zeros(len(at), np.uint32), anchor

    def take_up(self, state: list[tuple[int, bytes]]) -> None:
        """Go on with the candidates of an earlier pass."""
        (_, bits), = state
        self.candidate = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(self.candidate)).astype(bool)

    def settle(self, at: np.ndarray, repeated: np.ndarray, anchor: np.ndarray) -> None:
        """Keep the candidates whose anchor is repeated."""
        mark = np.zeros(len(self.candidate), bool)
        mark[at] = repeated
        self.candidate &= mark[anchor]


def _distinct(keys: np.ndarray, second: np.ndarray):
    """Distinct pairs of hashes: the sorted first and second hashes, and the number of the pair of each entry."""
    order = np.lexsort((second, keys)) if second.any() else np.argsort(keys, kind="stable")
    k, s = keys[order], second[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (s[1:] != s[:-1])
    inverse = np.empty(len(k), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return k[new], s[new], inverse


def _least(values: np.ndarray, inverse: np.ndarray, n: int) -> np.ndarray:
    out = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(out, inverse, values)
    return out


def _settled(texts: pa.Table, window: int, upto: int, got: dict, counts: list[int]) -> _Levels:
    """The block with the candidates left after the first ``upto`` levels: those left before the last of these, as the block
    has written them down itself, less what the answers to that level exclude."""
    levels = _Levels(texts, window)
    if upto > 1:
        levels.take_up(got[_STATE + upto - 1])
    if upto:
        number = upto - 1
        at, keys, second, anchor = levels.asked(number)
        found, _, inverse = _distinct(keys, second)
        repeated = bl.answers_in_order(got.get(number, []), _bucket(found, counts[number]), np.uint8).astype(bool)
        levels.settle(at, repeated[inverse], anchor)
    return levels


def _state(block: str, levels: _Levels, number: int, n_buckets: int) -> pa.RecordBatch:
    """The candidates of a level as a question that is its own answer."""
    return pa.RecordBatch.from_pydict({
        "bucket": pa.array([zlib.crc32(block.encode()) % n_buckets], pa.int32()), "kind": pa.array([_STATE + number], pa.int32()),
        "block": [block], "keys": pa.array([np.packbits(levels.candidate).tobytes()], pa.binary()),
        "extra": pa.array([b""], pa.binary())})


def _kept_state(fn):
    """``fn`` for questions, and candidates as they came."""
    return lambda bucket, kind, table: (table["keys"].to_pylist(), None) if kind >= _STATE else fn(bucket, kind, table)


def _questions(block: str, levels: _Levels, number: int, n_buckets: int):
    at, keys, second, _ = levels.asked(number)
    found, found2, inverse = _distinct(keys, second)
    low = _least(levels.doc_id[at], inverse, len(found))
    bucket = _bucket(found, n_buckets)
    if levels.is_last(number):
        return bl.questions(block, number, found, bucket, n_buckets, found2, low)
    high = -_least(-levels.doc_id[at], inverse, len(found))
    return bl.questions(block, number, found, bucket, n_buckets, (low != high).astype(np.uint8))


def _repeated(bucket: int, kind: int, table: pa.Table):
    """Which windows of a bucket occur in more than one document."""
    keys = [np.frombuffer(k.as_py(), np.uint64) for k in table["keys"]]
    many = np.concatenate([np.frombuffer(e.as_py(), np.uint8) for e in table["extra"]])
    found, inverse, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    more = count > 1
    more[inverse[many > 0]] = True
    ends = np.cumsum([len(k) for k in keys])[:-1]
    return [part.astype(np.uint8).tobytes() for part in np.split(more[inverse], ends)], None


def _earlier(bucket: int, kind: int, table: pa.Table):
    """Which windows of a bucket start in a document with a smaller id than any of the asking block."""
    keys = [np.frombuffer(k.as_py(), np.uint64) for k in table["keys"]]
    extra = [e.as_py() for e in table["extra"]]
    second = np.concatenate([np.frombuffer(e, np.uint32, len(k)) for k, e in zip(keys, extra)])
    low = np.concatenate([np.frombuffer(e, np.int64, len(k), 4 * len(k)) for k, e in zip(keys, extra)])
    found, _, inverse = _distinct(np.concatenate(keys), second)
    ends = np.cumsum([len(k) for k in keys])[:-1]
    earlier = _least(low, inverse, len(found))[inverse] < low
    return [part.astype(np.uint8).tobytes() for part in np.split(earlier, ends)], None


def _kept_words(levels: _Levels, got: dict, counts: list[int]) -> np.ndarray:
    """Which words of the block stay."""
    number = len(levels.lengths) - 1
    at, keys, second, _ = levels.asked(number)
    found, _, inverse = _distinct(keys, second)
    low = _least(levels.doc_id[at], inverse, len(found))
    elsewhere = bl.answers_in_order(got.get(number, []), _bucket(found, counts[number]), np.uint8).astype(bool)
    gone = at[elsewhere[inverse] | (low[inverse] < levels.doc_id[at])]
    change = np.zeros(len(levels.candidate) + 1, np.int64)
    np.add.at(change, gone, 1)
    np.add.at(change, gone + levels.window, -1)
    return np.cumsum(change[:-1]) == 0


def remove_repeats(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
                   block_bytes: int = bl.BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_removed, kept_text``.

    A word goes if it lies in a window of ``window`` words that also starts in a document with a smaller id; the first
    document keeps it. All windows are judged on the input. Ids are whole numbers. A null id is larger than all others; rows with the same id
    never take words from each other. Null and empty texts have no words, texts shorter than the window lose none.
    """
    if window < 1:
        raise ValueError("window must be at least 1")
    blocks = bl.pack_blocks(docs, doc_id, text, block_bytes)
    lengths, answers, counts, ended = level_lengths(window), None, [], False
    for number in range(len(lengths)):
        last = number == len(lengths) - 1
        counts.append(bl.bucket_count(blocks, _NEXT_RATE if last else _FIRST_RATE))

        def ask(block, texts, got, number=number, counts=tuple(counts)):
            levels = _settled(texts, window, number, got, list(counts))
            if number:
                yield _state(block, levels, number, counts[number])
            yield from _questions(block, levels, number, counts[number])

        asked = (bl.each_block(blocks, lambda block, texts, f=ask: f(block, texts, {}), bl.QUESTIONS) if answers is None
                 else bl.with_answers(blocks, answers, ask, bl.QUESTIONS))
        answers = bl.answer(asked, _kept_state(_earlier if last else _repeated), f"level-{lengths[number]}")
        # Answers are zeros and ones; without a one no longer window can be repeated either.
        if not last and answers.where((F.col("kind") == number) & (F.instr(F.hex("answer"), "01") > 0)).isEmpty():
            ended = True
            break

    def finish(block, texts, got, counts=tuple(counts)):
        levels = _Levels(texts, window)
        if not ended and len(lengths) > 1:
            levels.take_up(got[_STATE + len(lengths) - 1])
        kept = np.ones(len(levels.candidate), bool) if ended else _kept_words(levels, got, list(counts))
        rows = []
        for i, content in enumerate(levels.texts):
            mine = kept[levels.w.first[i]:levels.w.first[i + 1]]
            found = (content.as_py() or "").encode().split()
            rows.append(b" ".join(found if mine.all() else [x for x, keep in zip(found, mine.tolist()) if keep]))
        total = levels.w.counts
        removed = np.array([np.count_nonzero(~kept[a:b]) for a, b in zip(levels.w.first, levels.w.first[1:])], np.int64)
        yield pa.RecordBatch.from_arrays(
            [one_array(texts["doc_id"]), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(rows, pa.binary()).view(pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])

    schema = "doc_id long, n_words long, n_removed long, kept_text string"
    return (bl.each_block(blocks, lambda block, texts: finish(block, texts, {}), schema) if ended
            else bl.with_answers(blocks, answers, finish, schema))
