"""Packing of token sequences into windows by multiway differencing (Karmarkar and Karp).

Documents become token ids with an end id after each. A document is cut into pieces of a whole window, which are sequences
as they are, and a rest. The rests of all documents are dealt by a hash into groups of bounded size. In a group every
piece starts as a partition of the group into windows of which only one is filled; the two partitions with the largest imbalance
merge, the fullest window of one with the emptiest of the other, until one partition is left. If its fullest window
exceeds the capacity, the window count rises and the group is partitioned again. If that takes over one percent more
windows than the tokens need, pieces are cut to half the length and the group starts anew.

A null text is an empty one; it has its end id. Repeated rows are packed one by one, also those with a null id. An empty
table gives no pieces. A text of any length is tokenised in parts of bounded size, cut at white space.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from placefolio.llm.common import grouped, text_of
from placefolio.llm.words import one_array, slices
from placefolio.session import staged

WINDOW = 2048
END_ID = 1
# Tokens of the rests that are packed together: the unit of memory and of the window count's rounding.
GROUP_TOKENS = 1 << 19
# The same for pieces, where they are short.
GROUP_PIECES = 4096
# Windows that a group may have beyond those its tokens need, before pieces are cut shorter.
SLACK = 0.01
# Windows of this number or more are not tried with fewer pieces than so many for each.
MANY_WINDOWS, FEW_PIECES = 32, 4
# Text that is tokenised at once; the larger, the fewer words are met again.
_SLICE_BYTES = 16 << 20
# Words that go to the tokenizer in one call.
_JOINED_WORDS = 5000
_FIRST_GROUP = 1 << 58
_NAMES = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]


@functools.lru_cache(maxsize=2)
def _tokenizer(definition: str):
    """The tokenizer, and by id whether a token is the last one of a run of letters (null if it does not mark them)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_str(definition)
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
    ends = None
    if suffix:
        ends = np.zeros(tokenizer.get_vocab_size(), bool)
        ends[[i for token, i in tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
    return tokenizer, ends


# Blanks between Latin letters and ASCII marks change no ids: the tokenizer parts them anyway. An apostrophe stays with
# what follows, and the one letter (0130) whose lower case has a mark of its own stays with its neighbours.
_LATIN = r"A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}"
_BREAKS = ((rf"([{_LATIN}])([!-/:-@\[-`{{-~])", r"\1 \2"), (rf"([!-&(-/:-@\[-`{{-~])([{_LATIN}])", r"\1 \2"))


def _ids_of(words: pa.Array, definition: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct words, one after the other, and how many each word has."""
    apart = words
    if _tokenizer(definition)[1] is not None:
        for pattern, with_blank in _BREAKS:
            apart = pc.replace_substring_regex(apart, pattern, with_blank)
        # What may be a special token stays as it is.
        apart = pc.if_else(pc.match_substring(words, "<|"), words, apart)
    split = pc.ascii_split_whitespace(apart)
    parts = split.flatten().dictionary_encode()
    flat, size = _ids_of_parts(parts.dictionary, definition)
    codes = parts.indices.to_numpy(zero_copy_only=False)
    took = size[codes]
    done = np.concatenate([[0], np.cumsum(took)])
    offsets = np.asarray(split.offsets.to_numpy(), np.int64)
    return flat[_runs((np.cumsum(size) - size)[codes], took)], np.diff(done[offsets - offsets[0]])


def _ids_of_parts(words: pa.Array, definition: str) -> tuple[np.ndarray, np.ndarray]:
    """The same for parts of words.

    Those of letters go to the tokenizer many at a time, with blanks between: each of them ends in one token that says so.
    Where the count of such tokens tells otherwise, and for all others, each part is a call of its own.
    """
    tokenizer, ends = _tokenizer(definition)
    size, parts = np.zeros(len(words), np.int64), []
    order, alone = [], np.arange(len(words))
    if ends is not None:
        letters = pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False)
        together, alone = np.flatnonzero(letters), np.flatnonzero(~letters)
        for at in range(0, len(together), _JOINED_WORDS):
            some = together[at:at + _JOINED_WORDS]
            joined = " ".join(words.take(pa.array(some)).to_pylist())
            ids = np.array(tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
            last = np.flatnonzero(ends[ids])
            if len(last) == len(some) and last[-1] == len(ids) - 1:
                size[some] = np.diff(last, prepend=-1)
                order.append(some)
                parts.append(ids)
            else:
                alone = np.concatenate([alone, some])
    for at in range(0, len(alone), _JOINED_WORDS):
        some = alone[at:at + _JOINED_WORDS]
        found = [e.ids for e in tokenizer.encode_batch_fast(words.take(pa.array(some)).to_pylist(), add_special_tokens=False)]
        size[some] = np.fromiter(map(len, found), np.int64, len(found))
        order.append(some)
        parts.append(np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(size[some].sum())))
    if not order:
        return np.zeros(0, np.uint32), size
    order, flat = np.concatenate(order), np.concatenate(parts)
    starts = np.zeros(len(words), np.int64)
    starts[order] = np.cumsum(size[order]) - size[order]
    return flat[_runs(starts, size)], size


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places from each start on, as many as its size says."""
    done = np.cumsum(sizes)
    return np.repeat(starts - (done - sizes), sizes) + np.arange(done[-1] if len(done) else 0)


def encode(texts: pa.Array, definition: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each closed by ``end_id``, and where each text begins (one more than there are texts).

    The tokenizer never joins characters across white space, so each distinct word is tokenised once.
    """
    split = pc.ascii_split_whitespace(texts)
    words = split.flatten().dictionary_encode()
    flat, size = _ids_of(words.dictionary, definition)
    codes = words.indices.to_numpy(zero_copy_only=False)
    took = size[codes]
    done = np.concatenate([[0], np.cumsum(took)])
    ids = flat[_runs((np.cumsum(size) - size)[codes], took)]
    # The end ids go in between.
    offsets = np.asarray(split.offsets.to_numpy(), np.int64)
    ends = done[offsets - offsets[0]] + np.arange(len(texts) + 1)
    out = np.empty(len(ids) + len(texts), np.uint32)
    closing = np.zeros(len(out), bool)
    closing[ends[1:] - 1] = True
    out[closing], out[~closing] = end_id, ids
    return out, ends


def _parts(text: bytes, most: int) -> Iterator[bytes]:
    """The text in parts of about ``most`` bytes, cut at a blank, so that words stay whole."""
    at = 0
    while at < len(text):
        end = text.find(b" ", at + most)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


def _long(text: pa.Scalar, definition: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    parts = [encode(pa.array([p], pa.binary()).cast(pa.string()), definition, end_id)[0][:-1]
             for p in _parts(text.as_buffer().to_pybytes(), _SLICE_BYTES)]
    ids = np.concatenate([*parts, np.array([end_id], np.uint32)])
    return ids, np.array([0, len(ids)])


def token_pieces(docs: DataFrame, definition: str, doc_id: str, text: str, window: int, end_id: int) -> DataFrame:
    """Stage ``piece, doc_id, start, doc_tokens, ids``: every document cut into windows, the last piece is its rest.

    ``ids`` are packed in as many bytes as the largest id needs.
    """
    kind = docs.schema[doc_id].dataType
    schema = StructType([StructField("piece", LongType()), StructField("doc_id", kind), StructField("start", LongType()),
                         StructField("doc_tokens", LongType()), StructField("ids", BinaryType())])
    definition = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 36
        store = np.uint16 if _tokenizer(definition.value)[0].get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else np.uint32
        for batch in batches:
            for rows in slices(batch, "text", _SLICE_BYTES):
                texts = one_array(rows["text"])
                if rows.num_rows == 1 and texts.nbytes > 2 * _SLICE_BYTES:
                    ids, ends = _long(texts[0], definition.value, end_id)
                else:
                    ids, ends = encode(texts, definition.value, end_id)
                ids = ids.astype(store)
                tokens = np.diff(ends)
                n_pieces = -(-tokens // window)
                doc = np.repeat(np.arange(len(tokens)), n_pieces)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)) * window
                low = ends[doc] + start
                cuts = np.concatenate([low, ends[-1:]]) * ids.itemsize
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(doc)) + number), one_array(rows["doc_id"]).take(pa.array(doc)), pa.array(start),
                     pa.array(tokens[doc]), _binaries(ids, cuts)], schema=pa.schema(
                        [("piece", pa.int64()), rows.schema.field("doc_id"), ("start", pa.int64()), ("doc_tokens", pa.int64()),
                         ("ids", pa.binary())]))
                number += len(doc)

    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    return staged(rows.mapInArrow(run, schema), "tokens")


def _binaries(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Binary array over the bytes of ``values`` between the cuts."""
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int32)),
                                                              pa.py_buffer(np.ascontiguousarray(values))])


def difference(sizes: np.ndarray, windows: int) -> np.ndarray:
    """Window of each piece, by largest differencing: sums of the windows come out nearly equal."""
    # A partition is its sums from the fullest window down, less the emptiest, which differences do not depend on.
    sums: list[np.ndarray | int | None] = sizes.tolist()
    blank = np.zeros(windows, np.int64)
    merged: list[tuple[int, int, np.ndarray] | None] = [None] * len(sizes)
    heap = [(-size if windows > 1 else 0, i) for i, size in enumerate(sums)]
    heapq.heapify(heap)

    def of(k: int) -> np.ndarray:
        if not isinstance(sums[k], int):
            return sums[k]
        one = blank.copy()
        one[0] = sums[k]
        return one

    while len(heap) > 1:
        (_, i), (_, j) = heapq.heappop(heap), heapq.heappop(heap)
        total = of(i) + of(j)[::-1]
        order = (-total).argsort(kind="stable")
        total = total[order]
        total -= total[-1]
        sums[i] = sums[j] = None
        sums.append(total)
        merged.append((i, j, order.astype(np.int32)))
        heapq.heappush(heap, (-int(total[0]), len(sums) - 1))
    out = np.zeros(len(sizes), np.int64)
    # Back from the last partition: which final window each window of the merged ones has become.
    todo = [(len(sums) - 1, np.arange(windows))]
    while todo:
        k, final = todo.pop()
        if merged[k] is None:
            out[k] = final[0]
            continue
        i, j, order = merged[k]
        became = np.empty(windows, np.int64)
        became[order] = final
        todo += [(i, became), (j, became[::-1])]
    return out


def windows_for(sizes: np.ndarray, capacity: int, most: int) -> np.ndarray | None:
    """Window of each piece; the count of windows rises until none exceeds the capacity. None if ``most`` do not do."""
    def fitting(count: int) -> np.ndarray | None:
        found = difference(sizes, count)
        return found if np.bincount(found, sizes, count).max() <= capacity else None

    least = max(1, -(-int(sizes.sum()) // capacity))
    # The largest count goes first: where it fails, none of the smaller ones is tried.
    last = fitting(most) if most >= least else None
    if last is None:
        return None
    return next((found for count in range(least, most) if (found := fitting(count)) is not None), last)


def pack_group(sizes: np.ndarray, capacity: int) -> list[tuple[int, int, int, int, int]]:
    """``(piece, from, length, window, offset)`` for one group of pieces of at most ``capacity`` tokens."""
    least = -(-int(sizes.sum()) // capacity)
    most = int(least * (1 + SLACK)) + 1
    limit = capacity
    # So few pieces for each of many windows hardly ever come out even.
    while limit > 1 and least >= MANY_WINDOWS and (-(-sizes // limit)).sum() < FEW_PIECES * least:
        limit = -(-limit // 2)
    while True:
        n = -(-sizes // limit)
        owner = np.repeat(np.arange(len(sizes)), n)
        part = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        # The last parts are of all lengths, which lets differences even out; equal parts would not.
        low, high = part * limit, np.minimum((part + 1) * limit, sizes[owner])
        found = windows_for(high - low, capacity, most)
        if found is not None:
            break
        limit = -(-limit // 2)
    out, last = [], None
    for k in np.lexsort((low, owner, found)).tolist():
        window, size = int(found[k]), int(high[k] - low[k])
        offset = last[4] + last[2] if last and last[3] == window else 0
        if last and last[3] == window and last[0] == owner[k] and last[1] + last[2] == low[k]:
            # Two neighbours that came to lie in one window are one piece again.
            last = out[-1] = (last[0], last[1], last[2] + size, window, last[4])
            continue
        last = (int(owner[k]), int(low[k]), size, window, offset)
        out.append(last)
    return out


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
         end_id: int = END_ID, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """``doc_id, start, length, doc_tokens, sequence_id, offset, ids``: one row per piece.

    ``tokenizer`` is the path of a tokenizer definition, read on the driver. ``start`` counts the ids of the document before the
    piece, ``offset`` those of its sequence; ``ids`` holds unsigned 32-bit numbers, little end first. Every id of
    every document lies in exactly one piece; no sequence is longer than ``window``.
    """
    definition = Path(tokenizer).read_text(encoding="utf-8")
    pieces = token_pieces(docs, definition, doc_id, text, window, end_id)
    id_type = pieces.schema["doc_id"].dataType.simpleString()
    rest = F.col("doc_tokens") - F.col("start") < window
    size = pieces.where(rest).agg(F.coalesce(F.sum(F.col("doc_tokens") - F.col("start")), F.lit(0)).alias("tokens"),
                                  F.count("*").alias("pieces")).first()
    groups = max(1, -(-size["tokens"] // group_tokens), -(-size["pieces"] // GROUP_PIECES))

    def pack_rows(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        number = rows["bucket"].to_numpy()
        for some in np.split(np.arange(len(number)), np.flatnonzero(np.diff(number)) + 1):
            mine = rows.slice(int(some[0]), len(some))
            tokens, start = mine["doc_tokens"].to_numpy(), mine["start"].to_numpy()
            ids = [_wide(v, n) for v, n in zip(one_array(mine["ids"]), (tokens - start).tolist())]
            packed = pack_group(tokens - start, window)
            base = _FIRST_GROUP + (int(number[some[0]]) << 28)
            at = np.array([p[0] for p in packed])
            taken = mine.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([
                one_array(taken["doc_id"]), pa.array([int(start[p]) + low for p, low, *_ in packed], pa.int64()),
                pa.array([p[2] for p in packed], pa.int64()), one_array(taken["doc_tokens"]),
                pa.array([base + p[3] for p in packed], pa.int64()), pa.array([p[4] for p in packed], pa.int64()),
                pa.array([ids[p][low:low + n].tobytes() for p, low, n, *_ in packed], pa.binary())], _NAMES)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"], batch["start"], pa.array([window] * n, pa.int64()), batch["doc_tokens"], batch["piece"],
                pa.array([0] * n, pa.int64()), pa.array([_wide(v, window).tobytes() for v in batch["ids"]], pa.binary())], _NAMES)

    schema = f"doc_id {id_type}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    dealt = pieces.where(rest).withColumn("bucket", F.pmod(F.xxhash64("piece"), F.lit(groups)))
    packed = grouped(dealt, ["bucket"], ["piece"], pack_rows, schema)
    return pieces.where(~rest).mapInArrow(whole, schema).unionByName(packed)


def _wide(value: pa.Scalar, n: int) -> np.ndarray:
    """``n`` packed ids as unsigned 32-bit numbers, little end first."""
    raw = value.as_buffer()
    return np.frombuffer(raw, "<u2" if raw.size == 2 * n else "<u4").astype("<u4")
