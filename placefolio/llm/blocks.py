"""Documents in compressed blocks, and questions from blocks to key-partitioned tasks.

Ids are whole numbers here; other ids raise an error when they are read.

Some operators look up millions of hashes per task and need one small answer for each. Sent as rows, each hash would carry
a row's overhead several times. Here documents are packed once into blocks of a few megabytes. A block sends the distinct
hashes it asks about, sorted into buckets, as packed arrays; the task of a bucket answers with an array in the same order;
the answers meet the block again by its name. A hash that is frequent everywhere is sent once per block, whatever its count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from placefolio.llm.words import slices
from placefolio.session import staged

# Text of a block. A block with its arrays is the unit of memory: some 40 bytes per word while it is worked on.
BLOCK_BYTES = 8 << 20
# Bytes of packed questions that one bucket gets from all blocks together, at first and at most. A bucket is worked on as
# a whole, so the larger number is what a task must hold.
BUCKET_BYTES, MOST_BUCKET_BYTES = 8 << 20, 256 << 20
# Least bytes of a question row on average: with less, the rows' own overhead would outweigh what they carry.
ROW_BYTES = 128
_NULL_ID = np.iinfo(np.int64).max
QUESTIONS = "bucket int, kind int, block string, keys binary, extra binary"
ANSWERS = "block string, kind int, bucket int, answer binary"


def pack_blocks(docs: DataFrame, doc_id: str, text: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Stage ``block, n_docs, n_bytes, content``: ids and whole texts as compressed Arrow data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, n, held, size = TaskContext.get().partitionId(), 0, [], 0

        def block():
            nonlocal n
            whole = pa.concat_tables(held)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, whole.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(whole)
            n += 1
            return pa.RecordBatch.from_pydict({
                "block": [f"{task}-{n}"], "n_docs": pa.array([whole.num_rows], pa.int32()), "n_bytes": pa.array([size], pa.int64()),
                "content": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

        for batch in batches:
            for part in slices(batch, "text", block_bytes):
                more = part["text"].nbytes
                if held and size + more > block_bytes:
                    yield block()
                    held, size = [], 0
                held.append(part)
                size += more
        if held:
            yield block()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return staged(rows.mapInArrow(run, "block string, n_docs int, n_bytes long, content binary"), "blocks")


def unpack(content: bytes) -> pa.Table:
    with pa.ipc.open_stream(content) as stream:
        return stream.read_all()


def ids_of(table: pa.Table) -> np.ndarray:
    """Ids as numbers; a null id is larger than all others."""
    return table["doc_id"].fill_null(_NULL_ID).to_numpy()


def bucket_count(blocks: DataFrame, bytes_per_byte: float) -> int:
    """Buckets for questions that take ``bytes_per_byte`` bytes per byte of text.

    A block asks each bucket in one row, so rows are blocks times buckets. Buckets therefore grow before they become so many
    that a row carries less than ``ROW_BYTES``, up to what a task can hold. Every block asks every bucket once, and a
    hash once whatever its count, so buckets stay alike: a hash that is frequent everywhere adds one entry per block.
    """
    size = blocks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n"), F.count("*").alias("blocks")).first()
    return buckets_for(size["n"] * bytes_per_byte, size["blocks"])


def buckets_for(total: float, n_blocks: int) -> int:
    wanted = total / BUCKET_BYTES
    full_rows = total / max(n_blocks, 1) / ROW_BYTES
    return max(1, int(max(min(wanted, full_rows), total / MOST_BUCKET_BYTES)) + 1)


def questions(block: str, kind: int, keys: np.ndarray, bucket: np.ndarray, n_buckets: int,
              *extras: np.ndarray, pack: Callable = np.ndarray.tobytes,
              pack_extra: Callable = np.ndarray.tobytes) -> Iterator[pa.RecordBatch]:
    """Question rows for ``keys``, in the order of :func:`asked_order`. ``extras`` go along, packed one after the other."""
    order = asked_order(bucket)
    keys, extras, sorted_bucket = keys[order], [e[order] for e in extras], bucket[order]
    ends = np.searchsorted(sorted_bucket, np.arange(n_buckets + 1))
    used = np.flatnonzero(np.diff(ends))
    if not len(used):
        return
    blobs = [pack(keys[ends[b]:ends[b + 1]]) for b in used]
    more = [b"".join(pack_extra(e[ends[b]:ends[b + 1]]) for e in extras) for b in used]
    yield pa.RecordBatch.from_pydict({
        "bucket": pa.array(used, pa.int32()), "kind": pa.array([kind] * len(used), pa.int32()), "block": [block] * len(used),
        "keys": pa.array(blobs, pa.binary()), "extra": pa.array(more, pa.binary())})


def asked_order(bucket: np.ndarray) -> np.ndarray:
    return np.argsort(bucket, kind="stable")


def planes(values: np.ndarray) -> bytes:
    """The numbers byte by byte: all first bytes, all second bytes and so on. Small numbers then compress well."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T.tobytes()


def from_planes(raw: bytes, dtype) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def steps(ascending: np.ndarray) -> bytes:
    """Ascending unsigned numbers as the planes of their differences."""
    return planes(np.diff(ascending, prepend=ascending.dtype.type(0)))


def from_steps(raw: bytes, dtype) -> np.ndarray:
    return np.cumsum(from_planes(raw, dtype), dtype=dtype)


def answers_in_order(rows: list[tuple[int, bytes]], bucket: np.ndarray, dtype) -> np.ndarray:
    """Answers ``(bucket, array)`` put back into the order of the keys that were asked."""
    parts = [np.frombuffer(a, dtype) for _, a in sorted(rows, key=lambda r: r[0])]
    flat = np.concatenate(parts) if parts else np.zeros(0, dtype)
    if len(flat) != len(bucket):
        raise RuntimeError(f"{len(flat)} answers for {len(bucket)} questions")
    out = np.empty(len(bucket), dtype)
    out[asked_order(bucket)] = flat
    return out


def answer(asked: DataFrame, fn: Callable[[int, int, pa.Table], tuple[list[bytes], bytes | None]], name: str) -> DataFrame:
    """Stage the answers. ``fn(bucket, kind, questions)`` gives one array per question row, in their order, and possibly
    something about the whole bucket, which goes into a row without a block."""

    def run(table: pa.Table) -> pa.Table:
        bucket, kind = table["bucket"][0].as_py(), table["kind"][0].as_py()
        found, whole = fn(bucket, kind, table)
        blocks = table["block"].to_pylist()
        if whole is not None:
            blocks, found = [*blocks, ""], [*found, whole]
        n = len(blocks)
        return pa.table({"block": blocks, "kind": pa.array([kind] * n, pa.int32()), "bucket": pa.array([bucket] * n, pa.int32()),
                         "answer": pa.array(found, pa.binary())})

    return staged(asked.groupBy("bucket", "kind").applyInArrow(run, ANSWERS), name)


def with_answers(blocks: DataFrame, answers: DataFrame, fn: Callable[[str, pa.Table, dict], Iterator[pa.RecordBatch]],
                 schema: str) -> DataFrame:
    """``fn(block, documents, answers)`` for every block; ``answers`` maps a kind to its ``(bucket, array)`` rows.

    The answers of a block are at most as long as its questions were, so they are one row per block.
    """
    per_block = (answers.groupBy("block").agg(F.collect_list(F.struct("kind", "bucket", "answer")).alias("answers"))
                 .withColumnRenamed("block", "b2"))
    joined = blocks.join(per_block, F.col("block") == F.col("b2"), "left").select("block", "content", "answers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                got: dict[int, list] = {}
                for a in batch["answers"][i].as_py() or ():
                    got.setdefault(a["kind"], []).append((a["bucket"], a["answer"]))
                yield from fn(batch["block"][i].as_py(), unpack(batch["content"][i].as_py()), got)

    return joined.mapInArrow(run, schema)


def each_block(blocks: DataFrame, fn: Callable[[str, pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from fn(batch["block"][i].as_py(), unpack(batch["content"][i].as_py()))

    return blocks.select("block", "content").mapInArrow(run, schema)
