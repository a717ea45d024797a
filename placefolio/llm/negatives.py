"""Hard negatives by a vertical scan with bounds (BOND).

Rows are kept as blocks of columns, one column of whole numbers per dimension. For an anchor the columns of a block are read in
the descending order of the anchor's own components. After a few columns each row has a partial inner product, and the
smallest and largest number of every unread column bound what can still come. Rows whose bounds miss what is asked
leave the candidate bitmap; what stays to the end has its exact score.

Two scans are needed: the first finds the positives of each anchor, whose scores set the windows that the second one searches
for negatives. Anchors (in groups) and blocks of rows (in shards) meet in cells by a key. A cell holds one group of
anchors and one block at a time, and carries the best rows found so far from block to block, which tightens the bounds.
Every anchor meets every row of every block; nothing is dropped but by a bound.

Rows with a null label, a null vector or null or non-finite components take no part. A null id is never an anchor and
comes after all others in ties. Rows with the anchor's id are not its partners; other repeated rows count each. A vector
shorter than another one counts as going on with zeros. Components are cut to 2^53 in size; a score that exceeds a long is
cut to the largest one in the result, after the choice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from placefolio.llm.common import fresh
from placefolio.llm.vectors import EXACT, as_doubles, matrix, narrow, whole_rows
from placefolio.session import staged

POSITIVES = 5
NEGATIVES = 3
# Percent of the positive's score that a negative's must reach and must not exceed.
LEAST, MOST = 50, 95
# Anchors that share one pass over a shard, and rows that are scanned as one block.
GROUP_ANCHORS = 2048
BLOCK_ROWS = 4096
# Least rows of a shard, and cells that the work is split into before shards grow.
SHARD_ROWS = 2048
CELLS = 4096
# Columns read between two looks at the bounds.
STEP = 8
_NO_ID = np.iinfo(np.int64).max
_LONG = 2 ** 63 - 1
_MOST = 2 ** 53
_BLOCKS = "seq long, n int, dims int, ids binary, names array<string>, codes binary, width int, data binary"
_FOUND = "anchor long, slot int, id long, score long, exact string"


def _records(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list, np.ndarray] | None:
    """Ids, labels as numbers with their names, and the matrix of the rows that take part."""
    rows, offsets, flat = whole_rows(batch["v"])
    if not len(rows):
        return None
    x = np.clip(matrix(offsets, flat, int(np.diff(offsets).max())), -_MOST, _MOST)
    labels = batch["label"].take(pa.array(rows)).dictionary_encode()
    ids = batch["id"].take(pa.array(rows)).fill_null(_NO_ID).to_numpy()
    return ids, labels.indices.to_numpy().astype(np.int32), labels.dictionary.to_pylist(), x


def _columns(rows: DataFrame) -> DataFrame:
    """Stage the rows as blocks of columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        seq = TaskContext.get().partitionId() << 36
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                found = _records(batch.slice(at, BLOCK_ROWS))
                if not found:
                    continue
                ids, codes, names, x = found
                columns = narrow(np.ascontiguousarray(x.T))
                yield pa.RecordBatch.from_pydict({
                    "seq": pa.array([seq], pa.int64()), "n": pa.array([len(ids)], pa.int32()), "dims": pa.array([len(columns)], pa.int32()),
                    "ids": [ids.tobytes()], "names": [names], "codes": [codes.tobytes()],
                    "width": pa.array([columns.itemsize], pa.int32()), "data": [columns.tobytes()]})
                seq += 1

    return staged(rows.mapInArrow(run, _BLOCKS), "columns")


def _anchors(rows: DataFrame) -> DataFrame:
    """Stage the anchors, a row each, numbered by ``seq``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        seq = TaskContext.get().partitionId() << 36
        for batch in batches:
            found = _records(batch) if batch.num_rows else None
            if not found:
                continue
            ids, codes, names, x = found
            n = len(ids)
            kinds = [narrow(v) for v in x]
            yield pa.RecordBatch.from_pydict({
                "seq": pa.array(np.arange(n) + seq), "n": pa.array([1] * n, pa.int32()), "dims": pa.array([x.shape[1]] * n, pa.int32()),
                "ids": [i.tobytes() for i in ids], "names": [[names[c]] for c in codes], "codes": [bytes(4)] * n,
                "width": pa.array([k.itemsize for k in kinds], pa.int32()), "data": [k.tobytes() for k in kinds]})
            seq += n

    return staged(rows.mapInArrow(run, _BLOCKS), "anchors")


@dataclass
class Block:
    """Rows as columns, with the least and largest number of each."""

    ids: np.ndarray
    codes: np.ndarray
    names: dict[str, int]
    columns: np.ndarray
    bitmaps: dict = field(default_factory=dict)

    def __post_init__(self):
        self.low, self.high = self.columns.min(axis=1).astype(np.int64), self.columns.max(axis=1).astype(np.int64)
        self.most = max(1, -int(self.low.min(initial=0)), int(self.high.max(initial=0)))
        self.columns = self.columns.astype(np.float64)

    def bitmap(self, label: str, same: bool) -> np.ndarray:
        """Rows with the label, or those without."""
        if (label, same) not in self.bitmaps:
            self.bitmaps[label, same] = (self.codes == self.names.get(label, -1)) == same
        return self.bitmaps[label, same]


def joined(parts: list[tuple]) -> Block:
    """One block of several records ``(ids, names, codes, columns)``."""
    names: dict[str, int] = {}
    codes = [np.array([names.setdefault(x, len(names)) for x in ns], np.int32)[c] for _, ns, c, _ in parts]
    dims = max(len(c) for *_, c in parts)
    columns = np.concatenate([np.pad(c, ((0, dims - len(c)), (0, 0))) for *_, c in parts], axis=1)
    return Block(np.concatenate([p[0] for p in parts]), np.concatenate(codes), names, columns)


@dataclass
class Slot:
    """The first ``keep`` rows with a score from ``low`` to ``high``, as far as they are known."""

    keep: int
    low: float | int = -np.inf
    high: float | int = np.inf
    scores: list = field(default_factory=list)
    ids: list = field(default_factory=list)

    @property
    def need(self):
        """Scores below this cannot come in."""
        return max(self.low, self.scores[-1]) if len(self.scores) == self.keep else self.low

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        inside = np.flatnonzero((scores >= self.need) & (scores <= self.high))
        if not len(inside):
            return
        if len(inside) > self.keep:
            # All that tie with the last one stay until ids decide.
            edge = np.sort(scores[inside])[-self.keep]
            inside = inside[scores[inside] >= edge]
            inside = inside[np.lexsort((ids[inside], -scores[inside]))[:self.keep]]
        both = sorted([*zip(self.scores, self.ids), *((int(s), int(i)) for s, i in zip(scores[inside], ids[inside]))],
                      key=lambda p: (-p[0], p[1]))[:self.keep]
        self.scores, self.ids = [s for s, _ in both], [i for _, i in both]


class Anchor:
    def __init__(self, seq: int, anchor_id: int, label: str, x: np.ndarray, slots: list[Slot]):
        self.seq, self.id, self.label, self.slots = seq, anchor_id, label, slots
        order = np.argsort(-np.abs(x.astype(np.float64)), kind="stable")
        # Components of zero add nothing.
        self.order = order[x[order] != 0]
        self.x = x
        self.size = sum(abs(int(v)) for v in x)

    def scan(self, block: Block, same: bool) -> None:
        """Look for rows of the block that belong into a slot."""
        alive = block.bitmap(self.label, same)
        order = self.order[self.order < len(block.columns)] if len(self.x) > len(block.columns) else self.order
        columns, x = block.columns, self.x[order].astype(np.float64)
        low, high = block.low[order], block.high[order]
        if self.size * block.most >= EXACT:
            # Doubles would round: Python's own whole numbers, slower and exact.
            columns, x = columns.astype(object), np.array([int(v) for v in self.x[order]], object)
            low, high = low.astype(object), high.astype(object)
        else:
            low, high = low.astype(np.float64), high.astype(np.float64)
        one, other = x * low, x * high
        # What the columns from a place of the order on can add at least and at most.
        least = np.concatenate([np.cumsum(np.minimum(one, other)[::-1])[::-1], [0]])
        most = np.concatenate([np.cumsum(np.maximum(one, other)[::-1])[::-1], [0]])
        need, cap = min(s.need for s in self.slots), max(s.high for s in self.slots)
        if most[0] < need or least[0] > cap:
            return
        alive = alive & (block.ids != self.id)
        rows, partial = None, np.zeros(len(alive), columns.dtype)
        for at in range(0, len(order), STEP):
            dims = order[at:at + STEP]
            read = columns[dims] if rows is None else columns[dims[:, None], rows[None, :]]
            partial = partial + x[at:at + STEP] @ read
            end = min(at + STEP, len(order))
            keep = (partial >= need - most[end]) & (partial <= cap - least[end])
            if rows is None:
                alive = alive & keep
                count = np.count_nonzero(alive)
                if 2 * count < len(alive):
                    # Few are left: from here on only their numbers are read.
                    rows = np.flatnonzero(alive)
                    partial = partial[rows]
            else:
                rows, partial = rows[keep], partial[keep]
                count = len(rows)
            if not count:
                return
            if len(self.slots) == 1 and count >= self.slots[0].keep:
                # So many rows surely reach the lower bound of the last of them.
                known = partial if rows is not None else partial[alive]
                edge = np.partition(known, count - self.slots[0].keep)[count - self.slots[0].keep] + least[end]
                need = max(need, edge)
        if rows is None:
            rows = np.flatnonzero(alive)
            partial = partial[rows]
        for slot in self.slots:
            slot.add(block.ids[rows], partial)


def _cells(blocks: DataFrame, anchors: DataFrame, same: bool, keep: int, least: int = 0, most: int = 0) -> DataFrame:
    """Staged ``anchor, slot, id, score, exact`` of the best rows of each cell. ``around`` of an anchor has the score, as text,
    that the window of each slot lies below; null stands for one slot without limits."""
    n_rows = blocks.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    groups = max(1, -(-anchors.count() // GROUP_ANCHORS))
    shards = max(1, min(-(-n_rows // SHARD_ROWS), -(-CELLS // groups)))
    cell = F.col("group") * shards + F.col("shard")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    shape = ["cell", "kind", *(c.split()[0] for c in _BLOCKS.split(", ")), "around"]
    left = (anchors.withColumn("group", F.pmod(F.xxhash64("seq"), F.lit(groups))).withColumn("shard", every(shards))
            .select(cell.alias("cell"), F.lit(0).alias("kind"), *shape[2:]))
    right = (blocks.withColumn("shard", F.pmod(F.xxhash64("seq"), F.lit(shards))).withColumn("group", every(groups))
             .select(cell.alias("cell"), F.lit(1).alias("kind"), *shape[2:-1],
                     F.lit(None).cast("array<string>").alias("around")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, here, held, n = None, [], [], 0

        def scan():
            block = joined(held)
            for anchor in here:
                anchor.scan(block, same)

        def results():
            found = [(a.seq, k, i, s) for a in here for k, slot in enumerate(a.slots) for s, i in zip(slot.scores, slot.ids)]
            return pa.RecordBatch.from_pydict({
                "anchor": pa.array([f[0] for f in found], pa.int64()), "slot": pa.array([f[1] for f in found], pa.int32()),
                "id": pa.array([None if f[2] == _NO_ID else f[2] for f in found], pa.int64()),
                "score": pa.array([max(-_LONG - 1, min(_LONG, f[3])) for f in found], pa.int64()),
                "exact": pa.array([str(f[3]) if abs(f[3]) > _LONG else None for f in found], pa.string())})

        for batch in batches:
            for r in batch.to_pylist():
                if r["cell"] != cell:
                    if held:
                        scan()
                    if here:
                        yield results()
                    cell, here, held, n = r["cell"], [], [], 0
                numbers = np.frombuffer(r["data"], f"<i{r['width']}")
                if r["kind"] == 0:
                    slots = ([Slot(keep)] if r["around"] is None else
                             [Slot(keep, -(-least * int(s) // 100), most * int(s) // 100) for s in r["around"]])
                    here.append(Anchor(r["seq"], int(np.frombuffer(r["ids"], np.int64)[0]), r["names"][0],
                                       numbers.astype(np.int64), slots))
                    continue
                if not here:
                    continue
                held.append((np.frombuffer(r["ids"], np.int64), r["names"], np.frombuffer(r["codes"], np.int32),
                             numbers.reshape(r["dims"], r["n"]).astype(np.int64)))
                n += r["n"]
                if n >= BLOCK_ROWS:
                    scan()
                    held, n = [], 0
        if held:
            scan()
        if here:
            yield results()

    # Cells are many times the tasks or each has a task of its own; they take alike long.
    parts = min(4 * groups * shards, CELLS)
    met = left.unionByName(right).repartition(parts, "cell").sortWithinPartitions("cell", "kind", "seq")
    return staged(met.mapInArrow(run, _FOUND), "scanned")


def _score() -> Column:
    """The score as text, also where it exceeds a long."""
    return F.coalesce(F.col("exact"), F.col("score").cast("string"))


def _first(found: DataFrame, keep: int) -> DataFrame:
    """The first ``keep`` rows of each anchor and slot over all cells, with their ``rank``."""
    best = Window.partitionBy("anchor", "slot").orderBy(_score().cast("decimal(38,0)").desc(), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)


def mine(rows: DataFrame, is_anchor: Column, vec_id: str = "vec_id", label: str | Column = "label", vector: str = "embedding",
         positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Rows for which ``is_anchor`` holds are anchors. An anchor's positives are its first ``positives`` other rows of the same
    label by inner product. For each, the first ``negatives`` rows of other labels follow whose score is from
    ``least`` to ``most`` percent of the positive's score; ties go to the smaller id. ``vec_id`` is read as a long.
    """
    tag = F.col(label) if isinstance(label, str) else label
    flag = fresh("is_anchor", rows.columns)
    ready = rows.select(F.col(vec_id).cast("long").alias("id"), tag.cast("string").alias("label"), as_doubles(vector).alias("v"),
                        F.coalesce(is_anchor, F.lit(False)).alias(flag)).where(F.col("label").isNotNull())
    blocks = _columns(ready.drop(flag))
    anchors = _anchors(ready.where(flag).where(F.col("id").isNotNull()).drop(flag))
    alone = anchors.withColumn("around", F.lit(None).cast("array<string>"))
    near = staged(_first(_cells(blocks, alone, True, positives), positives)
                  .select("anchor", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"),
                          F.col("score").alias("positive_score"), _score().alias("whole")), "positives")
    around = (near.groupBy(F.col("anchor").alias("seq")).agg(F.sort_array(F.collect_list(F.struct("slot", "whole"))).alias("near"))
              .select("seq", F.transform("near", lambda p: p["whole"]).alias("around")))
    far = _first(_cells(blocks, anchors.join(around, "seq"), False, negatives, least, most), negatives)
    origin = anchors.select(F.col("seq").alias("anchor"), "ids")
    return (far.join(near, ["anchor", "slot"]).join(_ids(origin), "anchor")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))


def _ids(anchors: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["anchor"], pa.array([
                int(np.frombuffer(v.as_py(), np.int64)[0]) for v in batch["ids"]], pa.int64())], ["anchor", "anchor_id"])

    return anchors.mapInArrow(run, "anchor long, anchor_id long")
