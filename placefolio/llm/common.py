"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Word separators and words of the contracts: the six ASCII blanks and everything else.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """Whole text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def n_words(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def fold(column: str, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts).cast("int")


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores in front until no column has it."""
    while name.lower() in {t.lower() for t in taken}:
        name = "_" + name
    return name


def in_groups(keys: list[str], fn: Callable[[pa.Table], Iterator[pa.RecordBatch]],
              least_rows: int = 1) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Function for ``mapInArrow`` over rows sorted by ``keys``: ``fn`` gets a run of whole groups as one table.

    Runs have at least ``least_rows`` rows (the last one may have fewer), so small groups cost no call of their own.
    """
    def ends(batch: pa.Table) -> int:
        """Row at which the last group of the table starts."""
        last = batch.num_rows - 1
        low, high, want = 0, last, [batch[k][last].as_py() for k in keys]
        while low < high:
            mid = (low + high) // 2
            if [batch[k][mid].as_py() for k in keys] == want:
                high = mid
            else:
                low = mid + 1
        return low

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows < least_rows:
                continue
            whole = pa.Table.from_batches(held)
            cut = ends(whole)
            if cut:
                yield from fn(whole.slice(0, cut))
                # Copied, so that the part before it can go.
                held = pa.Table.from_batches(whole.slice(cut).to_batches()).combine_chunks().to_batches()
                rows = whole.num_rows - cut
        if held:
            yield from fn(pa.Table.from_batches(held))

    return run


def grouped(df: DataFrame, keys: list[str], order: list[str], fn, schema: str, least_rows: int = 1) -> DataFrame:
    """``fn`` over runs of whole groups of ``keys``, each group in one task, sorted by ``keys`` and ``order``."""
    return (df.repartition(*keys).sortWithinPartitions(*keys, *order)
            .mapInArrow(in_groups(keys, fn, least_rows), schema))
