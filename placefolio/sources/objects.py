"""Fetched bytes: the object table and the binary file scan."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from placefolio.functions.text import first_bytes, object_path
from placefolio.operators.fetches import HOMEPAGE_FILE, asked_rows, is_fetched
from placefolio.operators.hot_keys import join_on_unique
from placefolio.params import MAX_BYTES
from placefolio.sources.folders import codec_suffixes

# Files up to this size are one value where only their digests are wanted, larger ones are read in pieces.
WHOLE_BYTES = 16 << 20


def raw_objects(fetched: DataFrame, root: str, filename: Column, max_bytes: int | None = MAX_BYTES) -> DataFrame:
    """``(place_id, content)`` -> ``(place_id, filename, stored_path, content)`` with the size capped."""
    return fetched.select(
        "place_id", filename.alias("filename"),
        object_path(root, F.col("place_id"), filename).alias("stored_path"),
        first_bytes(F.col("content"), max_bytes).alias("content"))


def place_objects(queue: DataFrame, documents: DataFrame, fetch_log: DataFrame, root: str,
                  max_bytes: int | None = MAX_BYTES) -> DataFrame:
    """Bytes kept per place: its fetched homepage and the document that was chosen for it."""
    homes = (queue.select("place_id", F.col("website_uri").alias("url"))
             .join(documents.where("robots_allowed").select("place_id"), "place_id", "left_semi")
             .withColumn("filename", F.lit(HOMEPAGE_FILE)))
    chosen = (documents.where(F.col("stored_path").isNotNull())
              .select("place_id", F.col("source_url").alias("url"),
                      F.substring_index("stored_path", "/", -1).alias("filename"))
              .where(F.col("filename") != HOMEPAGE_FILE))
    wanted = homes.unionByName(chosen)
    fetched = (asked_rows(fetch_log, wanted.select("url").distinct())
               .where(is_fetched(F.col("http_status"), F.col("error"))).select("url", "content"))
    return raw_objects(join_on_unique(wanted, fetched, "url"), root, F.col("filename"), max_bytes)


def scan_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Files below a folder as ``(path, modificationTime, length, content)``, whole whatever their size.

    The folder is listed by Spark, so no list of paths passes the driver's own code. A file is one value, so it must
    be smaller than 2 GB.
    """
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true").load(folder))


def file_digests(spark: SparkSession, folder: str, pattern: str = "*", whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """Files as ``scan_files`` finds them, as ``(path, length, n_read, content_sha256)``: every byte is read, none is kept.

    A file of more than ``whole_bytes`` is never one value. Spark's text source reads its splits as lines, in whatever file
    system it lies; a task joins them to pieces, and the pieces of a file are digested in their order by one task. So memory
    grows with the longest stretch without a line feed, not with the file, which may exceed 2 GB. Names that the text
    source would decompress by (``.gz``) stay one value.
    """
    files = scan_files(spark, folder, pattern)
    packed = F.lit(False)
    for suffix in codec_suffixes(spark):
        packed |= F.col("_metadata.file_name").endswith(suffix)
    # On columns of the listing alone, so that files of the other kind are left out before they are opened.
    whole = (F.col("_metadata.file_size") <= whole_bytes) | packed
    small = files.where(whole).select("path", "length", F.length("content").cast("long").alias("n_read"),
                                      F.sha2("content", 256).alias("content_sha256"))
    large = files.where(~whole).select(F.col("_metadata.file_path").alias("file"), F.lit(-1).cast("long").alias("start"),
                                       F.lit(0).cast("long").alias("seq"), "path", F.col("length").alias("n"),
                                       F.lit(None).cast("binary").alias("piece"))
    lines = (spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").option("lineSep", "\n")
             .text(folder).where(~whole)
             .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                     F.col("value").cast("binary").alias("line")))
    return small.unionByName(_digested(large.unionByName(_pieces(lines))))


def _pieces(lines: DataFrame) -> DataFrame:
    """Lines of each split joined to pieces numbered by ``seq``; then a row of ``start`` -1 with the bytes that the split gave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(file, start, seq, n, piece=None):
            return pa.RecordBatch.from_arrays(
                [pa.array([file]), pa.array([start]), pa.array([seq]), pa.array([None], pa.string()), pa.array([n]),
                 pa.array([piece], pa.binary())], ["file", "start", "seq", "path", "n", "piece"])

        split, seq, total = None, 0, 0
        for batch in batches:
            cuts = sorted({end for c in ("file", "start") for end in pc.run_end_encode(batch[c]).run_ends.to_pylist()})
            for low, high in zip([0, *cuts], cuts):
                key = batch["file"][low].as_py(), batch["start"][low].as_py()
                if key != split:
                    if split:
                        yield row(split[0], -1, 1, total)
                    split, seq, total = key, 0, 0
                # Every line with its line feed, also the last line of a file that does not end with one.
                together = pa.ListArray.from_arrays([low, high], batch["line"])
                piece = pc.binary_join(together, pa.scalar(b"\n", batch["line"].type))[0].as_py() + b"\n"
                yield row(*split, seq, len(piece), piece)
                seq, total = seq + 1, total + len(piece)
        if split:
            yield row(split[0], -1, 1, total)

    return lines.mapInArrow(run, "file string, start long, seq long, path string, n long, piece binary")


def _digested(pieces: DataFrame) -> DataFrame:
    """Digest of each file: its size as listed and the bytes of its splits come first, then its pieces in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = b"\xef\xbb\xbf"  # left out by the text source at the start of a file

        def row():
            if n_read != length:
                raise ValueError(f"{path}: {given} bytes of lines do not make up the {length} of the file")
            return pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([length]), pa.array([n_read]), pa.array([digest.hexdigest()])],
                ["path", "length", "n_read", "content_sha256"])

        at = path = None
        for batch in batches:
            for i in range(batch.num_rows):
                file, start, seq, name, n, piece = (c[i].as_py() for c in batch.columns)
                if file != at:
                    if path:
                        yield row()
                    at, path, length, given, n_read, digest = file, None, None, 0, 0, hashlib.sha256()
                if start < 0 and seq == 0:
                    path, length = name, n
                elif start < 0:
                    given += n
                elif path:
                    if not n_read and length - given in (2, 3):
                        digest.update(mark)
                        n_read = len(mark)
                    # A line feed that the file does not end with is beyond its length.
                    piece = memoryview(piece)[:length - n_read] if length - given in (-1, 2) else piece
                    digest.update(piece)
                    n_read += len(piece)
        if path:
            yield row()

    return (pieces.repartition("file").sortWithinPartitions("file", "start", "seq")
            .mapInArrow(run, "path string, length long, n_read long, content_sha256 string"))


def new_files(spark: SparkSession, folder: str, known: DataFrame | None, pattern: str = "*") -> DataFrame:
    """Files below a folder that ``known`` (``path, modificationTime, length``) does not list, or lists as they were before.

    The listing reads no content. Content is read from files that are at least as old as the first new one (Spark skips
    the others by their time), and passed on for new ones only.
    """
    files = scan_files(spark, folder, pattern)
    if known is None:
        return files
    key = ["path", "modificationTime", "length"]
    fresh = files.select(*key).join(known.select(*key), key, "left_anti")
    first = fresh.agg(F.min("modificationTime").alias("t")).first()["t"]
    if first is None:
        return files.where("false")
    return files.where(F.col("modificationTime") >= F.lit(first)).join(fresh, key, "left_semi")


def latest_files(parsed: DataFrame) -> DataFrame:
    """Of each path the row of its last modification, for results that are added file by file."""
    last = parsed.groupBy("path").agg(F.max("modificationTime").alias("modificationTime"))
    return parsed.join(last, ["path", "modificationTime"], "left_semi")
