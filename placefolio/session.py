"""Session defaults and the shared folder that staged data goes to."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from placefolio.sources.folders import delete

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Run-time re-planning: coalesced shuffles, measured broadcast choice, split of skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A filter on so many values reaches the Parquet reader value by value, not just as a range.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    # Pages reach Python in batches of bounded size, however large they are.
    "spark.sql.execution.arrow.maxBytesPerBatch": "64MB",
}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Without the setting a local session gets a folder of its own; a cluster must name one, because a
    machine-local folder would be lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="placefolio-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


# Staged folders of the scopes that are open.
_scopes: list[list[tuple[str, str]]] = []


@contextmanager
def staging(spark: SparkSession, keep: tuple[str, ...] = ()) -> Iterator[None]:
    """Delete at the end, also after an error, what is staged inside, but for the names in ``keep``."""
    _scopes.append([])
    try:
        yield
    finally:
        for name, path in _scopes.pop():
            if name not in keep:
                delete(spark, path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts the lineage, and later reads prune columns."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/placefolio/{name}-{uuid.uuid4().hex}"
    for scope in _scopes[-1:]:
        scope.append((name, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
