"""Folders in whatever file system Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``, none if it is missing."""
    system, at = _system(spark, path)
    if not system.exists(at):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(at) if s.isDirectory())


def delete(spark: SparkSession, path: str) -> None:
    system, at = _system(spark, path)
    system.delete(at, True)


def codec_suffixes(spark: SparkSession) -> list[str]:
    """Ends of the file names that Hadoop's readers of lines decompress by."""
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    return sorted(hadoop.util.ReflectionUtils.newInstance(codec, conf).getDefaultExtension()
                  for codec in hadoop.io.compress.CompressionCodecFactory.getCodecClasses(conf))
