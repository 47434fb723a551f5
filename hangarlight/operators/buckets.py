"""A keyed table in hash buckets, of which a new version replaces only the buckets that changed.

Files are written by Spark's bucketed writer, each by its bucket's task, sorted by the key. A version is a list of (bucket,
file); files of buckets that did not change stay in it. Read back, a version is a bucketed relation again, so
joins and groups by the key need no shuffle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import names

FILES = "bucket int, folder string, file string"


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket that Spark's writer and its hash partitioning give a key."""
    return F.pmod(F.hash(key), F.lit(buckets))


def _bucket_in(file: str) -> int:
    """The bucket in the name of a file: ``part-..._00003.c000.snappy.parquet``."""
    return int(file.split(".", 1)[0].rsplit("_", 1)[1])


def write_buckets(df: DataFrame, key: str, buckets: int, root: str, folder: str) -> list[tuple[int, str, str]]:
    """Write ``df`` in buckets into ``root/folder``; its files. Buckets without rows have none."""
    spark, name = df.sparkSession, f"buckets_{uuid.uuid4().hex}"
    dealt = df.repartitionById(buckets, bucket_of(key, buckets))  # a bucket is one task and one file
    dealt.write.format("parquet").option("path", f"{root}/{folder}").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return [(_bucket_in(f), folder, f) for f in names(f"{root}/{folder}") if f.startswith("part-")]


def read_buckets(spark: SparkSession, files: list[tuple[int, str, str]], key: str, buckets: int, root: str, schema: str) -> DataFrame:
    """The rows of ``files`` as a relation in buckets; the catalog's entry lives for the reading of its definition only."""
    if not files:
        return spark.createDataFrame([], schema)
    name = f"buckets_{uuid.uuid4().hex}"
    listed = ",".join(sorted(f for _, _, f in files))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.createDataFrame([], schema).schema)
    spark.sql(
        f"CREATE TABLE {name} ({fields}) USING parquet OPTIONS ('recursiveFileLookup' 'true', 'pathGlobFilter' '{{{listed}}}') "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{root}'"
    )
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # external: the files stay


def replaced(files: list[tuple[int, str, str]], new: list[tuple[int, str, str]], changed: set[int]) -> list[tuple[int, str, str]]:
    """The files of the next version: those of ``changed`` buckets are the new ones."""
    return sorted([f for f in files if f[0] not in changed] + new)
