"""The change feed: a source of a feed's published changes, as batch or stream, and a sink that can be repeated.

Each publication has records of what it changed. Its marker's number is the stream's offset, so a reader sees whole
publications in their order, each once, and none that did not end; what a crashed run left has no marker.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import filesystem, names

#: ``op``: I (insert) or U (update); images are JSON. ``before`` is given for updated mappings.
CHANGE = "version long, table string, op string, key string, as_of_date string, before string, after string"


def published(root: str) -> dict[int, str]:
    """number -> version of all markers."""
    return {int(m.split(".", 1)[0]): m.split(".", 1)[1] for m in names(f"{root}/published")}


@dataclass
class ChangeFile(InputPartition):
    path: str

    def __post_init__(self):
        super().__init__(self.path)


def _files(root: str, after: int, until: int) -> list[ChangeFile]:
    """The change files of publications after ``after`` up to ``until``."""
    found = published(root)
    folders = [f"{root}/{found[k]}/changes" for k in sorted(found) if after < k <= until]
    return [ChangeFile(f"{folder}/{name}") for folder in folders for name in names(folder) if name.endswith(".parquet")]


def _batches(partition: ChangeFile):
    from pyarrow import parquet

    store, path = filesystem(partition.path)
    with parquet.ParquetFile(path, filesystem=store) as file:
        yield from file.iter_batches(1 << 14)


class _Batch(DataSourceReader):
    def __init__(self, root: str, after: int, until: int):
        self.root, self.after, self.until = root, after, until

    def partitions(self):
        return _files(self.root, self.after, self.until)

    def read(self, partition):
        return _batches(partition) if partition is not None else iter(())


class _Stream(DataSourceStreamReader):
    def __init__(self, root: str, after: int):
        self.root, self.after = root, after

    def initialOffset(self):
        return {"version": self.after}

    def latestOffset(self):
        return {"version": max(published(self.root), default=self.after)}

    def partitions(self, start, end):
        return _files(self.root, start["version"], end["version"])

    def read(self, partition):
        return _batches(partition)


class FeedChanges(DataSource):
    """Format ``feed_changes``: the path of a feed; ``after`` (a version's number, 0 for all) and, for batches, ``until``."""

    @classmethod
    def name(cls):
        return "feed_changes"

    def schema(self):
        return CHANGE

    def _root(self) -> str:
        return self.options["path"].rstrip("/")

    def reader(self, schema):
        return _Batch(self._root(), int(self.options.get("after", 0)), int(self.options.get("until", 1 << 62)))

    def streamReader(self, schema):
        return _Stream(self._root(), int(self.options.get("after", 0)))


def changes(spark: SparkSession, root: str, after: int = 0, until: int | None = None) -> DataFrame:
    """The records of publications after ``after`` up to ``until``."""
    spark.dataSource.register(FeedChanges)
    reader = spark.read.format("feed_changes").option("after", after)
    return (reader if until is None else reader.option("until", until)).load(root)


def change_stream(spark: SparkSession, root: str, after: int = 0) -> DataFrame:
    """The records of all publications after ``after``, and of those to come."""
    spark.dataSource.register(FeedChanges)
    return spark.readStream.format("feed_changes").option("after", after).load(root)


def follow(stream: DataFrame, sink: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Keep ``stream`` in a table of one folder a version.

    A batch replaces the folders of its versions whole, so a batch that runs again, even without its checkpoint,
    changes nothing. ``trigger`` as of ``DataStreamWriter.trigger``.
    """

    def put(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(sink)

    writer = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def latest(records: DataFrame, table: str, schema: str) -> DataFrame:
    """The rows of a captured table as its records leave them: the last image of each key."""
    rows = records.filter(F.col("table") == table)
    last = rows.groupBy("key").agg(F.max_by("after", "version").alias("after"))
    return last.select(F.from_json("after", schema).alias("r")).select("r.*")
