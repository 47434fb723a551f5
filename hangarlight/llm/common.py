"""Helpers that the operators share: cut lineage, join hot keys evenly, select wide rows without shuffling them."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

_WIDE = (ArrayType, MapType, StructType)
#: Most bits of one filter that is sent to the tasks: 16 MB.
FILTER_BITS = 1 << 27
#: Filters that decide on one another's false hits before what is left is joined.
FILTER_LEVELS = 6
_BITMAP = 1 << 15  # bits of a row of Spark's bitmap aggregates


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; a temporary one only where none is configured and Spark is local."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="checkpoints-"))
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table into the shared checkpoint folder and go on from there.

    Unlike a checkpoint, a table is columnar and does not carry over what the optimizer inferred for ``df``; over
    many steps those constraints would grow until planning takes longer than the work.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/step_{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hot_from(counts: DataFrame, key: list[str], n: str, total: int | None = None) -> DataFrame:
    """Keys of ``counts`` with more than a quarter of a task's even share of all rows, and their ``_salts``.

    Each holds more than 1 / (4 x shuffle partitions) of all rows, so there are fewer of them than 4 x partitions,
    whatever the data: they fit the driver and can be broadcast.
    """
    spark = counts.sparkSession
    if total is None:
        total = counts.agg(F.sum(n)).first()[0] or 0
    lot = max(1, total // (4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    hot = counts.filter(F.col(n) > lot).select(*key, F.ceil(F.col(n) / lot).cast("int").alias("_salts"))
    return spark.createDataFrame(hot.collect(), hot.schema)


def hot_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    """``hot_from`` for the keys of materialised ``rows``."""
    return hot_from(rows.groupBy(*key).agg(F.count("*").alias("_n")), key, "_n", rows.count())


def _null_safe(df: DataFrame, other: DataFrame, key: list[str], how: str) -> DataFrame:
    """Join on ``key`` where null equals null; of ``other``'s columns those beside the key are added."""
    named = other.select(*[F.col(k).alias(f"_other_{k}") for k in key], *[c for c in other.columns if c not in key])
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_other_{k}"))
    return df.join(named, same, how).drop(*[f"_other_{k}" for k in key])


def salted(rows: DataFrame, hot: DataFrame, key: list[str], by: Column) -> DataFrame:
    """``rows`` with a ``_salt`` that deals the rows of each hot key over its salts; null keys can be hot as well."""
    marked = _null_safe(rows, F.broadcast(hot), key, "left")
    return marked.withColumn("_salt", F.pmod(by, F.coalesce("_salts", F.lit(1))).cast("int")).drop("_salts")


def repeated(side: DataFrame, hot: DataFrame, key: list[str]) -> DataFrame:
    """``side`` once for each salt of its key."""
    marked = _null_safe(side, F.broadcast(hot), key, "left")
    return marked.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))).drop("_salts")


def join_hot(rows: DataFrame, side: DataFrame, key: list[str], how: str = "inner", hot: DataFrame | None = None) -> DataFrame:
    """Join ``rows``, of which few keys may hold most, with ``side`` (few rows a key) on ``key``, in even tasks.

    ``rows`` should be materialised unless ``hot`` is given. Inner and left joins only.
    """
    if hot is None:
        hot = hot_keys(rows, key)
    by = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns if not isinstance(rows.schema[c].dataType, _WIDE)])
    return salted(rows, hot, key, by).join(repeated(side, hot, key), [*key, "_salt"], how).drop("_salt")


def bits_of(hashes: DataFrame, column: str, most: int = FILTER_BITS) -> np.ndarray:
    """A bitmap of at most ``most`` bits in which each value of the long ``column`` sets two bits."""
    n = hashes.count()
    bits = _BITMAP
    while bits < most and bits < 16 * n:
        bits *= 2
    places = F.explode(F.array(*[p + 1 for p in _places(F.col(column), bits)]))
    # Positions from 1 on: row of the bitmap, and bit inside the row.
    rows = (
        hashes.select(places.alias("p"))
        .groupBy(F.bitmap_bucket_number("p").alias("row"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bitmap"))
        .toArrow()
    )
    out = np.zeros((bits // _BITMAP, _BITMAP // 8), dtype=np.uint8)
    for row, bitmap in zip(rows["row"].to_pylist(), rows["bitmap"].to_pylist(), strict=True):
        out[row - 1] = np.frombuffer(bitmap, dtype=np.uint8)
    return out.reshape(-1)


def _places(value: Column, bits: int) -> list[Column]:
    mask = F.lit(bits - 1).cast("long")
    return [value.bitwiseAND(mask), F.shiftrightunsigned(value, 32).bitwiseAND(mask)]


def may_hold(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values (long) may be among those that made the bitmap; all that are, and few others."""
    mask = np.int64(len(bits) * 8 - 1)
    found = np.ones(len(values), dtype=bool)
    for place in (values & mask, (values.view(np.uint64) >> np.uint64(32)).view(np.int64) & mask):
        found &= (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0
    return found


def holds(sent: Broadcast):
    """The test against a broadcast bitmap as a column function; only the hash goes to Python."""

    @F.pandas_udf("boolean")
    def test(values: pd.Series) -> pd.Series:
        return pd.Series(may_hold(sent.value, values.to_numpy(dtype=np.int64)))

    return test


def keep_rows(docs: DataFrame, decided: DataFrame, on: dict[str, Column], most: int = FILTER_BITS, levels: int = FILTER_LEVELS) -> DataFrame:
    """The rows of ``docs`` whose key is decided to stay, with wide columns left where they are.

    ``on``: name and expression over ``docs`` of each key column; ``decided``: one row (names, keep) for each key
    of ``docs``, null-safe. A cascade of bitmaps decides: the first holds the keys that go, the second those that
    stay but seem to be in the first, the third those that go but seem to be in the second, and so on. Every key is
    known, so the answer is exact once no key is left in doubt. Bitmaps have a fixed largest size; keys still in
    doubt after ``levels`` of them, as with very many keys, are settled by a join that shuffles only their rows.
    """
    spark, names = docs.sparkSession, list(on)

    def hashed(level: int, columns: list) -> Column:
        return F.xxhash64(F.lit(level), *columns)

    columns = [F.col(n) for n in names]
    decided = materialize(decided.select(*names, "keep"))
    inside, other = decided.filter("not keep"), decided.filter("keep")
    verdicts = []  # (not in this level's bitmap: stays?)
    for level in range(levels):
        bits = bits_of(inside.select(hashed(level, columns).alias("_h")), "_h", most)
        test = holds(spark.sparkContext.broadcast(bits))
        verdicts.append((test, level % 2 == 0))
        doubtful = materialize(other.filter(test(hashed(level, columns))))
        settled = not doubtful.limit(1).count()
        if settled:
            break
        inside, other = doubtful, inside
    last = F.lit(len(verdicts) % 2 == 0) if settled else F.lit(None).cast("boolean")
    for level in reversed(range(len(verdicts))):
        test, stays = verdicts[level]
        last = F.when(~F.col(f"_in{level}"), F.lit(stays)).otherwise(last)
    tests = {f"_in{k}": test(hashed(k, list(on.values()))) for k, (test, _) in enumerate(verdicts)}
    marked = docs.select("*", *[c.alias(n) for n, c in tests.items()]).withColumn("_stays", last).drop(*tests)
    sure = marked.filter("_stays").drop("_stays")
    if settled:
        return sure
    keyed = marked.filter("_stays is null").drop("_stays").select("*", *[c.alias(f"_key_{n}") for n, c in on.items()])
    open_keys = inside.union(other).filter("keep").select(*[F.col(n).alias(f"_key_{n}") for n in names])
    asked = _null_safe(keyed, open_keys, [f"_key_{n}" for n in names], "left_semi")
    return sure.unionByName(asked.select(*docs.columns))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
