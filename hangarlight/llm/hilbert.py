"""Nearest neighbours by shifted space-filling curves.

Vectors are projected to a few dimensions, several times with other directions and shifts, and each
projection is ordered along a Hilbert curve by one range partitioning in Spark. A curve is cut into blocks of
equally many rows; a query meets the rows of the blocks around its own place, on each curve, candidates are scored
exactly on the original vectors, and the curves' results merge.

Directions follow the data: they are drawn from the covariance of a bounded sample (``SAMPLE_ROWS`` rows), so that
dimensions in which vectors differ count. The number of curves and the width of the windows are the choice that
lets a query meet the fewest rows while the sample's own neighbours lie in the windows with ``RECALL``; in the
sample a row stands for n / SAMPLE_ROWS rows, so its nearest few stand for the nearest ``TOP``. Every row is
indexed. The result's recall is then measured by brute force for ``CHECKED`` queries against all rows; below
``LEAST_RECALL`` the windows double, up to the whole curve, which is exact. Nothing is capped.

Data without locality (independent random directions) leave little to gain: a query meets most of the rows, over
all curves. Data with clusters or few true dimensions meet a small part.

Nearness is the inner product. Vectors are lifted by one coordinate to equal length, so the largest
product is the smallest distance. Defined results: null, zero or non-finite vectors, null ids and vectors
of another dimension than most take no part; products that overflow are infinite scores. Equal scores go to the
smaller id. Rows that repeat an id are queries and candidates of their own, alike or not: a query meets every row but its
own. Very long vectors are compared whole; columns besides vec_id and embedding are not read.
An empty table has no result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

TOP = 20
QUERY_STEP = 20
CURVES = 8
PROJECTED, BITS = 6, 8
SAMPLE_ROWS = 8192
SAMPLE_QUERIES = 256
CHECKED = 128
RECALL = 0.95
LEAST_RECALL = 0.9
#: Most rows of a block; a window is more blocks where it must be wider.
BLOCK = 8192
SEED = 11


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with integer coordinates below 2^bits (Skilling's transform)."""
    x = cells.T.astype(np.int64).copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros(x.shape[1], dtype=np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where(x[n - 1] & q, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros(x.shape[1], dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _matrix(column) -> np.ndarray:
    """Rows of a list column of one common length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1).astype(np.float64) if n else np.zeros((0, 1))


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(row, vec_id, vector) of the rows that take part, and the dimension; ``row`` is a number of each row's own."""
    single = vectors.schema["embedding"].dataType.elementType.simpleString() == "float"
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>" if single else "array<double>").alias("vector"))
    v = v.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.filter(~odd & F.exists("vector", lambda x: x != 0))
    common = v.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    dim = common[0]["d"] if common else 1
    # The numbers are written with the rows, so every later reading finds the same.
    return materialize(v.filter(F.size("vector") == dim).select(F.monotonically_increasing_id().alias("row"), "vec_id", "vector")), dim


def bounded_sample(rows: DataFrame, dim: int, size: int = SAMPLE_ROWS) -> tuple[np.ndarray, float]:
    """At most ``size`` vectors, chosen by a digest of their id, and the largest length of any vector."""
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(size).select("vector").toArrow()
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    longest = rows.agg(F.max(F.sqrt(squares))).first()[0] or 1.0
    return _matrix(chosen.column(0)).reshape(-1, dim), float(longest)


@dataclass
class Curves:
    """Projections of lifted vectors, and where and how wide each lies on the grid of its curve."""

    longest: float
    turns: np.ndarray  # (curves, dimension + 1, projected)
    middle: np.ndarray  # (curves, projected)
    width: np.ndarray
    shift: np.ndarray

    def lift(self, v: np.ndarray) -> np.ndarray:
        v = v / self.longest
        return np.concatenate([v, np.sqrt(np.maximum(1.0 - (v * v).sum(axis=1), 0.0))[:, None]], axis=1)

    def keys(self, v: np.ndarray) -> np.ndarray:
        """(rows, curves) places on the curves."""
        full = self.lift(v)
        out = [
            hilbert_keys((((full @ t - m) / w + 0.5 + s) * (1 << BITS)).clip(0, (1 << BITS) - 1).astype(np.int64), BITS)
            for t, m, w, s in zip(self.turns, self.middle, self.width, self.shift, strict=True)
        ]
        return np.stack(out, axis=1) if out else np.zeros((len(v), 0), np.int64)


def fit_curves(sample: np.ndarray, longest: float, count: int = CURVES) -> Curves:
    """Random directions weighted by the sample's covariance, grids fitted to its spread, and random shifts."""
    if not np.isfinite(longest):
        longest = float(np.abs(sample).max()) * np.sqrt(sample.shape[1])
    curves = Curves(longest, *(np.zeros(0) for _ in range(4)))
    full = curves.lift(sample)
    rng = np.random.default_rng(SEED)
    k = min(PROJECTED, sample.shape[1])
    centred = full - full.mean(axis=0)
    covariance = centred.T @ centred / len(full) + 1e-9 * np.eye(full.shape[1])
    turns = np.stack([np.linalg.qr(covariance @ rng.normal(size=(full.shape[1], k)))[0] for _ in range(count)])
    projected = full @ turns
    spread = projected.std(axis=1)
    # Six standard deviations and the shift fit on the grid; what lies outside goes to its edge.
    return Curves(longest, turns, projected.mean(axis=1), np.where(spread > 0, spread, 1.0) * 8, rng.uniform(-0.12, 0.12, (count, k)))


@dataclass
class Choice:
    curves: Curves
    part: float  # rows of a block as a share of all; a window is a block and its two neighbours
    candidates: float  # expected share of the rows that a query meets


def calibrate(sample: np.ndarray, longest: float, n: int, top: int = TOP, most: int = CURVES, recall: float = RECALL) -> Choice:
    """The curves and block width by which a query meets the fewest rows while windows hold ``recall`` of the neighbours."""
    curves = fit_curves(sample, longest, most)
    size = len(sample)
    queries = np.arange(min(SAMPLE_QUERIES, size))
    near = min(max(1, round(top * size / max(n, size))), max(1, size - 1))
    scaled = sample / curves.longest
    scores = scaled[queries] @ scaled.T
    scores[queries, queries] = -np.inf
    truth = np.argpartition(-scores, near - 1, axis=1)[:, :near] if size > 1 else np.zeros((len(queries), 0), np.int64)
    at = np.argsort(np.argsort(curves.keys(sample), axis=0, kind="stable"), axis=0) / size
    best = None
    for part in np.geomspace(1 / size, 1 / 3, 60) if size > 3 else [1.0]:
        block = np.floor(at / part)
        met = np.abs(block[queries][:, None, :] - block[truth]) <= 1  # queries, neighbours, curves
        for count in range(1, most + 1):
            found = met[:, :, :count].any(axis=2)
            share = 1 - (1 - min(1.0, 3 * part)) ** count
            cost = share + 0.005 * count
            if (not found.size or found.mean() >= recall) and (best is None or cost < best[0]):
                best = (cost, count, part, share)
    _, count, part, share = best or (1.0, most, 1.0, 1.0)
    kept = Curves(curves.longest, curves.turns[:count], curves.middle[:count], curves.width[:count], curves.shift[:count])
    return Choice(kept, float(part), float(share))


def places(rows: DataFrame, curves: Curves, n: int) -> DataFrame:
    """row, curve, place: where each of the ``n`` rows stands on each curve, from 0."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = curves.keys(_matrix(batch.column(1)))
            count = keys.shape[1]
            ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), count)
            numbers = np.tile(np.arange(count, dtype=np.int32), len(keys))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(numbers), pa.array(keys.reshape(-1))], names=["row", "curve", "key"])

    order = ["curve", "key", "row"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.select("row", "vector").mapInArrow(run, "row long, curve int, key long")
    ordered = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # The id holds the partition in its high bits and the row in its low 33.
    numbered = materialize(ordered.select("row", "curve", F.monotonically_increasing_id().alias("at")))
    numbered = numbered.withColumn("part", F.shiftright("at", 33)).withColumn("ahead", F.col("at").bitwiseAND((1 << 33) - 1))
    counts = numbered.groupBy("part").agg(F.count("*").alias("n"))  # one row per partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    # Every curve holds all rows, so the places of a curve begin at its number times n.
    place = F.col("start") + F.col("ahead") - F.col("curve").cast("long") * n
    return numbered.join(F.broadcast(starts), "part").select("row", "curve", place.alias("place"))


def _best(q_rows, q, v_rows, v_ids, v, top):
    """Exact best ``top`` of v for each q but its own row: (q's row, place in v, score), ties to smaller ids."""
    out_q, out_v, out_s = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    with np.errstate(over="ignore", invalid="ignore"):
        for k in range(0, len(q), 256):
            part, own = q[k : k + 256], q_rows[k : k + 256]
            scores = np.nan_to_num(part @ v.T, nan=-np.inf, posinf=np.inf, neginf=-np.inf)
            other = own[:, None] != v_rows[None, :]
            near = other
            if scores.shape[1] > top + 1:
                edge = np.partition(np.where(other, scores, -np.inf), -top, axis=1)[:, -top]
                # Products of a block may differ in their last bits from those of single pairs.
                near = other & (scores >= np.where(np.isfinite(edge), edge - 1e-9 * (1 + np.abs(edge)), edge)[:, None])
            row, col = np.nonzero(near)
            exact = np.einsum("ij,ij->i", part[row], v[col])
            order = np.lexsort((v_rows[col], v_ids[col], -np.nan_to_num(exact, nan=-np.inf, posinf=np.inf, neginf=-np.inf), row))
            row, col, exact = row[order], col[order], exact[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            keep = rank < top
            out_q.append(own[row[keep]])
            out_v.append(col[keep])
            out_s.append(exact[keep])
    return np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_s)


FOUND = "query_row long, row long, vec_id long, score double"
_NAMES = [f.split()[0] for f in FOUND.split(", ")]


def _found(q_rows, q, v_rows, v_ids, v, top) -> list[pa.Array]:
    query, at, score = _best(q_rows, q, v_rows, v_ids, v, top)
    return [pa.array(x) for x in (query, v_rows[at], v_ids[at], score)]


def _top(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def search(rows: DataFrame, placed: DataFrame, n: int, block: int, reach: int, top: int, step: int) -> DataFrame:
    """FOUND rows ranked: each query meets the blocks within ``reach`` of its own, on every curve."""
    last = max(0, (n - 1) // block)
    spread = rows.join(placed.select("row", "curve", F.expr(f"place div {block}").alias("block")), "row")
    low, high = F.greatest(F.lit(0), F.col("block") - reach), F.least(F.lit(last), F.col("block") + reach)
    asking = spread.filter(F.col("vec_id") % step == 0).select("row", "vector", "curve", F.explode(F.sequence(low, high)).alias("block"))

    def meet(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows or not held.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.float64())], names=_NAMES)
        rows, ids = held["held_row"].to_numpy(), held["held_vec_id"].to_numpy()
        return pa.table(_found(asked["row"].to_numpy(), _matrix(asked["vector"]), rows, ids, _matrix(held["held_vector"]), top), names=_NAMES)

    held = spread.select(*[F.col(c).alias(f"held_{c}") for c in ("row", "vec_id", "vector", "curve", "block")])
    met = asking.groupBy("curve", "block").cogroup(held.groupBy("held_curve", "held_block")).applyInArrow(meet, FOUND)
    return _top(met.distinct(), top)


def brute_force(rows: DataFrame, top: int, step: int) -> DataFrame:
    """query_row, row of the true neighbours of at most CHECKED queries."""
    chosen = rows.filter(F.col("vec_id") % step == 0).orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(CHECKED).toArrow()
    q_rows, q = chosen["row"].to_numpy(), _matrix(chosen["vector"])

    def compare(batches):
        for batch in batches:
            if len(q_rows) and batch.num_rows:
                held = [batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(_found(q_rows, q, *held, _matrix(batch.column(2)), top), names=_NAMES)

    return materialize(_top(rows.mapInArrow(compare, FOUND), top).select("query_row", "row"))


def nearest(vectors: DataFrame, top: int = TOP, step: int = QUERY_STEP, curves: int = CURVES, recall: float = RECALL, least: float = LEAST_RECALL) -> DataFrame:
    """query_id, rank, vec_id, score of the nearest rows of every query (vec_id divisible by ``step``), and how they were found.

    recall: of the true neighbours of the checked queries, the share found; curves, and window: the rows of a
    query's window on each.
    """
    rows, dim = usable(vectors)
    n = rows.count()
    if not n:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double, recall double, curves int, window long")
    choice = calibrate(*bounded_sample(rows, dim), n, top, curves, recall)
    placed = materialize(places(rows, choice.curves, n))
    truth = brute_force(rows, top, step)
    width = max(1, min(n, int(np.ceil(choice.part * n))))
    block = min(width, BLOCK)
    reach = -(-width // block)
    wanted = truth.count()
    while True:
        found = materialize(search(rows, placed, n, block, reach, top, step))
        share = found.join(truth, ["query_row", "row"], "left_semi").count() / wanted if wanted else 1.0
        if share >= least or reach * block >= n:
            break
        reach *= 2
    asked = rows.filter(F.col("vec_id") % step == 0).select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"))
    return found.join(asked, "query_row").select(
        "query_id",
        F.col("rank").cast("int").alias("rank"),
        "vec_id",
        "score",
        F.lit(share).alias("recall"),
        F.lit(len(choice.curves.turns)).alias("curves"),
        F.lit(min(n, (2 * reach + 1) * block)).cast("long").alias("window"),
    )
