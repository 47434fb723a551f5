"""Resharding by minimum-cost flow: move the fewest bytes from old shards into new, equal capacities.

Old shard sizes and new capacities make a transport problem of shards only (their numbers are
parameters, so it is small): a flow of bytes from old to new shards, free where a block stays in its
shard and 1 per byte where it moves. The flow is then cut into documents: the documents of an old shard
lie on a line, large ones first, and each target takes its stretch of the line, its own shard the first
one. So large documents stay, and the boundaries fall among small ones.

Law ``bytes``: shard sizes are near equal. Positions on the line and slots inside a shard are prefix sums
over (shard, size class, digest range) cells, so no shard is sorted in one task.

Defined results: null text counts 0 bytes plus the row overhead, its CRC is that of the empty text. Rows
with a null id lie at the start of their cell's order. Rows repeating an id and text may land in
different shards, each in one slot; a hash of all columns orders them, and rows alike in all columns are
interchangeable. Texts of any length are one row of a shard. An empty table gives empty shards and no result. Shard files keep all
columns; the result adds those of the plan in place of columns of the same names.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize

OLD_SHARDS = 32
SHARDS = 40
OVERHEAD = 16
#: Digest ranges of a size class of a shard.
CELLS = 256
#: Bytes of text in a file of a shard, as far as its cells allow.
CHUNK = 64 << 20
#: Columns of the plan that a query returns.
PLAN = ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "old_shard")


def min_cost_flow(supply: list[int], capacity: list[int], cost) -> dict[tuple[int, int], int]:
    """Bytes from old shard i to new shard j at least total cost, by successive shortest paths.

    Nodes: old shards, new shards, a source and a sink. ``cost(i, j)`` is per byte and not negative.
    Each augmentation follows a shortest path under Dijkstra with potentials.
    """
    n, m = len(supply), len(capacity)
    if sum(supply) > sum(capacity):
        raise ValueError("capacities are smaller than the shards together")
    flow: dict[tuple[int, int], int] = {}
    left, room = list(supply), list(capacity)
    price = [0] * (n + m)
    while True:
        todo = [i for i in range(n) if left[i]]
        if not todo:
            return {k: v for k, v in flow.items() if v}
        distance = [float("inf")] * (n + m)
        parent = [-1] * (n + m)
        heap = []
        for i in todo:
            distance[i] = 0
            heapq.heappush(heap, (0, i))
        end = -1
        while heap:
            d, u = heapq.heappop(heap)
            if d > distance[u]:
                continue
            if u >= n and room[u - n]:
                end = u
                break
            if u < n:
                steps = [(n + j, cost(u, j)) for j in range(m)]
            else:
                steps = [(i, -cost(i, u - n)) for i in range(n) if flow.get((i, u - n))]
            for v, c in steps:
                reduced = d + c + price[u] - price[v]
                if reduced < distance[v]:
                    distance[v], parent[v] = reduced, u
                    heapq.heappush(heap, (reduced, v))
        reach = distance[end]
        price = [p + min(d, reach) for p, d in zip(price, distance, strict=True)]
        path, u = [], end
        while parent[u] >= 0:
            path.append((parent[u], u))
            u = parent[u]
        amount = min(left[u], room[end - n], *(flow[v, p - n] for p, v in path if p >= n))
        for p, v in path:
            if p < n:
                flow[p, v - n] = flow.get((p, v - n), 0) + amount
            else:
                flow[v, p - n] -= amount
        left[u] -= amount
        room[end - n] -= amount


def capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (k < total % shards) for k in range(shards)]


def old_shard(doc_id: Column, shards: int = OLD_SHARDS) -> Column:
    """The layout to start from: by checksum of the id."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(shards)).cast("int")


def row_hash(docs: DataFrame) -> Column:
    """Of all columns, nulls told apart by place: tells rows that repeat an id and text from each other."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return F.xxhash64(*[c.isNull() for c in columns], *columns)


def text_columns() -> tuple[Column, Column]:
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32")


def narrow_columns(docs: DataFrame, old: Column) -> list[Column]:
    return [F.col("doc_id").cast("long").alias("doc_id"), *text_columns(), row_hash(docs).alias("row_hash"), old.alias("old")]


def with_cells(rows: DataFrame) -> DataFrame:
    digest = F.xxhash64("doc_id", "text_crc32")
    # Larger size classes first; inside a class the order is the digest's.
    size_class = F.lit(64) - F.floor(F.log2("size")).cast("int")
    return rows.withColumn("digest", digest).withColumn("cell", size_class * CELLS + F.shiftrightunsigned("digest", 56).cast("int"))


def narrow_rows(docs: DataFrame, old: Column) -> DataFrame:
    """doc_id, size, text_crc32, row_hash, old shard, and the cell and order inside the shard; texts stay behind."""
    return with_cells(docs.select(*narrow_columns(docs, old)))


def place() -> Column:
    """A row's place on the line of its shard; only rows alike in all columns share one. Free of nulls."""
    known, number = F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0)).alias("id")
    return F.struct("cell", "digest", known, number, "size", "row_hash")


def running(rows: DataFrame, key: str, value: Column, out: str) -> DataFrame:
    """Sum of ``value`` over the rows in front of each row in its key's order (cell, digest)."""
    rows = rows.withColumn("_v", value)
    order = ["digest", "doc_id", "size", "row_hash"]
    cells = rows.groupBy(key, "cell").agg(F.sum("_v").alias("_sum"))
    ahead = Window.partitionBy(key).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select(key, "cell", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_start"))
    # Keyed alike, so the window's partitioning serves the join as well.
    inside = Window.partitionBy(key, "cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = rows.withColumn("_inside", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
    return own.join(starts, [key, "cell"]).withColumn(out, F.col("_start") + F.col("_inside")).drop("_v", "_start", "_inside")


def assign(rows: DataFrame, shards: int, old_shards: int) -> tuple[DataFrame, dict[tuple[int, int], int]]:
    """Column ``shard`` for narrow rows, and the flow it follows."""
    sizes = {r["old"]: r["bytes"] for r in rows.groupBy("old").agg(F.sum("size").alias("bytes")).filter("old is not null").collect()}
    supply = [sizes.get(k, 0) for k in range(old_shards)]
    flow = min_cost_flow(supply, capacities(sum(supply), shards), lambda i, j: int(i != j))
    pieces = []
    for i in range(old_shards):
        at = 0
        for j in sorted((j for a, j in flow if a == i), key=lambda j: (j != i, j)):
            pieces.append((i, j, at, at + flow[i, j]))
            at += flow[i, j]
    # One row per transfer: at most old_shards + 2 * shards, whatever the data.
    ranges = rows.sparkSession.createDataFrame(pieces or [(0, 0, 0, 0)], "old int, shard int, low long, high long")
    lines = ranges.groupBy("old").agg(F.array_sort(F.collect_list(F.struct("low", "high", "shard"))).alias("line"))
    placed = running(rows, "old", F.col("size"), "at").join(F.broadcast(lines), "old")
    middle = F.col("at") + F.expr("size div 2")
    piece = F.filter("line", lambda x: (x["low"] <= middle) & (middle < x["high"]))
    return placed.withColumn("shard", piece[0]["shard"]).drop("line", "at"), flow


def reshard(docs: DataFrame, shards: int = SHARDS, old_shards: int = OLD_SHARDS, old: Column | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, old_shard, row_hash for each document: the plan."""
    rows = materialize(narrow_rows(docs, old_shard(F.col("doc_id"), old_shards) if old is None else old))
    placed, _ = assign(rows, shards, old_shards)
    slotted = running(materialize(placed), "shard", F.lit(1), "slot")
    return slotted.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("old").alias("old_shard", metadata={"old_shards": old_shards if old is None else 0}),
        "row_hash",
    )


def shard_label(docs: DataFrame) -> str:
    """Name of the partition column of the files: ``shard``, or ``_shard`` if the documents have a column of that name."""
    return "_shard" if "shard" in (c.lower() for c in docs.columns) else "shard"


def wide_rows(docs: DataFrame, rows: DataFrame, old: Column) -> DataFrame:
    """The whole documents as ``_doc``, with ``_old``, ``_shard``, ``_cell`` and ``_place``, by the plan's ``rows``.

    On the line of an old shard each new shard has one stretch, so its two ends place a document without a join
    by row. Rows alike in all columns can stand on both sides of an end; of these at most as many as there are
    stretches, one is taken and repeated as often as the plan says.
    """
    stretches = materialize(rows.groupBy("_old", "_shard").agg(F.min("_place").alias("low"), F.max("_place").alias("high")))
    lines = stretches.groupBy("_old").agg(F.collect_list(F.struct("low", "high", "_shard")).alias("_line"))
    ends = stretches.select("_old", F.explode(F.array_distinct(F.array("low", "high"))).alias("_place"))
    torn = materialize(ends.groupBy("_old", "_place").count().filter("count > 1").select("_old", "_place"))
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.struct(*narrow_columns(docs, old)).alias("_n"))
    wide = with_cells(wide.select("_doc", "_n.*")).select("_doc", F.col("old").alias("_old"), place().alias("_place"))
    stretch = F.filter("_line", lambda x: (x["low"] <= F.col("_place")) & (F.col("_place") <= x["high"]))
    out = wide.join(F.broadcast(lines), "_old").withColumn("_shard", stretch[0]["_shard"]).drop("_line")
    if torn.count():
        copies = rows.join(F.broadcast(torn), ["_old", "_place"]).groupBy("_old", "_place", "_shard").count()
        one = wide.join(F.broadcast(torn), ["_old", "_place"], "left_semi").dropDuplicates(["_old", "_place"])
        again = one.join(F.broadcast(copies), ["_old", "_place"]).withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("count")))).drop("_k", "count")
        out = out.join(F.broadcast(torn), ["_old", "_place"], "left_anti").unionByName(again)
    return out.withColumn("_cell", F.col("_place.cell"))


def chunks_of(rows: DataFrame) -> DataFrame:
    """_shard, _cell, _chunk, _first: cells of a shard in files of about CHUNK bytes, and each file's first slot."""
    cells = rows.groupBy("_shard", F.col("_place.cell").alias("_cell")).agg(F.count("*").alias("n"), F.sum("_place.size").alias("bytes"))
    ahead = Window.partitionBy("_shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select(
        "_shard",
        "_cell",
        F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("_at"),
        F.floor(F.coalesce(F.sum("bytes").over(ahead), F.lit(0)) / CHUNK).cast("long").alias("_chunk"),
    )
    return starts.withColumn("_first", F.min("_at").over(Window.partitionBy("_shard", "_chunk"))).drop("_at")


def rewrite(docs: DataFrame, placed: DataFrame, path: str, old: Column | None = None, everything: bool = False) -> list[int]:
    """Write the files of the shards that gain or lose documents under ``path``/shard=k; returns their numbers.

    ``placed`` is what ``reshard`` returned for the same documents; ``old`` is needed if ``reshard`` was given it.
    Shards without a transfer are left as they are, unless ``everything`` is asked for because ``path`` has no old
    files. A shard that has lost all its documents loses its files. The files hold all columns and ``_slot``, and
    are dealt by (shard, range of slots), so that one large shard is written by many tasks.
    """
    if old is None:
        old_shards = placed.schema["old_shard"].metadata.get("old_shards")
        if not old_shards:
            raise ValueError("the plan's old shards are not those by id; give the column")
        old = old_shard(F.col("doc_id"), old_shards)
    rows = materialize(with_cells(placed).select(F.col("old_shard").alias("_old"), F.col("shard").alias("_shard"), place().alias("_place")))
    pairs = rows.select("_old", "_shard").distinct().collect()  # bounded by the numbers of shards
    numbers = sorted({k for i, j in pairs if everything or i != j for k in (i, j)})
    emptied = set(numbers) - {j for _, j in pairs}
    out = wide_rows(docs, rows, old).filter(F.col("_shard").isin(numbers)).join(F.broadcast(chunks_of(rows)), ["_shard", "_cell"])
    inside = F.row_number().over(Window.partitionBy("_shard", "_chunk").orderBy("_place"))
    label = shard_label(docs)
    (
        out.select("_doc.*", (F.col("_first") + inside - 1).alias("_slot"), F.col("_shard").alias(label))
        .sortWithinPartitions(label, "_slot")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(label)
        .parquet(path)
    )
    jvm = docs.sparkSession.sparkContext._jvm
    for k in sorted(emptied):
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{label}={k}")
        folder.getFileSystem(docs.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return numbers


def read_shards(docs: DataFrame, path: str) -> DataFrame:
    """The written documents with ``_slot`` and the partition column; for an empty folder as well."""
    fields = [*docs.schema.fields, T.StructField("_slot", T.LongType()), T.StructField(shard_label(docs), T.IntegerType())]
    return docs.sparkSession.read.schema(T.StructType(fields)).parquet(path)


def reshard_files(docs: DataFrame, path: str, shards: int = SHARDS, old_shards: int = OLD_SHARDS) -> DataFrame:
    """Plan, write every shard into the new folder ``path``, and return what the files hold, in ``docs``' columns and the plan's.

    Size, checksum, shard and slot come from the written files. An input column of a name of the plan's is in the
    files but not in the result.
    """
    rewrite(docs, reshard(docs, shards, old_shards), path, everything=True)
    written = read_shards(docs, path)
    size, crc = text_columns()
    plan = [
        F.col("doc_id").cast("long").alias("doc_id"),
        size,
        crc,
        F.lit("bytes").alias("law"),
        F.col(shard_label(docs)).alias("shard"),
        F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        old_shard(F.col("doc_id"), old_shards).alias("old_shard"),
    ]
    return written.select(*plan, *[F.col(f"`{c}`") for c in docs.columns if c.lower() not in PLAN])
