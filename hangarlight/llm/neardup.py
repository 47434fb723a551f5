"""Near-duplicate grouping: SuperMinHash signatures, banding, verification on full sets, components.

How it stays whole and bounded:

* Rows with equal shingle sets are one class from the start, so groups of exact copies, however large, never
  meet in a band.
* In each band bucket every class is compared with the bucket's hub, the class that shares most buckets with
  others: linear in the bucket. Verified links are grouped into components.
* No link between two members is lost by comparing with the hub only. For two members x, y under a hub H
  a link needs ``|x and y| >= ceil(t (|x| + |y|) / (1 + t))``, and at most ``min(|x and H|, |y and H|)`` of
  these shingles lie inside H. So either x and y share a shingle outside H, or both overlaps with H reach
  that bound. The first kind is found by a join on shingles outside the hub, cut to each member's rarest
  ones (prefix filter) and to pairs whose shingles from there on can do for a link (positional filter); the second by a join on size classes, where a member meets only the sizes that its
  overlap allows. Both start from members outside the hub's component. A passage that many documents share
  lies inside the hub and makes no pairs.
* A class, bucket, hub or shingle that holds many rows is dealt over several tasks (``join_hot``).
* Sets to verify are made where the texts lie, for ids that pass a bitmap of the candidates; ``dedup`` selects its
  rows by such bitmaps (``keep_rows``). Bitmaps have a largest size. Beyond it, at about 1e8 ids, sets that need no
  comparison pass as well and are shuffled, and ``dedup`` joins rows that are left in doubt, with their texts.

Two sets at exactly the threshold share none of the 32 bands with probability (1 - 0.75^4)^32, about 5e-6;
such a pair is missed unless a third document links both.

Defined results: null or blank text has an empty set and is linked with nothing. Rows with a null id
take part in nothing: component null, kept true. Rows that repeat an id are one document: each row has its own
set size, links of any of them count for all, and ``dedup`` keeps one row of it. Texts of any length are read whole. An empty
table has no result. Reports read doc_id and text alone; ``dedup`` keeps all columns, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bits_of, hot_from, hot_keys, join_hot, keep_rows, materialize, may_hold, repeated, salted
from .superminhash import band_hashes, signatures
from .wordhash import SPACED, chunks, distinct, mix64, window_hashes, words

SHINGLE = 5
THRESHOLD = 75  # percent
SIGNATURE = 128
BAND_ROWS = 4


def _shingle_sets(column: pa.Array, width: int):
    """(first row, sorted distinct hashes, offsets, digests d1 and d2 of the sets) over runs of rows."""
    for row, data, offsets in chunks(column):
        hashes, _, _, bounds = words(data, offsets, SPACED)
        shingles, doc = window_hashes(hashes, bounds, width)
        sets, at = distinct(shingles, doc, len(offsets) - 1)
        cumulated = np.zeros((2, len(sets) + 1), dtype=np.uint64)
        np.cumsum(sets, out=cumulated[0, 1:])
        np.cumsum(mix64(sets ^ np.uint64(0x5851F42D4C957F2D)), out=cumulated[1, 1:])
        yield row, sets, at, (cumulated[:, at[1:]] - cumulated[:, at[:-1]]).view(np.int64)


def sign(docs: DataFrame, width: int = SHINGLE, m: int = SIGNATURE, rows: int = BAND_ROWS) -> DataFrame:
    """doc_id, text_hash, n_shingles, a 128-bit digest (d1, d2) of the shingle set, and its band hashes."""

    def run(batches):
        for batch in batches:
            ids, text, text_hash = batch.column(0), batch.column(1), batch.column(2)
            for row, sets, at, (d1, d2) in _shingle_sets(text, width):
                n = np.diff(at)
                bands = band_hashes(signatures(sets, at, m), rows)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(np.where(n > 0, bands.shape[1], 0))]).astype(np.int32)),
                    pa.array(bands[n > 0].reshape(-1)),
                )
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(row, len(n)), text_hash.slice(row, len(n)), pa.array(n), pa.array(d1), pa.array(d2), lists],
                    names=["doc_id", "text_hash", "n_shingles", "d1", "d2", "bands"],
                )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        run, "doc_id long, text_hash long, n_shingles long, d1 long, d2 long, bands array<long>"
    )


def shingle_arrays(docs: DataFrame, width: int = SHINGLE, ids: np.ndarray | None = None) -> DataFrame:
    """doc, d1 and the sorted array of distinct shingle hashes; given a bitmap of ids, only rows that pass it."""
    sent = None if ids is None else docs.sparkSession.sparkContext.broadcast(ids)

    def run(batches):
        for batch in batches:
            if sent is not None:
                hashes = batch.column(2).to_numpy(zero_copy_only=False)
                batch = batch.filter(pa.array(may_hold(sent.value, hashes)))
            for row, sets, at, (d1, _) in _shingle_sets(batch.column(1), width):
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(sets.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(at) - 1), pa.array(d1), lists], names=["doc", "d1", "shingles"])

    return docs.select("doc_id", "text", F.xxhash64("doc_id").alias("h")).mapInArrow(run, "doc long, d1 long, shingles array<long>")


def linked(n_a, n_b, inter, threshold: int = THRESHOLD):
    """The link condition, in whole numbers."""
    return 100 * inter >= threshold * (n_a + n_b - inter)


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Full sets of each pair side by side: the pair, na, nb, inter and ``rest``, the shingles of a outside b.

    Pairs (a, b, a_doc, a_d1, b_doc, b_d1); sets (doc, d1, shingles), one for each (doc, d1).
    """
    hot = hot_keys(pairs, ["b_doc", "b_d1"])
    by_hub = salted(pairs, hot, ["b_doc", "b_d1"], F.xxhash64("a"))
    copies = repeated(sets, hot.withColumnsRenamed({"b_doc": "doc", "b_d1": "d1"}), ["doc", "d1"])
    # Both joins ask for the same dealing of the sets, so they are shuffled once.
    with_b = by_hub.join(
        copies.select(F.col("doc").alias("b_doc"), F.col("d1").alias("b_d1"), "_salt", F.col("shingles").alias("set_b")), ["b_doc", "b_d1", "_salt"]
    )
    both = with_b.withColumn("_salt", F.col("_salt") * 0).join(
        copies.select(F.col("doc").alias("a_doc"), F.col("d1").alias("a_d1"), "_salt", F.col("shingles").alias("set_a")), ["a_doc", "a_d1", "_salt"]
    )
    rest = F.array_except("set_a", "set_b")
    return both.select("a", "b", "a_doc", "b_doc", F.size("set_a").alias("na"), F.size("set_b").alias("nb"), rest.alias("rest")).withColumn(
        "inter", F.col("na") - F.size("rest")
    )


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """id -> smallest id reachable, for every id on an edge (a, b).

    Union-find grouping as rounds of two steps: each node hooks its larger neighbours to its smallest
    one, then each node hooks itself and its smaller neighbours to the smallest. Edges shrink to stars;
    each round at least halves the depth of the trees. Rounds end when one changes no edge; should that not
    happen in ``rounds`` of them, an error is raised.
    """
    stars = edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).filter("u <> v").distinct()
    before = None
    for _ in range(rounds):
        both = stars.union(stars.select(F.col("u").alias("v"), F.col("v").alias("u")))
        smallest = both.groupBy("v").agg(F.min("u").alias("m")).withColumn("m", F.least("m", "v"))
        large = both.join(smallest, "v").filter("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = large.filter("u <> v").distinct()
        lowest = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(lowest, "v").select(
            F.explode(F.array(F.struct("v", F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e")
        )
        stars = materialize(small.select("e.v", "e.u").filter("u <> v").distinct())
        if before is not None and stars.count() == before.count() and not stars.join(before, ["v", "u"], "left_anti").limit(1).count():
            break
        before = stars
    else:
        raise RuntimeError("components did not settle")
    return stars.select(F.col("v").alias("id"), F.col("u").alias("component")).union(
        stars.select(F.col("u").alias("id"), F.col("u").alias("component")).distinct()
    )


def _hub_pairs(classes: DataFrame) -> DataFrame:
    """(a, b): each member of a band bucket with the bucket's hub, once over all bands."""
    key = ["band", "hash"]
    banded = classes.select("id", F.posexplode("bands").alias("band", "hash"))
    counts = materialize(banded.groupBy(*key).agg(F.count("*").alias("c")).filter("c > 1"))
    hot = hot_from(counts, key, "c")
    shared = materialize(join_hot(banded, counts, key, hot=hot))
    weight = shared.groupBy("id").agg(F.sum("c").alias("weight"))
    # Ties go to the smallest document, which is the same in every bucket.
    central = F.min_by("id", F.struct(-F.col("weight"), "doc", "id")).alias("hub")
    hubs = shared.join(weight.join(classes.select("id", "doc"), "id"), "id").groupBy(*key).agg(central)
    met = join_hot(shared, hubs, key, hot=hot).filter("id <> hub")
    return met.select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()


def _needed(n_a, n_b, threshold: int):
    """Shingles that sets of these sizes must share to be linked."""
    return F.ceil((n_a + n_b) * threshold / (100 + threshold))


def _size_class(n):
    """Classes of sizes within about 3 %."""
    return F.floor(F.log(n.cast("double")) / 0.03).cast("int")


def _of(side: DataFrame, suffix: str, keep: list[str]) -> DataFrame:
    return side.select(*[F.col(c) if c in keep else F.col(c).alias(c + suffix) for c in side.columns])


def _missed_pairs(compared: DataFrame, known: DataFrame, threshold: int) -> DataFrame:
    """Pairs under one hub, in different components, that may be linked (see above)."""
    narrow = compared.select("a", "b", "a_doc", "b_doc")
    own = known.select(F.col("id").alias("a_doc"), F.col("component").alias("own"))
    of_hub = known.select(F.col("id").alias("b_doc"), F.col("component").alias("of_hub"))
    labelled = join_hot(narrow.join(own, "a_doc", "left"), of_hub, ["b_doc"], "left", hot_keys(narrow, ["b_doc"]))
    labelled = labelled.withColumn("own", F.coalesce("own", "a_doc"))
    labelled = materialize(labelled.withColumn("minor", F.col("own") != F.coalesce("of_hub", "b_doc")).select("a", "b", "own", "minor"))
    open_hubs = labelled.filter("minor").select("b").distinct()
    chosen = join_hot(labelled, open_hubs, ["b"])
    members = materialize(compared.select("a", "b", "na", "inter", "rest").join(chosen, ["a", "b"]))
    smallest = F.greatest(F.col("na") * threshold / 100, F.lit(1))  # a partner is no smaller than this
    k = F.greatest(F.lit(1), _needed(F.col("na"), smallest, threshold) - F.col("inter"))
    rows = members.select("a", "b", "own", "minor", "na", "inter", F.size("rest").alias("d"), k.alias("k"), "rest").filter("k <= d")
    rows = rows.withColumn("s", F.explode("rest")).drop("rest")
    shared = materialize(
        rows.groupBy("b", "s").agg(
            F.count("*").alias("c"), F.max("minor").alias("any_minor"), F.min("own").alias("low"), F.max("own").alias("high")
        ).filter("any_minor and low <> high").select("b", "s", "c")
    )
    met = join_hot(rows, shared, ["b", "s"], hot=hot_from(shared, ["b", "s"], "c"))
    each = Window.partitionBy("a", "b")
    # Shingles that make no pair count as the rarest ones.
    rank = F.col("d") - F.count("*").over(each) + F.row_number().over(each.orderBy("c", "s"))
    left = F.col("d") - F.col("rank") + 1  # shingles from this one on
    prefix = met.withColumn("rank", rank).filter("rank <= d - k + 1")
    prefix = materialize(prefix.select("b", "s", "a", "own", "minor", "na", "inter", left.alias("left")))
    x, y = _of(prefix.filter("minor"), "_x", ["b", "s"]), _of(prefix, "_y", ["b", "s"])
    # At the first shingle that a pair shares, what is left of both and their overlaps with the hub must do for a link.
    enough = F.least("left_x", "left_y") + F.least("inter_x", "inter_y") >= _needed(F.col("na_x"), F.col("na_y"), threshold)
    sizes = 100 * F.least("na_x", "na_y") >= threshold * F.greatest("na_x", "na_y")
    outside = (
        join_hot(x, y, ["b", "s"])
        .filter((F.col("own_x") != F.col("own_y")) & sizes & enough)
        .select(F.col("a_x").alias("p"), F.col("a_y").alias("q"))
    )
    # Without a shingle outside the hub, a partner is at most as large as the overlap with the hub allows.
    lean = members.select("a", "b", "own", "minor", "na", "inter")
    low = F.ceil(F.col("na") * threshold / 100)
    high = F.floor(F.col("inter") * (100 + threshold) / threshold) - F.col("na")
    reach = F.explode(F.sequence(_size_class(low), _size_class(high))).alias("size")
    asking = lean.filter("minor").withColumns({"low": low, "high": high}).filter("low >= 1 and high >= low").select("a", "b", "own", "na", "inter", reach)
    asked = lean.withColumn("size", _size_class(F.col("na")))
    inside = (
        join_hot(_of(asking, "_x", ["b", "size"]), _of(asked, "_y", ["b", "size"]), ["b", "size"])
        .filter((F.col("own_x") != F.col("own_y")) & (F.least("inter_x", "inter_y") >= _needed(F.col("na_x"), F.col("na_y"), threshold)))
        .select(F.col("a_x").alias("p"), F.col("a_y").alias("q"))
    )
    return outside.union(inside).select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def grouped(docs: DataFrame, threshold: int = THRESHOLD, width: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, n_shingles, d1, component_id for each row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = materialize(sign(docs, width))
    key = ["n_shingles", "d1", "d2"]
    per_class = materialize(signed.groupBy(*key).agg(F.count("*").alias("_n"), F.min("doc_id").alias("doc")))
    hot = hot_from(per_class, key, "_n")
    named = per_class.filter("n_shingles > 0 and doc is not null").drop("_n")
    found = signed.filter("doc_id is not null and n_shingles > 0")
    # Of each set, the row with the smallest id stands for the class; repeated rows of it are alike.
    firsts = join_hot(found, named, key, hot=hot).filter("doc_id = doc").dropDuplicates(["doc", *key])
    classes = materialize(firsts.select(F.monotonically_increasing_id().alias("id"), "doc", *key, "bands"))
    several = materialize(found.groupBy("doc_id").agg(F.count("*").alias("n"), F.min(F.struct(*key)).alias("low"), F.max(F.struct(*key)).alias("high")).filter("n > 1"))
    repeats = bool(several.limit(1).count())
    lean = classes.select("id", "doc", "d1")

    def ends(pairs: DataFrame) -> DataFrame:
        """The classes' (doc, d1) beside the pair."""
        b = lean.select(F.col("id").alias("b"), F.col("doc").alias("b_doc"), F.col("d1").alias("b_d1"))
        a = lean.select(F.col("id").alias("a"), F.col("doc").alias("a_doc"), F.col("d1").alias("a_d1"))
        return materialize(join_hot(pairs, b, ["b"]).join(a, "a"))

    def sets_of(pairs: DataFrame) -> DataFrame:
        wanted = materialize(pairs.select(F.explode(F.array("a_doc", "b_doc")).alias("doc")).distinct().select(F.xxhash64("doc").alias("h")))
        sets = shingle_arrays(docs.filter("doc_id is not null"), width, bits_of(wanted, "h"))
        return sets.dropDuplicates(["doc", "d1"]) if repeats else sets

    is_linked = linked(F.col("na"), F.col("nb"), F.col("inter"), threshold)
    pairs = ends(materialize(_hub_pairs(classes)))
    compared = materialize(compare(pairs, sets_of(pairs)))
    links = compared.filter(is_linked).select(F.col("a_doc").alias("a"), F.col("b_doc").alias("b"))
    if repeats:
        # Rows of one id with different sets are one document: it is linked with the first document of each set.
        torn = several.filter("low <> high").select("doc_id")
        links = links.union(found.join(torn, "doc_id").join(named, key).select(F.col("doc_id").alias("a"), F.col("doc").alias("b")))
    known = components(links)
    more = ends(materialize(_missed_pairs(compared, known, threshold)))
    extra = materialize(compare(more, sets_of(more)).filter(is_linked).select(F.col("a_doc").alias("a"), F.col("b_doc").alias("b")))
    if extra.limit(1).count():
        known = components(links.union(extra))
    labelled = named.join(known, named["doc"] == known["id"], "left").select(*key, F.coalesce("component", "doc").alias("component_id"))
    lone = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    rows = join_hot(signed.drop("bands"), labelled, key, "left", hot)
    return rows.select("doc_id", "text_hash", "n_shingles", "d1", lone.alias("component_id"))


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD, width: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs`` (doc_id, text).

    Component: everything reachable over links with ``100 * intersection >= threshold * union`` of the
    distinct ``width``-word shingles. kept: the document is its component's smallest id.
    """
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    return grouped(docs, threshold, width).select("doc_id", "n_shingles", "component_id", kept)


def dedup(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """One row of each near-duplicate group, and all rows with a null id, with all columns of ``docs``.

    Of a group the row with the smallest id stays; if that id stands on several rows, one of them does.
    """
    rows = materialize(grouped(docs.select("doc_id", "text"), threshold))
    row = F.struct("d1", "text_hash")
    best = rows.filter("doc_id = component_id").groupBy("doc_id").agg(F.min(row).alias("best"), F.count("*").alias("n"))
    keys = rows.groupBy("doc_id", "text_hash", "d1").agg(F.count("*").alias("times"))
    chosen = F.col("doc_id").isNull() | F.coalesce(F.col("best") == row, F.lit(False))
    decided = materialize(keys.join(best, "doc_id", "left").select("doc_id", "text_hash", chosen.alias("keep"), "times"))
    on = {"doc_id": F.col("doc_id").cast("long"), "text_hash": F.xxhash64(F.col("text").cast("string"))}
    alike = decided.filter("keep and times > 1 and doc_id is not null")
    if not alike.limit(1).count():
        return keep_rows(docs, decided, on)
    # Rows alike in id and text cannot be told apart in place: set those aside, one of each.
    again = F.col("keep") & (F.col("times") > 1) & F.col("doc_id").isNotNull()
    once = keep_rows(docs, decided.withColumn("keep", F.col("keep") & ~again), on)
    some = keep_rows(docs, decided.withColumn("keep", again), on)
    single = some.withColumns({f"_{k}": c for k, c in on.items()}).dropDuplicates([f"_{k}" for k in on]).drop(*[f"_{k}" for k in on])
    return once.unionByName(single)
