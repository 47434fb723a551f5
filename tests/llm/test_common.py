"""Row selection by bitmaps, joins on hot keys, and word hashes."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hangarlight.llm import common, wordhash


@pytest.mark.parametrize("most, levels", [(common.FILTER_BITS, common.FILTER_LEVELS), (1 << 15, 1), (1 << 15, 2), (1 << 15, 3)])
@pytest.mark.parametrize("gone", [0.0, 0.02, 0.6, 1.0])
def test_kept_rows_are_exact_with_and_without_keys_in_doubt(spark, most, levels, gone):
    """With bitmaps much too small, most keys are in doubt and the join settles them."""
    rows = [(None if k % 97 == 0 else k, f"t{k % 5}", k) for k in range(40_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, keep int")
    stays = F.pmod(F.xxhash64("doc_id", "text", F.lit(5)), F.lit(1000)) >= int(gone * 1000)
    decided = docs.select("doc_id", "text").distinct().withColumn("keep", stays)
    found = common.keep_rows(docs, decided, {"doc_id": F.col("doc_id"), "text": F.col("text")}, most, levels)
    assert found.columns == docs.columns
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, docs.filter(stays).collect()))


def test_hot_keys_are_dealt_evenly_and_joined_whole(spark):
    rows = spark.createDataFrame([(None if k % 3 == 0 else 7 if k % 3 == 1 else k, k) for k in range(9_000)], "key long, v long")
    side = spark.createDataFrame([(7, "seven", 1), (8, "eight", 2), (11, "eleven", 3), (11, "again", 4)], "key long, name string, n long")
    hot = common.hot_keys(rows, ["key"])
    assert {r.key for r in hot.collect()} == {None, 7}
    per_task = common.salted(rows, hot, ["key"], F.xxhash64("v")).groupBy("key", "_salt").count()
    assert per_task.agg(F.max("count")).first()[0] < 9_000 / 16 * 1.5
    for how in ("inner", "left"):
        found = common.join_hot(rows, side, ["key"], how)
        assert sorted(map(str, found.collect())) == sorted(map(str, rows.join(side, "key", how).collect()))


def test_words_made_to_collide_do_not(spark):
    """Thue-Morse words and their complements collide under every polynomial modulo 2^64."""
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    for _, data, offsets in wordhash.chunks(pa.array([f"{a} {b} {a.upper()}"])):
        hashes, *_ = wordhash.words(data, offsets, wordhash.SPACED)
    assert hashes[0] != hashes[1] and hashes[0] == hashes[2] and len(np.unique(hashes)) == 2
