"""Reports and outputs on small tables: exports, live rows, sample addresses, alias candidates, names inside names."""

import random

from pyspark.sql import functions as F

from hangarlight.operators import analytics, feed
from hangarlight.plans.queries import QUERIES
from hangarlight.sources.schemas import MAPPING_COLUMNS

from .test_store import FIRST, SECOND, publish


def test_live_rows_and_exports_are_in_the_order_of_tails(spark, tmp_path):
    kept = feed.Feed(spark, str(tmp_path / "f"), buckets=4)
    publish(kept, FIRST, "2026-09-01")
    publish(kept, SECOND, "2026-09-02")
    live = feed.current_mappings(kept.table("mappings_current"))
    assert live.columns == list(MAPPING_COLUMNS)
    assert [r.n_number for r in live.collect()] == sorted(SECOND)
    kept.export_csv(live, "mappings")
    back = spark.read.csv(f"{kept.root}/exports/mappings", header=True)
    assert back.columns == live.columns and [(r.n_number, r.ticker) for r in back.collect()] == sorted(SECOND.items())
    kept.export_csv(live.limit(1), "mappings")
    assert spark.read.csv(f"{kept.root}/exports/mappings", header=True).count() == 1


def test_sample_rows_get_the_address_of_their_tail(spark):
    aircraft = spark.createDataFrame([("N1", "1 MAIN", "RENO", "NV"), ("N2", "2 MAIN", "ELKO", "NV"), ("N2", "9 MAIN", "A", "B")], "n_number string, street string, city string, state string")
    sample = spark.createDataFrame([(" N1 ", "a"), ("N2", "b"), ("N3", "c"), ("N1", "d")], "n_number string, label string")
    found = sorted(tuple(r) for r in analytics.with_registry_address(sample, aircraft).select("n_number", "label", "street", "city", "state").collect())
    assert found == [("N1", "a", "1 MAIN", "RENO", "NV"), ("N1", "d", "1 MAIN", "RENO", "NV"), ("N2", "b", "2 MAIN", "ELKO", "NV"), ("N3", "c", None, None, None)]


def test_alias_candidates_gather_the_tails_that_a_name_would_add(spark):
    rows = [("AA", "Alpha Air", "N2", "addable"), ("AA", "ALPHA AIR", "N1", "addable"), ("AA", "Alpha Air", "N1", "addable"), ("AA", "Alpha Jets", "N3", "addable"), ("BB", "Beta", "N4", "review_queue")]
    found = analytics.alias_candidates(spark.createDataFrame(rows, "ticker string, name string, n_number string, reason string"))
    assert sorted((r.ticker, r.name, r.tails) for r in found.collect()) == [("AA", "ALPHA AIR", ["N1", "N2"]), ("AA", "ALPHA JETS", ["N3"])]
    assert analytics.alias_candidates(QUERIES["alias_reasons"](spark, "/root/testdata/sf0.001")).columns == ["ticker", "name", "tails"]


def test_names_within_texts(spark):
    chosen = random.Random(3)
    word = lambda: "".join(chosen.choice("AB ") for _ in range(chosen.randint(0, 14)))
    texts = {word() for _ in range(400)} | {"é" * 7, "TRUST ABABAB"}
    names = {t[chosen.randint(0, 3) : 14] for t in texts} | {word() for _ in range(100)} | {"é" * 6, "NOWHERE"}
    found = analytics.names_within(spark.createDataFrame([(t,) for t in texts] * 2, "text string"), spark.createDataFrame([(n,) for n in names] * 2, "norm string"))
    wanted = sorted((n, t) for n in names for t in texts if n == t or (len(n) >= analytics.GRAM and n in t))
    assert sorted(tuple(r) for r in found.collect()) == wanted and len(wanted) > 100
    assert found.select(F.col("norm")).limit(0).count() == 0


def test_the_census_joins_names_by_equality(spark):
    plan = QUERIES["gold_miss_buckets"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
