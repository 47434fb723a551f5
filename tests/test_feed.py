"""A feed that a gate refuses leaves the old one."""

import dataclasses

import pytest
from pyspark.sql import DataFrameWriter

from hangarlight.operators.feed import Feed, FeedBusy
from hangarlight.operators.gates import GateError
from hangarlight.operators.refresh import Inputs, refresh
from hangarlight.plans import universe as U
from hangarlight.sources.schemas import CURRENT, MAPPING_COLUMNS

GOOD = {"aircraft": 300_000, "subsidiaries": 1, "gold": {"tail_false_positives": 0}}


def test_refused_feeds_leave_the_old_one(spark, tmp_path):
    feed = Feed(spark, str(tmp_path / "feed"), buckets=4)
    types = {f.name: f.dataType.simpleString() for f in spark.createDataFrame([], CURRENT).schema}
    schema = ", ".join(f"{c} {types[c]}" for c in MAPPING_COLUMNS)
    blank = {"string": "x", "bigint": 1, "boolean": False}

    def rows(n):
        return spark.createDataFrame([tuple(f"N{k + 100}" if c == "n_number" else blank[types[c]] for c in MAPPING_COLUMNS) for k in range(n)], schema)

    empty = [feed.table(t) for t in ("review_queue", "unresolved_trusts")]
    empty[1] = spark.createDataFrame([], empty[1].schema)

    def apply(day, n, **other):
        feed.apply(day, f"{day}T00:00:00Z", 1, rows(n), *empty, **(GOOD | other))

    apply("2026-09-01", 120)
    version = feed.version()
    bad = [(0, {}), (59, {}), (120, {"aircraft": 0}), (120, {"aircraft": 299_999}), (120, {"aircraft": 0, "offline": True}), (120, {"subsidiaries": 0}), (120, {"gold": {"tail_false_positives": 1}})]
    for n, other in bad:
        with pytest.raises(GateError):
            apply("2026-09-02", n, **other)
        assert feed.version() == version
    assert feed.table("mappings_current").filter("deleted_at is null").count() == 120
    apply("2026-09-02", 60, aircraft=5, offline=True, subsidiaries=0, skip_subsidiaries=True)
    assert feed.version() != version and feed.table("mappings_current").filter("deleted_at is null").count() == 60


def test_refresh_publishes_or_leaves_everything(spark, tmp_path, monkeypatch):
    """A whole day; then a refused gate, a crash between two tables, a crash after all of them, and a held lock."""
    t = U.Universe(spark, "/root/testdata/sf0.001")
    gold = U.gold(t)
    inputs = Inputs(
        t["aircraft"], U.listed(t), U.addresses(t), t["aliases"], t["subsidiaries"], t["edgar_hits"], t["licences"], t["overrides"], t["unpublished"], gold, ["TAAA"], ["RING"]
    )
    feed = Feed(spark, str(tmp_path / "feed"), buckets=4)

    def run(day, inputs=inputs, **other):
        return refresh(feed, inputs, "registry", day, f"{day}T00:00:00Z", 5, **({"offline": True} | other))

    report = run("2026-09-01")
    version, rows = feed.version(), feed.table("mappings_current").count()
    assert report["tail_false_positives"] == 0 and rows > 0
    assert feed.table("changelog").filter("change = 'new'").count() == rows
    assert {r.as_of_date for r in feed.table("refresh_run").collect()} == {"2026-09-01"}
    assert spark.read.parquet(f"{feed.root}/snapshots/as_of=2026-09-01/mappings_current").count() == rows
    with pytest.raises(GateError):
        run("2026-09-02", offline=False)
    with pytest.raises(GateError):
        run("2026-09-02", dataclasses.replace(inputs, subsidiaries=t["subsidiaries"].limit(0)))
    plain = DataFrameWriter.parquet
    for last in ("changelog", "refresh_run"):

        def crash(self, path, *a, last=last, **k):
            plain(self, path, *a, **k)
            if path.endswith(last):
                raise OSError("disk")

        monkeypatch.setattr(DataFrameWriter, "parquet", crash)
        with pytest.raises(OSError):
            run("2026-09-02")
        monkeypatch.setattr(DataFrameWriter, "parquet", plain)
        assert feed.version() == version and feed.table("mappings_current").count() == rows
    with Feed(spark, feed.root).locked(), pytest.raises(FeedBusy):
        run("2026-09-02")
    run("2026-09-02")
    assert feed.version() != version
    # Nothing changed, so the log has no new lines, and quiet rows keep their day.
    assert feed.table("changelog").count() == rows and feed.table("mappings_current").filter("as_of_date = '2026-09-01'").count() == rows
