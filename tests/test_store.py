"""The bucketed store and the change feed: what a day writes, what a diff shuffles, what a restarted reader sees."""

import json
from collections import Counter

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from hangarlight.operators import buckets, changefeed, feed
from hangarlight.sources.schemas import CURRENT, MAPPING_COLUMNS, REVIEW_COLUMNS, TRUST_COLUMNS

TEXT = set(MAPPING_COLUMNS) - {"fleet_size", "aviation_issuer"}
SCHEMA = ", ".join(f"{c} {'string' if c in TEXT else 'long' if c == 'fleet_size' else 'boolean'}" for c in MAPPING_COLUMNS)


def mappings(spark, owners, day):
    """Rows of {tail: ticker}."""
    rows = [tuple({"n_number": n, "ticker": t, "as_of_date": day, "fleet_size": len(owners), "aviation_issuer": False}.get(c, "x") for c in MAPPING_COLUMNS) for n, t in owners.items()]
    return spark.createDataFrame(rows, SCHEMA)


def publish(kept, owners, day, moment=5):
    rest = [kept.spark.createDataFrame([], ", ".join(f"{c} string" for c in columns)) for columns in (REVIEW_COLUMNS, TRUST_COLUMNS)]
    kept.publish(day, f"{day}T00:00:00Z", moment, mappings(kept.spark, owners, day), *rest)


def state(kept):
    return {r.n_number: (r.ticker, r.as_of_date, r.deleted_at) for r in kept.table("mappings_current").collect()}


DAYS = ["2026-09-01", "2026-09-02", "2026-09-03"]
FIRST = {f"N{k}": "AA" for k in range(100, 140)}
SECOND = {n: t for n, t in FIRST.items() if n != "N101"} | {"N100": "BB"}
THIRD = FIRST | {"N100": "BB", "N999": "CC"}


@pytest.fixture(scope="module")
def three_days(spark, tmp_path_factory):
    kept = feed.Feed(spark, str(tmp_path_factory.mktemp("feed") / "f"), buckets=8)
    files, states = [], []
    for day, owners in zip(DAYS, (FIRST, SECOND, THIRD), strict=True):
        publish(kept, owners, day)
        files.append(kept.files())
        states.append(state(kept))
    return kept, files, states


def test_a_day_writes_the_buckets_of_its_changed_tails_only(spark, three_days):
    kept, files, states = three_days
    assert states[0] == {n: ("AA", DAYS[0], None) for n in FIRST}
    assert states[1] == states[0] | {"N100": ("BB", DAYS[1], None), "N101": ("AA", DAYS[0], 5)}
    assert states[2] == states[1] | {"N101": ("AA", DAYS[2], None), "N999": ("CC", DAYS[2], None)}
    touched = [{r[0] for r in spark.createDataFrame([(n,) for n in tails], "n string").select(buckets.bucket_of("n", 8)).collect()} for tails in (["N100", "N101"], ["N101", "N999"])]
    for k, changed in enumerate(touched):
        assert 0 < len(changed) < 8
        assert {f[0] for f in set(files[k + 1]) - set(files[k])} == changed
        assert [f for f in files[k] if f[0] not in changed] == [f for f in files[k + 1] if f[0] not in changed]
    log = [tuple(r) for r in kept.table("changelog").filter("as_of_date > '2026-09-01'").orderBy("as_of_date", "n_number").collect()]
    assert log == [(DAYS[1], "N100", "owner_changed", "AA x -> BB x"), (DAYS[1], "N101", "dropped", "AA x"), (DAYS[2], "N101", "new", "AA x"), (DAYS[2], "N999", "new", "CC x")]
    assert sorted(r.as_of_date for r in kept.table("refresh_run").collect()) == DAYS


def test_a_quiet_day_writes_no_bucket(spark, tmp_path):
    kept = feed.Feed(spark, str(tmp_path / "f"), buckets=4)
    publish(kept, FIRST, DAYS[0])
    before = kept.files()
    publish(kept, FIRST, DAYS[1])
    assert kept.files() == before and state(kept) == {n: ("AA", DAYS[0], None) for n in FIRST}
    publish(kept, {}, DAYS[2])
    assert all(r[2] == 5 for r in state(kept).values())
    assert changefeed.changes(spark, kept.root, after=1, until=2).filter("table = 'mappings_current'").count() == 0


def test_the_diff_of_bucketed_tables_shuffles_nothing(spark, three_days):
    kept, files, _ = three_days
    current = kept.table("mappings_current")
    schema = CURRENT.removesuffix(", deleted_at long")
    incoming = buckets.write_buckets(mappings(spark, SECOND, DAYS[2]), "n_number", 8, kept.root, "plan_test")
    new = buckets.read_buckets(spark, incoming, "n_number", 8, kept.root, schema)
    matched = feed.match(current, new)
    for df in (matched, feed.next_current(matched, 7)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    plain = feed.match(spark.createDataFrame(current.collect(), CURRENT), mappings(spark, SECOND, DAYS[2]))
    assert Counter(map(str, matched.collect())) == Counter(map(str, plain.collect()))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("buckets_")]


def test_vacuum_removes_what_no_kept_version_needs(spark, tmp_path):
    kept = feed.Feed(spark, str(tmp_path / "f"), buckets=4)
    for day, owners in zip(DAYS, (FIRST, SECOND, THIRD), strict=True):
        publish(kept, owners, day)
    (tmp_path / "f" / "v-died" / "incoming").mkdir(parents=True)
    before, logs = state(kept), [kept.table(t).count() for t in ("changelog", "refresh_run")]
    old = set(kept.files(kept.versions()[1])) - set(kept.files())
    assert kept.vacuum(keep=2) >= 7 and all((tmp_path / "f" / folder / name).exists() for _, folder, name in old)
    assert kept.vacuum(keep=1) == len(old) and not any((tmp_path / "f" / folder / name).exists() for _, folder, name in old)
    assert kept.vacuum(keep=1) == 0 and not (tmp_path / "f" / "v-died").exists()
    assert state(kept) == before and logs == [kept.table(t).count() for t in ("changelog", "refresh_run")]
    assert changefeed.changes(spark, kept.root).select("version").distinct().count() == 3
    publish(kept, FIRST, "2026-09-04")
    assert state(kept)["N999"] == ("CC", DAYS[2], 5)


def records(df):
    return Counter((r.version, r.table, r.op, r.key) for r in df.collect())


def expected(version, inserts=(), updates=(), day=None):
    rows = [(version, "mappings_current", op, n) for op, tails in (("I", inserts), ("U", updates)) for n in tails]
    return Counter(rows + [(version, "changelog", "I", r[3]) for r in rows] + [(version, "refresh_run", "I", day)])


def test_changes_carry_images(spark, three_days):
    kept, _, states = three_days
    found = changefeed.changes(spark, kept.root)
    wanted = expected(1, FIRST, day=DAYS[0]) + expected(2, updates=["N100", "N101"], day=DAYS[1]) + expected(3, ["N999"], ["N101"], day=DAYS[2])
    assert records(found) == wanted
    gone = found.filter("version = 2 and table = 'mappings_current' and key = 'N101'").first()
    before, after = json.loads(gone.before), json.loads(gone.after)
    assert before["deleted_at"] is None and after == before | {"deleted_at": 5} and not {"fleet_size", "aviation_issuer"} & set(after)
    schema = ", ".join(f"{c} string" for c in MAPPING_COLUMNS if c in TEXT) + ", deleted_at long"
    replica = changefeed.latest(found, "mappings_current", schema)
    assert {r.n_number: (r.ticker, r.as_of_date, r.deleted_at) for r in replica.collect()} == states[-1]


def test_a_restarted_reader_sees_each_change_once(spark, tmp_path, monkeypatch):
    """Three days with a crashed publication between them; the reader stops after each, and once loses its checkpoint."""
    kept = feed.Feed(spark, str(tmp_path / "f"), buckets=4)
    sink, checkpoint = str(tmp_path / "sink"), str(tmp_path / "checkpoint")

    def catch_up(checkpoint=checkpoint):
        query = changefeed.follow(changefeed.change_stream(spark, kept.root), sink, checkpoint, availableNow=True)
        assert query.awaitTermination(120) and query.exception() is None
        seen = spark.read.schema(changefeed.CHANGE).parquet(sink)
        return records(seen), sum(p["numInputRows"] for p in query.recentProgress)

    publish(kept, FIRST, DAYS[0])
    first = expected(1, FIRST, day=DAYS[0])
    assert catch_up() == (first, first.total())
    plain = DataFrameWriter.parquet

    def crash(self, path, *a, **k):
        plain(self, path, *a, **k)
        if path.endswith("refresh_run"):
            raise OSError("disk")

    monkeypatch.setattr(DataFrameWriter, "parquet", crash)
    with pytest.raises(OSError):
        publish(kept, THIRD, DAYS[1])
    monkeypatch.setattr(DataFrameWriter, "parquet", plain)
    assert catch_up()[0] == first
    publish(kept, SECOND, DAYS[1])
    second = first + expected(2, updates=["N100", "N101"], day=DAYS[1])
    assert catch_up() == (second, 5)
    publish(kept, THIRD, DAYS[2])
    third = second + expected(3, ["N999"], ["N101"], day=DAYS[2])
    assert catch_up(str(tmp_path / "lost")) == (third, third.total())
    assert catch_up()[0] == third
