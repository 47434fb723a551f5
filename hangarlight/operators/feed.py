"""The published feed: day-over-day diff with soft deletes, changelog, run log, snapshots and reads.

Tables are Parquet directories under one root. A publication writes a new version of every table and then adds a
numbered marker that names it; markers are never changed or removed, and the highest one counts. Creating a marker
is one step of the file system, so readers see all of the old version or all of the new one, and a run that dies
before it leaves the old version in place. A lock file keeps two runs from publishing at once.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import canonical_n_number, is_calendar_day, is_utc_instant
from ..sources.schemas import CHANGELOG, CURRENT, MAPPING_COLUMNS, REVIEW_COLUMNS, RUN, TRUST_COLUMNS
from . import buckets, gates

IDENTITY = ("ticker", "cik", "match_method", "registrant_name")
#: Columns that follow from others; they change without a change of the mapping.
DERIVED = ("fleet_size", "aviation_issuer")
#: Buckets of the current table.
BUCKETS = 32


def last_per_tail(published: DataFrame) -> DataFrame:
    """One row per tail: duplicates are settled by the largest identity, so reruns agree."""
    row = F.struct(*IDENTITY, *[c for c in MAPPING_COLUMNS if c not in IDENTITY])
    # n_number stays the grouped column itself, so that a join by it needs no further shuffle.
    return published.groupBy("n_number").agg(F.max(row).alias("r")).select(*(F.col(c if c == "n_number" else f"r.{c}").alias(c) for c in MAPPING_COLUMNS))


def match(current: DataFrame, published: DataFrame) -> DataFrame:
    """Full outer join of the current rows, deleted ones too, with the new ones: old, o (old where it lives), n (new) and
    the change of each tail, which is null for tails that were deleted before and stay so.

    Where both sides lie in the same buckets by n_number, nothing is shuffled.
    """
    old = current.select(F.col("n_number"), F.struct(*current.columns).alias("old"))
    new = last_per_tail(published).select(F.col("n_number"), F.struct(*MAPPING_COLUMNS).alias("n"))
    same = F.lit(True)
    for c in IDENTITY:
        same = same & F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
    change = (
        F.when(F.col("o").isNull() & F.col("n").isNull(), F.lit(None).cast("string"))
        .when(F.col("n").isNull(), "dropped")
        .when(F.col("o").isNull(), "new")
        .when(same, "quiet")
        .when(F.col("o.ticker") != F.col("n.ticker"), "owner_changed")
        .otherwise("updated")
    )
    met = old.join(new, "n_number", "full_outer").withColumn("o", F.when(F.col("old.deleted_at").isNull(), F.col("old")))
    return met.withColumn("change", change)


def diff(current: DataFrame, published: DataFrame) -> DataFrame:
    """``match`` without the tails that were deleted before and stay so."""
    return match(current, published).filter("change is not null")


def changelog(changes: DataFrame, as_of: str) -> DataFrame:
    old = F.concat_ws(" ", "o.ticker", "o.match_method")
    new = F.concat_ws(" ", "n.ticker", "n.match_method")
    detail = F.when(F.col("change") == "dropped", old).when(F.col("change") == "new", new).otherwise(F.concat_ws(" -> ", old, new))
    return changes.filter("change <> 'quiet'").select(F.lit(as_of).alias("as_of_date"), "n_number", "change", detail.alias("detail"))


def next_current(matched: DataFrame, deleted_at: int) -> DataFrame:
    """The new current table from ``match``. Quiet rows keep everything they had, dropped ones gain ``deleted_at``,
    others take the new row; rows deleted before stay unless their tail returned."""
    kept = F.col("change").isNull() | F.col("change").isin("quiet", "dropped")
    columns = [F.when(kept, F.col(f"old.{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in MAPPING_COLUMNS]
    gone = F.when(F.col("change") == "dropped", F.lit(deleted_at).cast("long")).when(F.col("change").isNull(), F.col("old.deleted_at"))
    return matched.select(*columns, gone.alias("deleted_at"))


def change_records(changed: DataFrame, log: DataFrame, deleted_at: int, version: int, as_of: str, recorded_at: str, rerun: bool) -> DataFrame:
    """The records of a publication for the change feed (``changefeed.CHANGE``).

    ``changed``: the rows of ``match`` that are neither null nor quiet. Mappings carry their images before and after,
    without the derived columns, the log and the run their image after. A tail that was there before, deleted or
    not, is an update.
    """
    captured = [c for c in MAPPING_COLUMNS if c not in DERIVED]
    dropped = F.col("change") == "dropped"
    text = lambda *columns: F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    gone = F.when(dropped, F.lit(deleted_at).cast("long")).alias("deleted_at")
    after = text(*[F.when(dropped, F.col(f"old.{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in captured], gone)
    before = F.when(F.col("old").isNotNull(), text(*[F.col(f"old.{c}").alias(c) for c in [*captured, "deleted_at"]]))
    nothing = F.lit(None).cast("string")

    def records(df: DataFrame, table: str, op, key, before, after) -> DataFrame:
        return df.select(
            F.lit(version).cast("long").alias("version"), F.lit(table).alias("table"), op.alias("op"), key.alias("key"), F.lit(as_of).alias("as_of_date"),
            before.alias("before"), after.alias("after"),
        )

    run = changed.sparkSession.createDataFrame([(as_of, recorded_at)], RUN)
    return (
        records(changed, "mappings_current", F.when(F.col("old").isNull(), "I").otherwise("U"), F.col("n_number"), before, after)
        .unionByName(records(log, "changelog", F.lit("I"), F.col("n_number"), nothing, text(*log.columns)))
        .unionByName(records(run, "refresh_run", F.lit("U" if rerun else "I"), F.col("as_of_date"), nothing, text(*run.columns)))
    )


def run_log(runs: DataFrame) -> DataFrame:
    """One row per day of (as_of_date, recorded_at, version); the last version wins."""
    return runs.groupBy("as_of_date").agg(F.max_by("recorded_at", "version").alias("recorded_at"))


def current_mappings(current: DataFrame) -> DataFrame:
    return current.filter("deleted_at is null").drop("deleted_at").orderBy("n_number")


def lookup(current: DataFrame, n_number: str) -> DataFrame:
    """The live row of one tail, however its number is written."""
    wanted = canonical_n_number(F.lit(n_number))
    return current.filter("deleted_at is null").filter(F.col("n_number") == wanted)


def changelog_for(log: DataFrame, as_of: str) -> DataFrame:
    return log.filter(F.col("as_of_date") == as_of).orderBy("n_number")


def flight_departments(current: DataFrame) -> DataFrame:
    """The consumer's slice: small fleets of issuers outside aviation."""
    return current.filter("deleted_at is null and not aviation_issuer and fleet_size between 1 and 6")


class FeedBusy(RuntimeError):
    """Another run holds the feed."""


class Feed:
    """A versioned folder of the feed's tables, readable wherever Spark reads.

    mappings_current lies in hash buckets; a day writes the buckets with changed tails only, and a list of the files of
    all. The changelog and the run log are appended: a version holds its own lines, and all published versions
    together are the table. review_queue and unresolved_trusts are written anew.
    """

    TABLES = {
        "mappings_current": CURRENT,
        "review_queue": ", ".join(f"{c} string" for c in REVIEW_COLUMNS),
        "unresolved_trusts": ", ".join(f"{c} string" for c in TRUST_COLUMNS),
        "changelog": CHANGELOG,
        "refresh_run": RUN,
    }
    APPENDED = {"changelog": CHANGELOG, "refresh_run": f"{RUN}, version long"}

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self._mine = False

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _markers(self) -> list[str]:
        fs, folder = self._path("published")
        return sorted(f.getPath().getName() for f in fs.listStatus(folder)) if fs.exists(folder) else []

    def versions(self) -> list[str]:
        """The published versions, oldest first."""
        return [m.split(".", 1)[1] for m in self._markers()]

    def version(self) -> str | None:
        return (self.versions() or [None])[-1]

    @contextmanager
    def locked(self):
        """Hold the feed against other runs; within it, the holder's own steps pass."""
        if self._mine:
            yield
            return
        fs, lock = self._path("LOCK")
        if not fs.createNewFile(lock):
            raise FeedBusy(f"{lock} exists: another run publishes, or one died; then call unlock()")
        self._mine = True
        try:
            self._settle_snapshots()
            yield
        finally:
            self._mine = False
            fs.delete(lock, False)

    def unlock(self) -> None:
        """Remove the lock that a dead run has left."""
        fs, lock = self._path("LOCK")
        fs.delete(lock, False)

    def table(self, name: str) -> DataFrame:
        versions = self.versions()
        if not versions:
            return self.spark.createDataFrame([], self.TABLES[name])
        if name == "mappings_current":
            return self._current(self.files())
        if name not in self.APPENDED:
            return self.spark.read.schema(self.TABLES[name]).parquet(f"{self.root}/{versions[-1]}/{name}")
        rows = self.spark.read.schema(self.APPENDED[name]).parquet(*[f"{self.root}/{v}/{name}" for v in versions])
        return run_log(rows) if name == "refresh_run" else rows

    def files(self, version: str | None = None) -> list[tuple[int, str, str]]:
        """(bucket, folder, file) of the current table's files in a version, the last one unless it is named."""
        version = version or self.version()
        if version is None:
            return []
        rows = self.spark.read.schema(buckets.FILES).parquet(f"{self.root}/{version}/files")
        return sorted(tuple(r) for r in rows.collect())  # one row a bucket

    def _current(self, files: list[tuple[int, str, str]]) -> DataFrame:
        return buckets.read_buckets(self.spark, files, "n_number", self.buckets, self.root, CURRENT)

    def apply(
        self,
        as_of: str,
        recorded_at: str,
        deleted_at: int,
        published: DataFrame,
        review: DataFrame,
        unresolved: DataFrame,
        *,
        aircraft: int,
        subsidiaries: int,
        gold: dict,
        conflicts: DataFrame | None = None,
        offline: bool = False,
        skip_subsidiaries: bool = False,
    ) -> None:
        """Apply a day's result to all tables at once. Bad dates and refused gates stop before anything is published.

        ``aircraft`` and ``subsidiaries`` count the rows of the inputs, ``gold`` is the gold evaluation's row. With
        ``conflicts`` the day's snapshot is published as well.
        """
        check_dates(self.spark, as_of, recorded_at)
        with self.locked():
            gates.check_master_floor(aircraft, offline)
            gates.check_subsidiaries(subsidiaries, skip_subsidiaries)
            gates.check_gold(gold)
            previous = self.table("mappings_current").filter("deleted_at is null").count()
            gates.check_published_floor(previous, published.select("n_number").distinct().count())
            self.publish(as_of, recorded_at, deleted_at, published, review, unresolved, conflicts)

    def publish(
        self, as_of: str, recorded_at: str, deleted_at: int, published: DataFrame, review: DataFrame, unresolved: DataFrame, conflicts: DataFrame | None = None
    ) -> None:
        """Write the next version and name it, without gates."""
        spark = self.spark
        with self.locked():
            markers, version = self._markers(), f"v-{uuid.uuid4().hex}"
            number, folder = (int(markers[-1].split(".", 1)[0]) + 1 if markers else 1), f"{self.root}/{version}"
            old_files = self.files()
            # The new rows lie in the same buckets as the current ones, so they meet without a shuffle.
            incoming = buckets.write_buckets(last_per_tail(published), "n_number", self.buckets, self.root, f"{version}/incoming")
            schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spark.createDataFrame([], CURRENT).schema if f.name != "deleted_at")

            def met(only: set[int] | None = None) -> DataFrame:
                inside = [[f for f in files if only is None or f[0] in only] for files in (old_files, incoming)]
                return match(self._current(inside[0]), buckets.read_buckets(spark, inside[1], "n_number", self.buckets, self.root, schema))

            met().filter("change <> 'quiet'").write.parquet(f"{folder}/changed")
            changed = spark.read.parquet(f"{folder}/changed")
            bucket = buckets.bucket_of("n_number", self.buckets)
            touched = {r[0] for r in changed.select(bucket).distinct().collect()}  # at most one row a bucket
            new_files = buckets.write_buckets(next_current(met(touched), deleted_at), "n_number", self.buckets, self.root, f"{version}/mappings_current") if touched else []
            files = buckets.replaced(old_files, new_files, touched)
            spark.createDataFrame(files, buckets.FILES).coalesce(1).write.parquet(f"{folder}/files")
            log = changelog(changed, as_of)
            rerun = self.table("refresh_run").filter(F.col("as_of_date") == as_of).limit(1).count() > 0
            review.groupBy("n_number").agg(F.max(F.struct(*REVIEW_COLUMNS)).alias("r")).select("r.*").write.parquet(f"{folder}/review_queue")
            unresolved.filter("reason = 'trustee'").select(*TRUST_COLUMNS).write.parquet(f"{folder}/unresolved_trusts")
            change_records(changed, log, deleted_at, number, as_of, recorded_at, rerun).coalesce(1 + len(touched)).write.parquet(f"{folder}/changes")
            log.write.parquet(f"{folder}/changelog")
            run = spark.createDataFrame([(as_of, recorded_at, number)], self.APPENDED["refresh_run"])
            run.coalesce(1).write.parquet(f"{folder}/refresh_run")
            if conflicts is not None:
                self._write_snapshot(as_of, version, files, conflicts)
            fs, marker = self._path(f"published/{number:010d}.{version}")
            if not fs.createNewFile(marker):
                raise FeedBusy(f"{marker} exists")
            self._settle_snapshots()

    def _write_snapshot(self, as_of: str, version: str, files: list[tuple[int, str, str]], conflicts: DataFrame) -> None:
        """Dated copies for consumers, JSON files and the current table; they wait until their version is published."""
        folder = f"{self.root}/snapshots/.{version}.{as_of}"
        log = self.spark.read.schema(CHANGELOG).parquet(*[f"{self.root}/{v}/changelog" for v in (*self.versions(), version)])
        changelog_for(log, as_of).write.json(f"{folder}/changelog")
        conflicts.orderBy("n_number").write.json(f"{folder}/conflicts")
        self.spark.read.schema(self.TABLES["unresolved_trusts"]).parquet(f"{self.root}/{version}/unresolved_trusts").orderBy("n_number").write.json(f"{folder}/unresolved_trusts")
        self._current(files).orderBy("n_number").write.parquet(f"{folder}/mappings_current")

    def _settle_snapshots(self) -> None:
        """Give each waiting snapshot of a published version its day's name, and remove those of versions that failed."""
        fs, folder = self._path("snapshots")
        if not fs.exists(folder):
            return
        published = set(self.versions())
        for name in sorted(f.getPath().getName() for f in fs.listStatus(folder)):
            if name.startswith("."):
                version, as_of = name[1:].split(".", 1)
                (_, waiting), (_, final) = self._path(f"snapshots/{name}"), self._path(f"snapshots/as_of={as_of}")
                if version in published:
                    fs.delete(final, True)
                    fs.rename(waiting, final)
                else:
                    fs.delete(waiting, True)

    def vacuum(self, keep: int = 7) -> int:
        """Remove what no reader of the last ``keep`` versions needs: bucket files that these do not name, the drafts of
        publications, and folders of runs that died. The changelog, the run log and the change feed stay. Returns the number of
        removed files and folders."""
        with self.locked():
            fs, root = self._path("")
            versions = self.versions()
            needed = {(folder, file) for v in versions[-keep:] for _, folder, file in self.files(v)}
            gone = []
            for version in sorted(f.getPath().getName() for f in fs.listStatus(root)):
                if not version.startswith("v-"):
                    continue
                if version not in versions:
                    gone.append(version)
                    continue
                gone += [f"{version}/{draft}" for draft in ("incoming", "changed") if fs.exists(self._path(f"{version}/{draft}")[1])]
                folder = f"{version}/mappings_current"
                if fs.exists(self._path(folder)[1]):
                    found = [f.getPath().getName() for f in fs.listStatus(self._path(folder)[1])]
                    gone += [f"{folder}/{name}" for name in found if name.startswith("part-") and (folder, name) not in needed]
            for name in gone:
                fs.delete(self._path(name)[1], True)
            return len(gone)

    def export_csv(self, df: DataFrame, name: str) -> None:
        """A table as CSV files with a header, in the order of its tails."""
        df.orderBy("n_number").write.mode("overwrite").csv(f"{self.root}/exports/{name}", header=True)


def check_dates(spark: SparkSession, as_of: str, recorded_at: str) -> None:
    probe = spark.range(1).select(is_calendar_day(F.lit(as_of)).alias("d"), is_utc_instant(F.lit(recorded_at)).alias("i")).first()
    if not probe["d"] or not probe["i"]:
        raise ValueError(f"not a UTC day and instant: {as_of}, {recorded_at}")
