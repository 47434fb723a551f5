"""Gold and rubric evaluation of a feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import canonical_n_number, normalize_name


def expected_names(companies: DataFrame) -> DataFrame:
    """norm, expected ticker: registrant names and, where given, the company name; the last entry wins."""
    names = companies.select(
        F.upper("ticker").alias("expected"), "ord", F.posexplode(F.concat("registrant_names", F.filter(F.array("company_name"), lambda x: x != ""))).alias("k", "name")
    )
    return (
        names.groupBy(normalize_name(F.col("name")).alias("norm"))
        .agg(F.max_by("expected", F.struct("ord", "k")).alias("expected"))
    )


def name_hits(companies: DataFrame, published: DataFrame, aircraft: DataFrame) -> DataFrame:
    """Aircraft whose registrant is a gold name: n_number, expected, and the published ticker or null."""
    keyed = aircraft.select("n_number", normalize_name(F.col("registrant_name")).alias("norm"))
    return keyed.join(expected_names(companies), "norm").join(published.select("n_number", F.col("ticker").alias("got")), "n_number", "left")


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def _share(top: Column, bottom: Column, default: float) -> Column:
    return F.when(bottom == 0, F.lit(default)).otherwise(top / bottom)


def evaluate_gold(gold: dict[str, DataFrame], published: DataFrame, aircraft: DataFrame, unresolved_trusts: DataFrame) -> DataFrame:
    """One row: counters of names, tails and forbidden tails, precision and recalls."""
    got = published.select("n_number", F.col("ticker").alias("got"))
    master = aircraft.select("n_number").distinct().withColumn("in_master", F.lit(True))
    names = name_hits(gold["companies"], published, aircraft).agg(
        F.count("*").alias("faa_gold_name_hits"),
        _count(F.col("got") == F.col("expected")).alias("name_true_positives"),
        _count(F.col("got") != F.col("expected")).alias("name_false_positives"),
    )
    tails = gold["tails"].withColumn("n_number", canonical_n_number(F.col("n_number"))).join(master, "n_number", "left").join(got, "n_number", "left")
    hit = F.coalesce(F.col("got") == F.upper("ticker"), F.lit(False))
    tails = tails.agg(
        _count(F.col("in_master") & hit).alias("tail_true_positives"),
        _count(F.col("in_master") & ~hit).alias("tail_false_negatives"),
        _count(F.col("in_master").isNull()).alias("tail_skipped_missing_master"),
    )
    barred = gold["unpublished_tails"].withColumn("n_number", canonical_n_number(F.col("n_number"))).join(master, "n_number", "left").join(got, "n_number", "left")
    barred = barred.agg(
        _count(F.col("in_master") & (F.col("got") == F.upper("must_not_ticker"))).alias("tail_false_positives"),
        _count(F.col("in_master")).alias("unpublished_in_master"),
        _count(F.col("in_master").isNull()).alias("unpublished_skipped_missing_master"),
    )
    sizes = [
        gold["companies"].agg(F.count("*").alias("gold_companies")),
        gold["tails"].agg(F.count("*").alias("gold_tails")),
        gold["unpublished_tails"].agg(F.count("*").alias("gold_unpublished_tails")),
        published.agg(F.count("*").alias("published_rows")),
        unresolved_trusts.agg(F.count("*").alias("unresolved_trusts")),
    ]
    row = names
    for part in (tails, barred, *sizes):
        row = row.crossJoin(F.broadcast(part))  # single rows
    tp, fp = F.col("name_true_positives"), F.col("name_false_positives")
    tail_tp, tail_fn = F.col("tail_true_positives"), F.col("tail_false_negatives")
    return row.withColumns(
        {
            "precision_name": _share(tp, tp + fp, 1.0),
            "recall_name": _share(tp, F.col("faa_gold_name_hits"), 0.0),
            "recall_tails": _share(tail_tp, tail_tp + tail_fn, 1.0),
        }
    )


def evaluate_rubric(rubric: DataFrame, published: DataFrame, aircraft: DataFrame) -> DataFrame:
    """Holdout counters per stratum in first-seen order; null recall and precision where nothing is scored."""
    got = published.select("n_number", F.col("ticker").alias("got"))
    master = aircraft.select("n_number").distinct().withColumn("in_master", F.lit(True))
    rows = (
        rubric.filter("split = 'holdout' and stratum <> 'not_our_join'")
        .join(master, "n_number", "left")
        .join(got, "n_number", "left")
        .withColumn("in_master", F.coalesce("in_master", F.lit(False)))
    )
    positive = F.col("in_master") & (F.col("ticker") != "")
    negative = F.col("in_master") & (F.col("ticker") == "") & (F.col("must_not_ticker") != "")
    hit = F.coalesce(F.col("got") == F.col("ticker"), F.lit(False))
    tp, fn, fp = F.col("true_positives"), F.col("false_negatives"), F.col("false_positives")
    return (
        rows.groupBy("stratum")
        .agg(
            F.min("ord").alias("ord"),
            F.count("*").alias("n"),
            _count(~F.col("in_master")).alias("skipped_missing_master"),
            _count(positive & hit).alias("true_positives"),
            _count(positive & ~hit).alias("false_negatives"),
            _count(negative & (F.col("got") == F.col("must_not_ticker"))).alias("false_positives"),
        )
        .withColumn("recall", F.try_divide(tp, tp + fn))
        .withColumn("precision", F.try_divide(tp, tp + fp))
        .orderBy("ord")
        .drop("ord")
    )


def coverage(current: DataFrame) -> DataFrame:
    """Live rows and distinct tickers: overall, by method, and by aviation flag."""
    live = current.filter("deleted_at is null")
    sets = live.select(
        "ticker",
        F.explode(
            F.array(
                F.struct(F.lit("all").alias("kind"), F.lit("").alias("value")),
                F.struct(F.lit("method").alias("kind"), F.col("match_method").alias("value")),
                F.struct(F.lit("aviation_issuer").alias("kind"), F.col("aviation_issuer").cast("int").cast("string").alias("value")),
            )
        ).alias("g"),
    )
    return sets.groupBy("g.kind", "g.value").agg(F.count("*").alias("tails"), F.countDistinct("ticker").alias("tickers"))


def latest_run(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("recorded_at"), F.desc("as_of_date")).limit(1)
