"""Toxicity: cumulative-link (proportional odds) ordinal regression on sparse text features.

Features of a document are its distinct words and their prefixes of 4, 5 and 6 bytes, each a 64-bit
hash, so that inflected forms of a known stem count and features do not collide. Severity grades: 0 for
documents labelled clean; labelled toxic ones are 1, or 2 if they hold at least as many distinct
indicative features as the median toxic document. The labels have one toxic flag, so the upper grade is derived and
its threshold says how many signs a text has, not what people thought of it; taking the quality flag for it was
tried and halved what is found, because that flag is independent of toxicity. All thresholds share one weight
vector; the output is the expected severity.

Fitting uses a bounded sample of labelled rows (``SAMPLE`` documents, those smallest by a seeded digest
of their id) and screens features by the likelihood ratio of their document counts in it. The model has a weight
for every feature that passes, at most one for each feature of the sample; every document is scored whole, in
place, without a shuffle. A document's score depends on its own features only.

Defined results: null and blank texts have no features and get the clean side's score; texts of any length are
scored whole; rows that repeat an id or a text are scored one by one and alike. Labels with null doc_id or flag
are ignored; repeated labels of an id count once, the higher flag wins. Without any toxic label the model is empty and nothing is toxic. An empty table has no result. Scores
read doc_id and text alone; ``drop_toxic`` keeps all columns, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .wordhash import _VALUES, ALNUM, _power_tables, chunks, distinct, mix64, words

SAMPLE = 8_000
#: Features that are expected to pass the screen by chance.
BY_CHANCE = 3.0
PREFIXES = (4, 5, 6)
GRADES = 3
#: Features that a task holds before it passes on their partial counts.
HELD_FEATURES = 1 << 20
TOXIC_AT = 0.5  # probability of grade 1 or more


def features(column: pa.Array):
    """Yield (first row, sorted distinct feature hashes, offsets) over runs of rows."""
    for row, data, offsets in chunks(column):
        whole, starts, ends, bounds = words(data, offsets, ALNUM)
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
        powers, inverse = _power_tables(len(data))
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_VALUES[data] * powers[: len(data)], out=sums[1:])
        parts, docs = [whole], [doc]
        for k in PREFIXES:
            long = ends - starts > k
            cut = starts[long]
            parts.append(mix64((sums[cut + k] - sums[cut]) * inverse[cut] + np.uint64(k)))
            docs.append(doc[long])
        hashes, at = distinct(np.concatenate(parts), np.concatenate(docs), len(offsets) - 1)
        yield row, hashes, at


def labelled_sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """toxic, text of at most ``size`` labelled documents, chosen by a seeded digest of the id."""
    flags = labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    flagged = flags.agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = materialize(flagged.orderBy(F.md5(F.concat(F.lit("t:"), F.col("doc_id").cast("string"))), "doc_id").limit(size))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    # Copies in the sample would count one text's words many times.
    return materialize(found.groupBy(F.xxhash64("text").alias("k"), "toxic").agg(F.first("text").alias("text")).select("toxic", "text"))


def screen(sample: DataFrame, by_chance: float = BY_CHANCE) -> np.ndarray:
    """Hashes of features that stand in toxic documents significantly more often than in clean ones."""

    def counted(hashes, toxic):
        found, where = np.unique(np.concatenate(hashes), return_inverse=True)
        n, t = np.bincount(where), np.bincount(where, weights=np.concatenate(toxic)).astype(np.int64)
        for k in range(0, len(n), 100_000):
            part = slice(k, k + 100_000)
            columns = [pa.array(found[part].view(np.int64)), pa.array(n[part].astype(np.int64)), pa.array(t[part])]
            yield pa.RecordBatch.from_arrays(columns, names=["f", "n", "t"])

    def count(batches):
        hashes, toxic, held = [], [], 0
        for batch in batches:
            flag = (batch.column(0).to_numpy(zero_copy_only=False) > 0).astype(np.int8)
            for row, found, at in features(batch.column(1)):
                hashes.append(found)
                toxic.append(np.repeat(flag[row : row + len(at) - 1], np.diff(at)))
                held += len(found)
                if held >= HELD_FEATURES:
                    yield from counted(hashes, toxic)
                    hashes, toxic, held = [], [], 0
        if hashes:
            yield from counted(hashes, toxic)

    totals = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum((F.col("toxic") > 0).cast("int")), F.lit(0)).alias("t")).first()
    n_toxic, n_clean = totals["t"], totals["n"] - totals["t"]
    if not n_toxic or not n_clean:
        return np.zeros(0, np.uint64)
    counts = sample.mapInArrow(count, "f long, n long, t long").groupBy("f").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    counts = materialize(counts)
    share = n_toxic / (n_toxic + n_clean)
    testable, least = _bar(counts, share, by_chance)
    clean = F.col("n") - F.col("t")
    # Log-likelihood ratio of the toxic share among the feature's documents against the sample's.
    ratio = F.col("t") * F.log(F.col("t") / F.col("n") / share)
    ratio += F.when(clean > 0, clean * F.log(clean / F.col("n") / (1 - share))).otherwise(0.0)
    indicative = counts.filter((F.col("n") >= testable) & (F.col("t") > F.col("n") * share)).withColumn("ratio", ratio).filter(F.col("ratio") >= float(least))
    return np.sort(np.array([r["f"] for r in indicative.select("f").collect()], dtype=np.int64).view(np.uint64))


def _bar(counts: DataFrame, share: float, by_chance: float, most: int = 64) -> tuple[int, float]:
    """(documents, ratio) that a feature needs to pass the screen.

    exp(-ratio) bounds the chance of a feature's count, so with a bar of log(tested / by_chance) about ``by_chance`` of the
    tested features pass by chance. A feature of n documents, all of them toxic, has the ratio -n log(share) and no feature of n
    documents has more; so those of which n is too small for the bar need no test, and do not raise it.
    """
    by_n = dict(map(tuple, counts.groupBy(F.least("n", F.lit(most)).cast("int")).count().collect()))  # at most ``most`` rows
    for n in range(1, most + 1):
        bar = float(np.log(max(1, sum(c for k, c in by_n.items() if k >= n)) / by_chance))
        if -n * np.log(share) >= bar:
            return n, bar
    return most, bar


@dataclass
class Model:
    """Known features (sorted hashes), their shared weights, and the increasing thresholds."""

    known: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Sum of the weights of each document's features."""
        value = np.zeros(len(hashes))
        if len(self.known):
            k = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
            value = np.where(self.known[k] == hashes, self.weights[k], 0.0)
        return np.bincount(np.repeat(np.arange(len(at) - 1), np.diff(at)), weights=value, minlength=len(at) - 1)

    def exceedance(self, score: np.ndarray) -> np.ndarray:
        """(documents, thresholds) probabilities of lying above each threshold."""
        return 1.0 / (1.0 + np.exp(-(score[:, None] - self.thresholds[None, :])))


def fit_ordinal(rows: np.ndarray, columns: np.ndarray, grade: np.ndarray, n_features: int, ridge: float = 0.02, steps: int = 400, rate: float = 0.1):
    """Maximum likelihood of the proportional-odds model with a ridge on the weights.

    rows, columns: places of the ones in the sparse 0/1 design. Thresholds stay in order because the gaps
    between them are exponentials. Gradient ascent with per-coordinate step sizes (Adam).
    """
    n, k = len(grade), GRADES - 1
    share = np.array([np.mean(grade > g) for g in range(k)]).clip(1e-3, 1 - 1e-3)
    first = np.log((1 - share) / share)
    theta = np.concatenate([np.zeros(n_features), [first[0]], np.log(np.maximum(np.diff(first), 0.05))])
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    at = np.arange(n)
    for step in range(1, steps + 1):
        w, cuts = theta[:n_features], np.cumsum(np.concatenate([[theta[n_features]], np.exp(theta[n_features + 1 :])]))
        s = np.bincount(rows, weights=w[columns], minlength=n)
        below = 1.0 / (1.0 + np.exp(np.clip(s[:, None] - cuts[None, :], -40, 40)))  # P(grade <= g)
        ladder = np.concatenate([np.zeros((n, 1)), below, np.ones((n, 1))], axis=1)
        slope = ladder * (1 - ladder)
        p = np.maximum(ladder[at, grade + 1] - ladder[at, grade], 1e-12)
        d_score = -(slope[at, grade + 1] - slope[at, grade]) / p
        d_cut = np.zeros((n, k + 2))
        d_cut[at, grade + 1] += slope[at, grade + 1] / p
        d_cut[at, grade] -= slope[at, grade] / p
        d_cut = d_cut[:, 1 : k + 1].sum(axis=0)
        tail = np.cumsum(d_cut[::-1])[::-1]
        gradient = np.concatenate(
            [np.bincount(columns, weights=d_score[rows], minlength=n_features) / n - ridge * w / n, [tail[0] / n], tail[1:] * np.exp(theta[n_features + 1 :]) / n]
        )
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        theta = theta + rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    return theta[:n_features], np.cumsum(np.concatenate([[theta[n_features]], np.exp(theta[n_features + 1 :])]))


def train(docs: DataFrame, labels: DataFrame, size: int = SAMPLE, by_chance: float = BY_CHANCE) -> Model:
    """Fit on the bounded sample; only the places of screened features reach the driver."""
    sample = labelled_sample(docs, labels, size)
    known = screen(sample, by_chance)
    if not len(known):
        return Model(known, np.zeros(0), np.array([50.0, 51.0]))

    def design(batches):
        for batch in batches:
            for row, hashes, at in features(batch.column(1)):
                k = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[k] == hashes
                bounds = np.concatenate([[0], np.cumsum(hit)])[at]
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(k[hit].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(at) - 1), lists], names=["toxic", "places"])

    found = sample.mapInArrow(design, "toxic int, places array<int>").collect()  # at most ``size`` short rows
    found.sort(key=lambda r: (r["toxic"], r["places"]))
    toxic = np.array([r["toxic"] for r in found])
    lengths = np.array([len(r["places"]) for r in found])
    rows = np.repeat(np.arange(len(found)), lengths)
    columns = np.concatenate([np.array(r["places"], dtype=np.int64) for r in found]) if len(found) else np.zeros(0, np.int64)
    strong = np.median(lengths[(toxic > 0) & (lengths > 0)]) if ((toxic > 0) & (lengths > 0)).any() else 1
    grade = np.where(toxic > 0, 1 + ((lengths >= strong) & (lengths > 0)), 0)
    return Model(known, *fit_ordinal(rows, columns, grade, len(known)))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, severity (expected grade), p_toxic, toxic for each row; the model is a bounded broadcast."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        for batch in batches:
            for row, hashes, at in features(batch.column(1)):
                above = m.exceedance(m.score(hashes, at))
                n = len(at) - 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, n), pa.array(above.sum(axis=1)), pa.array(above[:, 0]), pa.array(above[:, 0] >= TOXIC_AT)],
                    names=["doc_id", "severity", "p_toxic", "toxic"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, severity double, p_toxic double, toxic boolean"
    )


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not toxic, with all their columns, judged in place row by row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at_text = docs.columns.index("text")

    def run(batches):
        m = sent.value
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            for row, hashes, at in features(batch.column(at_text)):
                keep[row : row + len(at) - 1] = m.exceedance(m.score(hashes, at))[:, 0] < TOXIC_AT
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
