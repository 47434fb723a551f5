"""The queries opN_<name> over the whole tables, and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, decontaminate, hilbert, linededup, mixing, neardup, periodic, pii, reshard, tokencount, tokenrecords, toxicity, urlfilter
from .common import checkpoint_dir, materialize, table

#: The tokenizer of op2, from the public vocabulary files on the machine.
TOKENIZER = "piece_bpe_32k.model"
#: The tokenizer of op11, and the first one of op13; the id that ends each document of op11.
BYTE_TOKENIZER = "byte_bpe_50k.json"
END_ID = 2


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = str(public_tokenizers.path(TOKENIZER))
    return tokencount.token_counts(table(spark, sf_dir, "documents"), path, tokencount.scratch_cache(spark))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.selection(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.report(table(spark, sf_dir, "pages"))


def op7_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_dir(spark)}/shards_{uuid.uuid4().hex}"
    return reshard.reshard_files(table(spark, sf_dir, "documents"), path).select(*reshard.PLAN)


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.nearest(table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_report(table(spark, sf_dir, "documents"))


def op11_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = f"{checkpoint_dir(spark)}/tokens_{uuid.uuid4().hex}"
    tokenrecords.write_tokens(table(spark, sf_dir, "documents"), path, str(public_tokenizers.path(BYTE_TOKENIZER)), END_ID)
    return tokenrecords.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = periodic.periodic_runs(docs.withColumn("text", periodic.repeat_tail(F.col("text"), F.col("doc_id"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[best[c].alias(c) for c in ("start", "length", "period")],
        F.floor(F.lit(1000) * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = [str(public_tokenizers.path(name)) for name in (BYTE_TOKENIZER, TOKENIZER)]
    aligned = alignment.align(table(spark, sf_dir, "documents"), *paths)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    stored = materialize(aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "a", "b", "n"))
    return alignment.score_links(stored)


QUERIES = {
    f.__name__: f
    for f in (
        op1_near_duplicates,
        op2_token_counts,
        op3_url_filter,
        op4_decontamination,
        op5_mixing,
        op6_line_dedup,
        op7_resharding,
        op8_nearest_neighbours,
        op9_toxicity,
        op10_personal_data,
        op11_token_records,
        op12_periodic_runs,
        op13_tokenizer_alignment,
    )
}

OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
inter AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM inter JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 75 * (nx.n + ny.n - k)),
reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
low AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, low.component_id, d.doc_id = low.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN low ON low.x = d.doc_id
"""

OP4_SQL = r"""
WITH dw AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
iw AS (SELECT item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(ws), 10) AS k, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 10 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 8), lambda i: array_to_string(ws[i:i+9], ' ')) END) AS ph FROM iw),
ks AS (SELECT DISTINCT k FROM p),
pos AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM dw),
cand AS (SELECT doc_id, i, k, array_to_string(ws[i:i+k-1], ' ') AS ph FROM pos, ks WHERE i + k - 1 <= len(ws)),
occ AS (SELECT doc_id, i, p.k, item_id FROM cand JOIN p ON cand.ph = p.ph AND cand.k = p.k),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM occ) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM occ) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""

OP8_SQL = r"""
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""

ORACLES: dict[str, str] = {
    "op1_near_duplicates": OP1_SQL,
    "op4_decontamination": OP4_SQL,
    "op5_mixing": mixing.ORACLE_SQL,
    "op6_line_dedup": linededup.ORACLE_SQL,
}
