"""Each stage of the pipeline on its own input, against brute force."""

from collections import Counter

import corpus_pipeline as pipeline
from hangarlight.llm import mixing

from . import brute

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    columns, before, states = docs.columns, {r.doc_id: r for r in docs.collect()}, {}
    for name, stage in pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        rows = docs.collect()
        now = {r.doc_id: r for r in rows}
        assert len(now) == len(rows) and set(now) <= set(before)
        if name != "sharding":
            assert docs.columns == columns and all(now[i] == before[i] for i in now)
        states[name] = (before, now)
        before = now
    before, now = states["toxicity"]
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    clean, toxic = [i for i in before if truth.get(i) == 0], [i for i in before if truth.get(i)]
    assert sum(i in now for i in clean) >= 0.98 * len(clean) and sum(i in now for i in toxic) <= 0.4 * len(toxic)
    before, now = states["near_duplicates"]
    assert set(now) == {c for _, c in brute.near_duplicates([(i, r.text) for i, r in before.items()]).values()}
    before, now = states["decontamination"]
    assert set(now) == {i for i, r in before.items() if not brute.contamination(r.text, items)[1]}
    before, now = states["mixing"]
    tokens = [len((r.text or "").split()) for r in before.values()]
    kept = sum(len((r.text or "").split()) for r in now.values())
    leaves = {(r.lang, r.source) for r in before.values()}
    assert abs(kept - pipeline.MIX_FRACTION * sum(tokens)) <= len(leaves) * max(tokens) and mixing.LEAF
    before, now = states["sharding"]
    assert set(before) == set(now)
    for k in {r.shard for r in now.values()}:
        slots = sorted(r.slot for r in now.values() if r.shard == k)
        assert slots == list(range(len(slots)))


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls in any column, empty and very long texts, repeated rows, clashing and extra columns, then an empty table."""
    tie = "one two three four five six seven eight nine ten eleven"
    rows = [(None, None), (None, tie), (1, None), (2, ""), (3, " \t"), (4, "two words"), (5, tie), (5, tie), (6, tie + " x"), (7, "long " * 200_000)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, shard int, slot string, keep int, _doc string, toxic int, digest string"
    docs = spark.createDataFrame([(i, t, None if k % 3 else "en", None if k % 2 else "src0", None, k, "s", k, "d", 1, "g") for k, (i, t) in enumerate(rows)], schema)
    columns = docs.columns
    for limit, n_docs in ((None, {None: 2, 1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 7: 1}), (0, {})):
        now = docs if limit is None else docs.limit(0)
        for name, stage in pipeline.STAGES:
            folder = str(tmp_path / f"{name}{limit}")
            stage(spark, now, FOLDER).write.parquet(folder)
            now = spark.read.parquet(folder)
            if name != "sharding":
                assert now.columns == columns
            if name == "decontamination":
                assert Counter(r.doc_id for r in now.collect()) == Counter(n_docs)
        assert set(Counter(r.doc_id for r in now.collect())) <= set(n_docs) and now.filter("shard is null or slot is null").count() == 0
