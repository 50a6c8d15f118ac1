import pytest

import corpus_pipeline
from gleanery.llm import queries
from test_simhash import slow_fingerprint
from test_seeds import best, words

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, FOLDER), f"test-{name}")
        found.append((name, docs))
    return dict(found)


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_stay(stages):
    names = list(stages)
    for name in names[:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_toxicity(spark, stages):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    before, after = texts(stages["documents"]), texts(stages["toxicity"])
    gone = set(before) - set(after)
    assert all(before[k] == t for k, t in after.items())
    toxic = {k for k, y in labels.items() if y == 1}
    assert len(gone & toxic) >= 0.7 * len(toxic)
    assert not any(labels.get(k) == 0 for k in gone)


def test_near_copies(stages):
    before, after = texts(stages["toxicity"]), texts(stages["near_copies"])
    prints = {k: slow_fingerprint(t) for k, t in before.items()}
    group = {}
    for k in sorted(before):
        near = {group[j] for j in group if (prints[j] ^ prints[k]).bit_count() <= 4}
        group = {j: min(near, default=k) if g in near else g for j, g in group.items()}
        group[k] = min(near, default=k)
    assert after == {k: t for k, t in before.items() if group[k] == k}


def test_shared_passages(stages):
    before, after = texts(stages["near_copies"]), texts(stages["shared_passages"])
    assert set(after) <= set(before)
    counted = {r.doc_id: r.n_chars for r in stages["shared_passages"].collect()}
    for k, t in after.items():
        assert t == before[k] or len(t) < len(before[k]) and counted[k] == len(t)


def test_decontamination(spark, stages):
    items = [words(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    before, after = texts(stages["shared_passages"]), texts(stages["decontamination"])
    assert all(before[k] == t for k, t in after.items())
    for k in set(before) - set(after):
        found = [best(words(before[k]), item) for item in items]
        assert any(equal >= 0.8 * size for equal, size in found)


def test_run_packs_what_is_left(spark, stages):
    packed = corpus_pipeline.run(spark, FOLDER)
    left = texts(stages["decontamination"])
    rows = packed.collect()
    assert {r.doc_id for r in rows} == set(left)
    assert sorted(map(repr, rows)) == sorted(map(repr, stages["packing"].collect()))
    assert packed.columns == queries.op8_packing(spark, FOLDER).columns


def test_every_query_over_a_table_without_rows(spark, tmp_path):
    for name in ("documents", "labels", "benchmark", "embeddings", "pages", "conversations"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").filter("false").write.parquet(f"{tmp_path}/{name}.parquet")
    for name, query in queries.CORPUS_QUERIES.items():
        assert query(spark, str(tmp_path)).count() == 0, name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
