from __future__ import annotations

import random
from collections import Counter

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from panelwright.llm import dedup
from panelwright.llm.registry import QUERIES


@pytest.fixture(scope="module")
def folder(spark, documents, tmp_path_factory):
    """Tables with planted toxic documents, copies, near copies and texts without letters."""
    rng = random.Random(12)
    calm = [f"{a}{b}" for a in "ba re to li mu sha ten dor".split() for b in "ran ti lo mes".split()]
    sentence = lambda n: " ".join(rng.choice(calm) for _ in range(n))
    rows, labels = [], []
    for i in range(400):
        toxic = i % 8 == 0
        text = sentence(rng.randint(20, 80)) + (" scumbag " + sentence(3) if toxic else "")
        rows.append((i, text, "en" if i % 3 else "de", rng.choice(["a", "a", "a", "b", None])))
        labels.append((i, 1, int(toxic)))
    base = sentence(120)
    rows += [(1000 + i, base, "en", "b") for i in range(30)]
    rows += [(2000 + i, base.replace(base.split()[i], "other", 1), "en", "b") for i in range(10)]
    rows += [(3000, None, "en", "a"), (3001, "", None, "a"), (3002, "12 34", "en", "a"), (None, sentence(30), "en", "b"), (3003, "x " * 60_000, "en", "c"),
             (7, rows[7][1], "en", "a")]
    path = str(tmp_path_factory.mktemp("tables"))
    documents(rows, ["1 AS score", "'x' AS component_id"]).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, ids = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder).cache()
        ids[name] = Counter(r["doc_id"] for r in docs.select("doc_id").collect())
        if name != "bpe":
            assert docs.columns == columns
    toxic = {i for i in range(400) if i % 8 == 0}
    assert not toxic & ids["toxicity"].keys() and len(ids["toxicity"]) >= 350 + 40
    assert ids["toxicity"].keys() - ids["language"].keys() == {3000, 3001, 3002}
    left = ids["near_duplicates"]
    assert set(left) == (ids["language"].keys() - {i for i in ids["language"] if i and i >= 1001 and i < 3000})
    assert left[7] == 1 and left[None] == 1 and left[1000] == 1
    assert max(n for i, n in ids["mixing"].items()) <= 3 and ids["mixing"].keys() <= left.keys()
    assert ids["bpe"] == ids["mixing"]
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_run_and_registry(spark, folder):
    found = corpus_pipeline.run(spark, folder)
    again = corpus_pipeline.run(spark, folder)
    assert found.count() > 300 and found.exceptAll(again).isEmpty()
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and len(QUERIES) == 13
    with_sql = {"op2_mixing", "op4_top_k", "op6_near_duplicates", "op7_warc", "op11_line_rules", "op12_variants", "op13_filter_audit"}
    assert with_sql <= set(oracle_sql())


def test_empty_tables(spark, documents, tmp_path):
    documents([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    assert dedup.one_of_each(documents([])).collect() == []


@pytest.mark.parametrize("labels", [[], [(i, 1, 1) for i in range(40)], [(i, 1, i % 2) for i in range(40)]])
def test_documents_stay_where_nothing_can_be_learned(spark, documents, tmp_path, labels):
    rows = [(i, f"plain words {'ab cd ef gh'[i % 3:]} of number {i}", None, "a") for i in range(40)] + [(100, "12 34", None, "a"), (101, None, None, "a")]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.clean_of_toxicity(spark, documents(rows), str(tmp_path))
    assert kept.count() == 42
    assert {r["doc_id"] for r in corpus_pipeline.in_a_language(spark, kept, str(tmp_path)).collect()} == set(range(40))
