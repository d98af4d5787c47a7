import corpus_pipeline
from phenolens.llm import queries

from conftest import SF
from test_near_dedup import brute
from test_packing import check


def test_stages_against_brute_force(spark):
    d = SF["0.001"]
    docs = queries.documents(spark, d)
    columns, kept = docs.columns, {"documents": {r["doc_id"]: r["text"] for r in docs.collect()}}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.shared_table(stage(spark, docs, d), name)
        assert docs.columns == columns
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    scores = {r["doc_id"]: r["predicted"] for r in queries.QUERIES["op8_quality_classifier"](spark, d).collect()}
    assert set(kept["quality"]) == {i for i, p in scores.items() if p}
    last = {}
    for i, t in kept["quality"].items():
        last[t or ""] = max(i, last.get(t or "", i))
    assert set(kept["exact"]) == set(last.values())
    assert set(kept["near"]) == {i for i, _, c in brute(list(kept["exact"].items())) if i == c}
    dirty = {r["doc_id"] for r in queries.QUERIES["op9_decontamination"](spark, d).filter("contaminated").collect()}
    assert set(kept["decontaminate"]) == set(kept["near"]) - dirty
    rows = corpus_pipeline.run(spark, d).collect()
    check(rows, kept["decontaminate"])
    assert {r["doc_id"] for r in rows} == set(kept["decontaminate"])


def test_empty_documents(spark):
    d = SF["0.001"]
    docs = queries.documents(spark, d).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.shared_table(stage(spark, docs, d), name)
        assert docs.count() == 0


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "decontaminate", "pack"]
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
