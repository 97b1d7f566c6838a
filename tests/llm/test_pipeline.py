"""The corpus pipeline's stages, one after another, against brute force; the registered queries at the smallest scale."""

from collections import Counter

import pytest
from test_layout import plain_pieces
from test_near_and_exact_repeats import plain_classes, plain_leaks

import corpus_pipeline
from carriageway.llm import queries

DATA = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_decisions(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    schema, names = docs.schema, []
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        out.write.parquet(str(tmp_path / name))
        seen[name] = docs
        docs = spark.read.parquet(str(tmp_path / name))
        names.append(name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.schema.names == schema.names
    rows = {n: [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()] for n, df in seen.items()}
    before = rows["simhash_near_dedup"]
    classes, _ = plain_classes(before)
    assert sorted(i for i, _ in rows["benchmark_decontamination"]) == sorted({c for _, _, c in classes})
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    leaked = {d for d, _ in plain_leaks([r for r in rows["benchmark_decontamination"] if len(r[1]) < 8000], items)}
    after = {i for i, _ in rows["pii"]}
    assert leaked.isdisjoint(after)
    assert {i for i, t in rows["benchmark_decontamination"] if len(t) < 8000} - leaked <= after
    assert len(rows["best_fit_packing"]) == len(rows["pii"])
    got = Counter(tuple(r) for r in docs.select("doc_id", "piece", "start", "length", "ids_crc32").collect())
    assert got == plain_pieces(rows["best_fit_packing"])


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, DATA).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n != "pipeline"])
def test_registered_queries_run(spark, name):
    assert queries.QUERIES[name](spark, DATA).count() > 0
