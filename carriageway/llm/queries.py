"""The registered corpus queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from carriageway.llm import (
    alignment, decontamination, html_text, lexical_search, packing, pii, quality_rules, repeats, sharding, simhash, token_counts, toxicity, warc,
)
from carriageway.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


@query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


@query
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


@query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(table(spark, sf_dir, "documents"))


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(table(spark, sf_dir, "documents"))


@query
def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(table(spark, sf_dir, "documents"))


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op12_ranked_search"] = """
WITH t AS (SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
d AS (SELECT row, doc_id, cast(len(terms) AS bigint) AS n, terms FROM t WHERE len(terms) > 0),
c AS (SELECT count(*) AS docs, cast(sum(n) AS bigint) AS length FROM d),
p AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM d) GROUP BY row, term),
w AS (SELECT term, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double)) AS bigint) AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), c),
i AS (SELECT DISTINCT item, item_id, unnest(terms) AS term FROM (SELECT row_number() OVER () AS item, item_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM benchmark)),
s AS (SELECT item, item_id, d.row, d.doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // length)))) AS bigint) AS score
      FROM i JOIN w USING (term) JOIN p USING (term) JOIN d USING (row), c GROUP BY ALL)
SELECT item_id, cast(rank AS int) AS rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0) WHERE rank <= 10
"""


@query
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counted(table(spark, sf_dir, "documents"))
