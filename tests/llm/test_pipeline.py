from __future__ import annotations

import corpus_pipeline
from test_dedup import brute_lines
from test_mixing_urls import brute_mix
from test_text_operators import brute_leaks
from test_wide import jaccard_groups

from corpusforge.llm import quality_cnn
from corpusforge.session import table


def test_pipeline_against_brute_force(spark, tables):
    """The whole run against the same stages done one row after the other in plain Python."""
    docs, labels = table(spark, tables, "documents"), table(spark, tables, "labels")
    model = quality_cnn.train(docs, labels)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    scores = model.scores((t or "").encode() for _, t, _ in rows)
    rows = [r for r, s in zip(rows, scores, strict=True) if s >= 0.5]
    cleaned = dict(brute_lines([r[:2] for r in rows]))
    rows = [(i, cleaned[i], s) for i, t, s in rows if cleaned[i] == t or cleaned[i].strip(" \t\n\v\f\r")]
    stay = set(jaccard_groups([r[:2] for r in rows]))
    rows = [r for r in rows if r[0] in stay]
    items = [(r["item_id"], r["text"]) for r in table(spark, tables, "benchmark").collect()]
    leaks = {i for i, _ in brute_leaks([r[:2] for r in rows], items)}
    mixed = [r for r in brute_mix([r for r in rows if r[0] not in leaks]) if r[5] > 0]
    got = corpus_pipeline.run(spark, tables).collect()
    assert sorted(((r["doc_id"], r["source"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in got), key=repr) == mixed


def test_stages_keep_the_columns(spark, tables):
    docs = table(spark, tables, "documents")
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(30), tables)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]


def test_stages_take_empty_tables(spark, tables):
    empty = table(spark, tables, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, tables).count() == 0
