"""Stages decide by rows: shared and null ids, repeated rows, clashing columns, empty tables."""

import random
from collections import Counter

import pytest
from test_llm_small import prose

import corpus_pipeline

KIND = "doc_id long, text string, source string, _key long, _copies int, rows long, copies int, class string"


@pytest.fixture
def labels(spark, tmp_path):
    spark.createDataFrame([(i, int(i < 30), 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def table(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, 2, 3, 4, "c") for i, t, s in rows], KIND)


def test_decisions_hold_for_rows(spark, labels):
    rng = random.Random(31)
    good, bad = [prose(rng, 50) for _ in range(60)], [" ".join(w + "!!" for w in prose(rng, 50).upper().split()) for _ in range(30)]
    rows = [(i, t, "a") for i, t in enumerate([*good[:30], *bad])] + [(5, good[40], "a"), (5, bad[3], "a"), (None, good[41], "b"), (None, bad[4], "b"), (7, good[7], "a"), (8, None, "b"), (9, "", "b")]
    docs = table(spark, rows)
    kept = corpus_pipeline.quality_stage(spark, docs, labels)
    assert kept.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    assert got == Counter((i, t) for i, t, _ in rows if t and "!!" not in t)
    one = corpus_pipeline.dedup_stage(spark, docs, labels)
    got = Counter((r.doc_id, r.text) for r in one.collect())
    assert one.columns == docs.columns and got == Counter({(i, t): 1 for i, t, _ in rows if (i, t) not in ((33, bad[3]), (None, bad[4]))})
    mixed = corpus_pipeline.mixing_stage(spark, docs, labels)
    got = Counter((r.doc_id, r.text) for r in mixed.collect())
    there = Counter((i, t) for i, t, _ in rows)
    assert mixed.columns == docs.columns and all(n <= 2 * there[k] for k, n in got.items()) and got[(7, good[7])] >= 1
    words = sum(len((t or "").split()) * n for (_, t), n in got.items())
    assert abs(words - 1.5 * sum(len((t or "").split()) for _, t, _ in rows)) <= 60


def test_empty_tables(spark, labels):
    docs = table(spark, [(1, "x", "a")]).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, labels).count() == 0
