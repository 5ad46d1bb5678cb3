"""The pipeline's stages on a small corpus, each held against what its operator or brute force says of its own input."""

import random
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from quiremill.llm import bpe
from test_llm_small import prose, shingle_set


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(240):
        kind = i % 6
        text = prose(rng, rng.randrange(20, 80)) if kind < 4 else " ".join(w + "!!" for w in prose(rng, 40).upper().split()) if kind == 4 else rows[rng.randrange(len(rows))][1]
        rows.append((i, text, "en", f"src{i % 3}", len(text or "")))
        if i % 2:
            labels.append((i, int("!!" not in (text or "")), 0))
    rows += [(240, None, None, None, None), (241, "", "en", None, 0)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows


def test_stages(spark, corpus, tmp_path):
    path, rows = corpus
    docs, seen = spark.read.parquet(f"{path}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, path)
        out.write.parquet(str(tmp_path / str(i)))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        docs = spark.read.parquet(str(tmp_path / str(i)))
        seen.append(sorted((r.doc_id, r.text) for r in docs.collect()))
    clean = sorted((r[0], r[1]) for r in rows if r[1] and "!!" not in r[1])
    assert seen[0] == clean
    sets, root = {i: shingle_set(t) for i, t in clean}, {i: i for i, _ in clean}
    for i, _ in clean:
        for j, _ in clean:
            k = len(sets[i] & sets[j])
            if j < i and 100 * k >= 85 * (len(sets[i]) + len(sets[j]) - k):
                a, b = sorted((root[i], root[j]))
                root = {x: a if y == b else y for x, y in root.items()}
    assert [i for i, _ in seen[1]] == sorted(set(root.values()))
    times = Counter(i for i, _ in seen[2])
    assert max(times.values()) <= 2 and set(times) <= {i for i, _ in seen[1]}
    size = {i: len(t.split()) for i, t in seen[1]}
    total = sum(size.values())
    assert abs(sum(size[i] * n for i, n in times.items()) - 1.5 * total) < 0.05 * total
    c = bpe.Codec(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=c.ranks, special_tokens={})
    assert all(r.ids == enc.encode_ordinary(r.text) and r.exact and r.n_tokens == len(r.ids) for r in docs.collect()) and seen[3] == seen[2]


def test_run(spark, corpus):
    path, _ = corpus
    assert corpus_pipeline.run(spark, path).count() > 0
