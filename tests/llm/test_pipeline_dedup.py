"""The near-duplicate stage against brute force over sets of five words at a Jaccard similarity of 0.8."""

import random

import corpus_pipeline
from test_llm_small import documents, prose, shingle_set


def similar(a, b, percent):
    both = len(a & b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def test_dedup_links_at_five_words(spark):
    rng, texts = random.Random(31), []
    for n in (60, 100, 200, 400):
        words = prose(rng, n).split()
        texts.append(" ".join(words))
        texts += [" ".join([*words, *prose(rng, round(n * x)).split()]) for x in (0.1, 0.2, 0.23, 0.24, 0.3)]  # a passage added
        for edits in range(n // 60, n // 30 + 2):  # words changed here and there
            w = list(words)
            for at in range(10, n - 10, (n - 20) // edits):
                w[at] = prose(rng, 1)
            texts.append(" ".join(w))
    sets, root = [shingle_set(t, 5) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if similar(sets[i], sets[j], 80):
                a, b = sorted((root[i], root[j]))
                root = [a if x == b else x for x in root]
    want = sorted(set(root))
    assert [r.doc_id for r in corpus_pipeline.dedup_stage(spark, documents(spark, texts), "").orderBy("doc_id").collect()] == want


def test_dedup_takes_a_passage_added(spark):
    words = prose(random.Random(7), 100).split()
    longer = [*words, *prose(random.Random(8), 22).split()]
    a, b = " ".join(words), " ".join(longer)
    assert similar(shingle_set(a, 5), shingle_set(b, 5), 80) and not similar(shingle_set(a, 4), shingle_set(b, 4), 85)
    assert [r.doc_id for r in corpus_pipeline.dedup_stage(spark, documents(spark, [a, b]), "").collect()] == [0]
