"""Fingerprints against one-permutation MinHash with optimal densification written plainly."""

import json
import random

import xxhash
from pyspark.sql import functions as F
from test_llm_small import documents, prose

from quiremill.llm import fingerprint


def brute(text):
    words = text.lower().split()
    if not words:
        return ""
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    shingles = set()
    for i in range(max(1, len(words) - 4)):
        h = 42
        for x in hashes[i : i + 5]:
            h = xxhash.xxh64_intdigest(x.to_bytes(8, "little"), h)
        shingles.add(h)
    bins = {}
    for h in shingles:
        j = h >> 56 ^ 128  # bins stand in the order of signed hashes
        bins[j] = min(bins.get(j, h), h)
    order = json.loads(fingerprint.probes())
    filled = [bins[j] if j in bins else bins[next(q for q in order[j] if q in bins)] for j in range(256)]
    return "".join(f"{h & 255:02x}" for h in filled)


def test_against_brute_force(spark):
    rng = random.Random(21)
    texts = [prose(rng, n) for n in (1, 2, 4, 5, 6, 7, 9, 14, 30, 80, 200, 900, 4000)] + [None, "", " \n", "Same words here Same words here", "x" * 300_000, prose(rng, 60_000)]
    got = {r.doc_id: r.f for r in fingerprint.with_bins(documents(spark, texts), F.col("text"), "bins").select("doc_id", fingerprint.as_hex("bins").alias("f")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == brute(t or ""), i


def test_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (None, None), (3, "d e f g h i"), (3, "d e f g h i"), (3, "other")], "doc_id long, text string").withColumn("bins", F.lit("clash"))
    got = fingerprint.fingerprints_with_next(df).collect()
    assert sorted((r.doc_id is None, r.n_chars) for r in got) == [(False, 5), (False, 11), (False, 11), (True, 0), (True, 5), (True, 5)]
