"""Quality classifier by importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k.

Both models are bags of hashed n-grams: words, pairs of words, and pairs of word shapes (case, digits, marks, and whether
the second word repeats the first). The raw model counts all documents; the target model counts labelled good ones, of
which ``SAMPLE`` at most are taken by a hash of their ids. A document's log weight is the sum over its n-grams of
log p_target - log p_raw (Xie et al., "Data selection for language models via importance resampling", 2023). Documents are drawn without
replacement in proportion to exp(weight / temperature): the k with the largest weight / temperature + Gumbel noise, the noise from a hash of the id. Noise
decides between documents whose weights differ by a few units, which for texts of some length is where the two models hardly differ. k is a
parameter; unless given it is what accepting each document with probability min(1, p_target / p_raw) would keep on average.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiremill.llm.common import BLOCKS, added, begin, checkpointed, packed

#: Labelled good documents that are used at most.
SAMPLE = 20_000
BUCKETS = 1 << 16
#: Occurrences in raw text as strong as the belief that a bucket is as likely in the target as in raw text; with less, a small target's good documents lose by what it happens not to hold.
PRIOR = 300.0
#: Buckets whose counts travel as one row.
BLOCK = 1 << 10
TEMPERATURE = 1.0
#: Words whose hashes a worker remembers; then it starts anew.
CACHED = 200_000
#: Characters of a text that are cut into words at once; a stretch ends at white space, or grows until it does.
STRETCH = 1 << 19
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _shape(token: str) -> int:
    if not (token[0].isalnum() or token[0] == "_"):
        return 8 + min(3, len(token)) if len(set(token)) == 1 else 12
    if token.isdigit():
        return 1
    if token.islower():
        return 2 if len(token) > 1 else 3
    if token.isupper():
        return 4 if len(token) > 1 else 5
    return 6 if token.istitle() else 7


class Features:
    """Buckets of a text's n-grams."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> Iterator[np.ndarray]:
        """By stretches: the last word of one is the first of the next, where it counts in pairs only."""
        last: list[str] = []
        for part in stretches(text or ""):
            tokens = _TOKEN.findall(part)
            if tokens:
                yield self._buckets(last + tokens, len(last))
                last = tokens[-1:]

    def _buckets(self, tokens: list[str], old: int) -> np.ndarray:
        if len(self.known) > CACHED:
            self.known.clear()
        known = self.known
        for t in [t for t in {*tokens} if t not in known]:
            known[t] = xxhash.xxh3_64_intdigest(t.lower()) & ~15 | _shape(t)
        x = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
        word, shape = x >> np.uint64(4), x & np.uint64(15)
        same = (word[1:] == word[:-1]).astype(np.uint64)
        grams = np.concatenate([word[old:], word[:-1] * _ODD + word[1:], (shape[:-1] << np.uint64(5) | shape[1:] << np.uint64(1) | same) + np.uint64(1 << 62)])
        grams = (grams ^ (grams >> np.uint64(29))) * _MIX
        return ((grams ^ (grams >> np.uint64(32))) & np.uint64(BUCKETS - 1)).astype(np.int64)


def stretches(text: str) -> Iterator[str]:
    at = 0
    while at < len(text):
        end = at + STRETCH
        while end < len(text) and not text[end].isspace():
            end += 1
        yield text[at:end]
        at = end


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per bucket over a task's rows (text, good): raw and target."""
    begin("quality")
    features, raw, target = Features(), np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for text, good in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            for f in features(text.as_py()):
                c = np.bincount(f, minlength=BUCKETS) if len(f) > 2000 else None
                for counts in (raw, target) if good else (raw,):
                    if c is None:
                        np.add.at(counts, f, 1)
                    else:
                        counts += c
    both = np.stack([raw.reshape(-1, BLOCK), target.reshape(-1, BLOCK)], 1)
    yield packed({i: both[i] for i in range(len(both)) if both[i].any()})


def labelled_sample(labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", quality_col: str = "quality") -> DataFrame:
    """(id) of ``sample`` good ones at most, those with the smallest hashes. Null ids and labels are left out; an id with several labels is good if all are."""
    one = labels.where(F.col(id_col).isNotNull() & F.col(quality_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg((F.min(quality_col) > 0).alias("good"))
    return checkpointed(one.where("good").orderBy(F.md5(F.col("id").cast("string")), "id").limit(sample).select("id"))


def log_ratio(raw: np.ndarray, target: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """log p_target - log p_raw of each bucket, held towards 0 by ``prior`` occurrences; 0 all over if the target model counted nothing."""
    if not target.any():
        return np.zeros(len(raw))
    share = target.sum() / raw.sum()
    return np.log((target + prior * share) / (share * (raw + prior)))


def fit(docs: DataFrame, sample: DataFrame) -> np.ndarray:
    """The log ratio of each bucket. docs: (id, text). Counts travel by blocks, BUCKETS / BLOCK rows a task."""
    flagged = docs.join(F.broadcast(sample.withColumn("good", F.lit(True))), "id", "left").select("text", F.coalesce("good", F.lit(False)).alias("good"))  # SAMPLE rows of an id and a flag
    blocks = added(flagged.mapInArrow(_counted, BLOCKS))
    both = np.zeros((BUCKETS // BLOCK, 2, BLOCK))
    for r in blocks.collect():  # BUCKETS / BLOCK rows at most
        both[r.block] += np.frombuffer(r.counts, np.int64).reshape(2, BLOCK)
    return log_ratio(both[:, 0].ravel(), both[:, 1].ravel())


def weights(docs: DataFrame, ratio: np.ndarray, columns: tuple[str, ...] = ("id",)) -> DataFrame:
    """``columns`` of docs and log_weight of their ``text``; null for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("quality")
        features = Features()
        for batch in batches:
            found = ([float(ratio[f].sum()) for f in features(t.as_py())] for t in batch.column(len(columns)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], pa.array([sum(x) if x else None for x in found], pa.float64())], names=[*columns, "log_weight"])

    kinds = dict(docs.dtypes)
    return docs.select(*columns, "text").mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", log_weight double")


def kth_largest(scores: DataFrame, k: int, cells: int = 1024) -> float:
    """The k-th largest ``score``, by counting in ever narrower cells: ``cells`` rows reach the driver each time, whatever the table's size."""
    lo, hi, n = scores.agg(F.min("score"), F.max("score"), F.count("score")).first()
    if k >= n:
        return -np.inf if lo is None else lo
    if k <= 0:
        return np.inf
    above = 0
    while lo < hi:
        width = (hi - lo) / cells
        if width <= 0 or lo + width == lo:
            break
        cell = F.least(F.floor((F.col("score") - lo) / width), F.lit(cells - 1)).cast("int")
        found = sorted(((r.cell, r.n, r.a, r.b) for r in scores.where(F.col("score").between(lo, hi)).groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("a"), F.max("score").alias("b")).collect()), reverse=True)
        for _, count, a, b in found:
            if above + count >= k:
                lo, hi = a, b
                break
            above += count
        if len(found) == 1:
            break
    return lo


def gumbel(id_col: str = "id"):
    """Standard Gumbel noise from 48 bits of an MD5 of the id; null ids share one number."""
    u = (F.conv(F.left(F.md5(F.concat(F.lit("gumbel:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), F.lit(12)), 16, 10).cast("double") + 0.5) / float(1 << 48)
    return -F.log(-F.log(u))


def resample(
    docs: DataFrame, labels: DataFrame, k: int | None = None, sample: int = SAMPLE, temperature: float = TEMPERATURE, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()
) -> DataFrame:
    """One row per document: id, log_weight, score, kept, and the columns ``keep``.

    Null and empty texts and those without words have no weight and are not kept. Very long texts are read by stretches, as a whole. Equal ids share their
    noise, equal texts their weight, and repeated rows each get a row; rows whose score ties with the k-th are all kept. Without good labels every document with words is
    kept; an empty table gives no rows. Other columns are ignored.
    """
    kept = [F.col(f"`{c}`").alias(f"_keep{i}") for i, c in enumerate(keep)]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *kept)
    ratio = fit(rows.select("id", "text"), labelled_sample(labels, sample))
    scored = checkpointed(weights(rows, ratio, ("id", *(f"_keep{i}" for i in range(len(keep))))).withColumn("score", F.col("log_weight") / F.lit(temperature) + gumbel()))
    if k is None:
        k = round(scored.where("log_weight is not null").agg(F.sum(F.least(F.lit(1.0), F.exp("log_weight")))).first()[0] or 0)
    at = kth_largest(scored, k)
    back = [F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)]
    return scored.select(F.col("id").alias(id_col), "log_weight", "score", F.coalesce(F.col("score") >= F.lit(float(at)), F.lit(False)).alias("kept"), *back)
