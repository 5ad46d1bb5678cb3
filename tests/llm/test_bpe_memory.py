"""What a worker remembers of pieces: the ones it meets again, in bounded memory, and only as long as it encodes."""

import random
import re
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from quiremill.llm import bpe, ngram_join, quality

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(RANKS)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def words(rng, n):
    return [" " + "".join(rng.choice("etaoinshrdluqzxj") for _ in range(rng.randrange(8, 13))) for _ in range(n)]


def same(codec, library, texts):
    got = codec.round_trip(texts)
    return all(np.frombuffer(ids, np.int32).tolist() == library.encode_ordinary(t) and raw == t.encode() for (ids, raw), t in zip(got, texts, strict=True))


def anonymous():
    """MB of this process that no file stands for."""
    return int(re.search(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024


def test_common_pieces_are_encoded_once(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 1_000_000)
    rng, encoded = random.Random(5), []
    common, merge = words(rng, 300), codec.merge
    monkeypatch.setattr(codec, "merge", lambda pieces: encoded.extend(pieces) or merge(pieces))
    for _ in range(12):
        assert same(codec, library, ["".join(common + words(rng, 3000) + common)])
    assert len(codec.known) < 10_000 < len(encoded)
    assert max(encoded.count(w.encode()) for w in common) == 1


def test_texts_settled_in_parts(codec, library, monkeypatch):
    rng = random.Random(6)
    texts = ["", "", "".join(words(rng, 500)), "x", "".join(words(rng, 40)) * 9, "", "日本 é" * 300, ""]
    assert same(bpe.Codec(RANKS), library, ["", ""]) and codec.round_trip([]) == []
    for stretch, waiting, cached in ((37, 50, 2000), (1000, 300, 0), (90, 10**6, 10**6)):
        monkeypatch.setattr(bpe, "STRETCH", stretch)
        monkeypatch.setattr(bpe, "WAITING", waiting)
        monkeypatch.setattr(bpe, "CACHED", cached)
        assert same(codec, library, texts)


def test_a_failure_leaves_nothing_half_known(library, monkeypatch):
    codec, merge = bpe.Codec(RANKS), bpe.Codec.merge
    monkeypatch.setattr(bpe.Codec, "merge", lambda self, pieces: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        codec.round_trip(["qzxjq zzqxj"])
    monkeypatch.setattr(bpe.Codec, "merge", merge)
    assert same(codec, library, ["zzqxj qzxjq zzqxj"])


@pytest.mark.parametrize("other", ["quality", "ngram_join"])
def test_other_operators_drop_the_codec(other):
    rng = random.Random(7)
    bpe.codec(RANKS).round_trip(["".join(words(rng, 200_000))])
    held = anonymous()
    if other == "quality":
        list(quality._counted(iter([pa.RecordBatch.from_arrays([pa.array(["a b"]), pa.array([True])], names=["text", "good"])])))
    else:
        list(ngram_join._sets(5)(iter([pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["a b"]), pa.array([2])], names=["id", "text", "h"])])))
    assert not bpe._codecs
    assert anonymous() < held - 60
