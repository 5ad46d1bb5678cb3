"""BPE over what is long, without spaces, or under an odd vocabulary: equal to the library, in bounded memory."""

import base64
import random
import resource

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from quiremill.llm import bpe


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def same(codec, library, texts):
    got = codec.round_trip(texts)
    return all(np.frombuffer(ids, np.int32).tolist() == library.encode_ordinary(t) and raw == t.encode() for (ids, raw), t in zip(got, texts, strict=True))


def test_runs_of_han(codec, library):
    rng = random.Random(1)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    texts = [" ".join("".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(80)) for _ in range(150)) for _ in range(105)]  # 3.8 MB
    assert same(codec, library, texts)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500_000


def test_many_long_pieces(codec, library):
    rng = random.Random(2)
    assert same(codec, library, [" ".join("".join(rng.choice("etaoinshrdlu") for _ in range(252)) for _ in range(40)) for _ in range(40)])


def test_one_piece_of_a_megabyte(codec, library):
    assert same(codec, library, ["x" * 1_000_003, "ab" * 200_000 + "aab" * 60_000, "ACGT" * 30_000 + "TTAGGG" * 20_000])


def test_windows(codec, library, monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("etaoinshr") for _ in range(3000)), "a" * 997, "".join(rng.choice("ACGT") for _ in range(2000)), "the" * 400]
    for window in (24, 61, 250):
        monkeypatch.setattr(bpe, "WINDOW", window)
        monkeypatch.setattr(bpe, "AGAIN", 2)
        assert same(codec, library, texts)


def test_odd_vocabularies(tmp_path, monkeypatch):
    """Ranks at random: tokens that no merge reaches, and merges that come before those they are made of."""
    for seed in range(12):
        rng = random.Random(seed)
        tokens = {bytes([b]) for b in range(256)}
        for _ in range(60):
            tokens.add(b"".join(rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(2, 6))))
        tokens = sorted(tokens)
        rng.shuffle(tokens)
        ranks = {t: i for i, t in enumerate([t for t in tokens if len(t) == 1] + [t for t in tokens if len(t) > 1])} if seed % 2 else {t: i for i, t in enumerate(tokens)}
        path = tmp_path / f"{seed}.tiktoken"
        path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for t, i in ranks.items()))
        library = tiktoken.Encoding("odd", pat_str=r"\S+|\s", mergeable_ranks=ranks, special_tokens={})
        codec = bpe.Codec(str(path), r"\S+|\s")
        texts = ["".join(rng.choice("aaabbc") for _ in range(rng.randrange(1, 300))) for _ in range(40)] + ["abc" * 200, "a" * 301]
        assert same(codec, library, texts)
        monkeypatch.setattr(bpe, "WINDOW", 40)
        assert same(codec, library, texts)
        monkeypatch.undo()
