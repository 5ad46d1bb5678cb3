"""Windows are scored many at a time, and only those that may be more than prose are judged one by one."""

import random
import textwrap

import pyarrow.parquet as pq
import pytest

from quiremill.llm import license_scan
from test_llm_small import prose

ODD = [None, "", "\n", " \n\t\n", "the", "the " * 40, "the " * 41, "the " * 60, "the " * 61, "a\nb\n\nc", "Licensed under the MIT\nlicense.", "Licensed under the MIT License.\r\n\r\nİ. the", "Released under the MIT Kind.", ".-."]


@pytest.fixture(scope="module")
def corpus():
    return [t for t in pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist() if t]


@pytest.fixture(scope="module")
def model(corpus):
    return license_scan.Model([" ".join(x.split()[:40]) for t in corpus[:300] for x in t.split("\n")[:4]])


@pytest.fixture(scope="module")
def texts(corpus):
    """Lines of the corpus, notices whole, wrapped, shuffled and inside prose, and lines without words."""
    rng = random.Random(7)
    notices = [n for f in license_scan.NOTICES for n in license_scan.templates(f)]
    lines = [x for t in corpus for x in t.split("\n") if x.strip()]

    def piece():
        notice, line = rng.choice(notices), rng.choice(lines)
        kind = rng.randrange(6)
        if kind == 0:
            return "\n".join(textwrap.wrap(notice, rng.choice([30, 60])))
        if kind == 1:
            return " ".join(rng.sample(notice.split(), len(notice.split())))
        if kind == 2:
            return f"{line} {notice} {line} {line}"
        return ["", "***", rng.choice(license_scan._HARD_PROSE)][kind - 3]

    return ODD + corpus[300:400] + ["\n".join(rng.choice([piece, lambda: rng.choice(lines)])() for _ in range(rng.randrange(1, 9))) for _ in range(150)]


def recorded(model, monkeypatch):
    """What ``judge`` is asked from now on, and what it answers."""
    asked, judge = [], model.judge
    monkeypatch.setattr(model, "judge", lambda tokens, ended: asked.append((tuple(tokens), judge(tokens, ended))) or asked[-1][1])
    return asked


def windows(text):
    """The words of all windows of a text, read plainly."""
    paragraphs = [[]]
    for line in (text or "").split("\n"):
        found = license_scan.words(line)
        if found:
            paragraphs[-1].append(found)
        else:
            paragraphs.append([])
    for lines in paragraphs:
        joined = [(w, i) for i, line in enumerate(lines) for w in line]
        for tokens in [*([(w, i) for w in line] for i, line in enumerate(lines)), joined if len(lines) > 1 else []]:
            size, half = license_scan.WINDOW, license_scan.WINDOW // 2
            for lo in range(0, len(tokens) - half, half) if len(tokens) > size else [0] if tokens else []:
                part = tokens[lo : lo + size]
                if tokens is not joined or part[0][1] != part[-1][1]:
                    yield tuple(w for w, _ in part)


def test_prose_is_not_judged_one_by_one(model, monkeypatch):
    asked = recorded(model, monkeypatch)
    rng = random.Random(8)
    text = "\n".join(f"the {prose(rng, 30)} of {prose(rng, 30)}" for _ in range(400)) + "\nReleased under the MIT License."
    assert [s["family"] for s in model.scan(text)] == ["mit"]
    assert sum(1 for _ in windows(text)) > 1000 and len(asked) < 50


def test_every_window_beyond_prose_is_judged(model, texts, monkeypatch):
    asked = recorded(model, monkeypatch)
    list(model.scan_all(texts))
    got = sorted(tokens for tokens, answer in asked if answer)
    wanted = sorted(w for t in texts for w in windows(t) if license_scan.Model.judge(model, w))
    assert len(got) > 300 and got == wanted and len(asked) < 2 * len(got)


def test_groups_and_blocks_change_nothing(model, texts, monkeypatch):
    whole = list(model.scan_all(texts))
    assert [model.scan(t) for t in texts] == whole and sum(map(len, whole)) > 200
    monkeypatch.setattr(license_scan, "BLOCK", 3)
    monkeypatch.setattr(license_scan, "CHARS", 500)
    assert list(model.scan_all(texts)) == whole
    monkeypatch.setattr(model, "_open", lambda ids, starts, ends: starts >= 0)  # all are judged
    assert list(model.scan_all(texts)) == whole
