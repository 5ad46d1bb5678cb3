"""Licence texts as files carry them, and precision and recall on what the model did not see."""

import random
import textwrap

import pyarrow.parquet as pq
import pytest

from quiremill.llm import license_scan


@pytest.fixture(scope="module")
def corpus():
    texts = [t for t in pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist() if t]
    lines = [x for t in texts for x in t.split("\n") if x.strip() and "icense" not in x and "ights" not in x and "eleased under" not in x]
    random.Random(5).shuffle(lines)
    return lines


@pytest.fixture(scope="module")
def model(corpus):
    return license_scan.Model([" ".join(x.split()[:40]) for x in corpus[:1600]])


def families(model, text):
    return {s["family"] for s in model.scan(text)}


@pytest.mark.parametrize("family", sorted(license_scan.TEXTS))
@pytest.mark.parametrize(("width", "lead"), [(60, ""), (72, "# "), (79, " * "), (100_000, "// ")])
def test_whole_texts(model, family, width, lead):
    text = "\n".join(lead + line for part in license_scan.TEXTS[family].split("\n") for line in textwrap.wrap(part, width))
    found = families(model, f"import this\n\n{text}\n\ndef f():\n    return 1\n")
    assert family in found and found <= {family, "unknown"}


@pytest.mark.parametrize("family", sorted(license_scan.SPDX))
def test_spdx_tags(model, family):
    assert all(families(model, f"// SPDX-License-Identifier: {x}\nint main() {{}}\n") == {family} for x in license_scan.SPDX[family])


def test_words_of_licences_in_prose(model):
    for text in ("All rights reserved the hotel said, and the party of four left with permission.", "The terms of the treaty were made public in a second version.", "Her licence to drive was subject to conditions."):
        assert families(model, text) <= {"unknown"}
    assert families(model, "Copyright 2019 Some Press. All rights reserved.") == {"proprietary"}


def test_precision_and_recall_on_held_out_lines(model, corpus):
    """Lines of the corpus that training did not see, every fourth with a notice in it: 0.98 of passages right, 0.98 of notices found."""
    rng = random.Random(6)
    notices = [(f, n) for f, ns in license_scan.NOTICES.items() for n in ns if len(n.split()) > 4]
    right = found = wanted = 0
    for i, line in enumerate(corpus[1600:4000]):
        family = None
        if i % 4 == 0:
            family, notice = rng.choice(notices)
            line = f"{line} {notice}" if i % 8 else f"{notice} {line}"
        got = families(model, line) - {"unknown"}
        right += got <= {family} if got else 0
        found += bool(got)
        wanted += family is not None
        right -= bool(got) and family not in got and got <= {family}
    assert found and right / found > 0.98 and right / wanted > 0.95
