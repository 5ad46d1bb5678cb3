"""Queries over whole tables with non-ASCII text, against brute force and, where there is one, their SQL."""

import re
from collections import Counter

import duckdb

from quiremill.functions import quotes as Q
from quiremill.plans import catalog

SF = "/root/testdata/sf0.001"
TEXTS = [
    "Plain text: mail a.b@example.org, Licensed, from 10.0.0.1 and 10.0.0.1.",
    "Café — mail a.b@example.org, “Licensed” from 10.0.0.1.",
    "éLicensed Licensedé é10.0.0.1 are parts of words; Released… is not.",
    "日本 Released 日本",
    "déjà vu: no hits",
    "é.b@example.org aé.c@x.org x@exa.orgé é@b.co .é@b.co 日10.0.0.2 10.0.0.3日 Releasedé",
    "éé.a@x.yz\x01Licensed é-Licensed é_Licensed ²Released ½10.0.0.4",
    "",
    None,
]
_MENTION = re.compile(r"\b(?:[A-Za-z0-9._]+@[a-z0-9.]+[a-z])\b|\b(?:Licensed|Released)\b|\b(?:[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})\b")


def mentions(docs):
    kind = lambda x: "mail" if "@" in x else "license" if x in ("Licensed", "Released") else "ip"
    return sorted((i, x, kind(x), n) for i, t in docs for x, n in Counter(_MENTION.findall(t or "")).items())


def by_sql(path):
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{path}'")
    return sorted(db.execute(f"select slug, accession, repository, n from ({catalog.ORACLES['finder_mentions']})").fetchall())


def test_finder_mentions_in_all_documents(spark, tmp_path):
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = catalog.QUERIES["finder_mentions"](spark, str(tmp_path)).select("slug", "accession", "repository", "n").collect()
    assert sorted(map(tuple, got)) == mentions(enumerate(TEXTS))
    assert {r.slug for r in got} >= {0, 1, 2, 3}
    assert sorted(map(tuple, got)) == by_sql(f"{tmp_path}/documents.parquet/*.parquet")


def test_finder_mentions_over_the_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, catalog.QUERIES["finder_mentions"](spark, SF).select("slug", "accession", "repository", "n").collect()))
    assert got == mentions(docs)
    assert got == by_sql(f"{SF}/documents.parquet")


TURNS = [
    # conversation, turns: the quote is what stands at characters 3 to 62 of each
    ("a – “quoted” text…", 'and here: – "quoted" text... of it', "next"),
    ("x ﬁne caf\u00e9 words", "so fine cafe\u0301 words there", "é"),
    ("b Exact, words – all", "yes: Exact, words – all", "no"),
    ("c Case AND marks!", "it has case, and marks – é", "zz"),
    ("ééé", "ééé", "é  "),
    ("", None, "é"),
]


def verdict(quote, text):
    q, t = quote or "", text or ""
    if not q.split():
        return "empty_quote"
    if q in t:
        return "exact"
    qn, tn = Q.normalized_text(q), Q.normalized_text(t)
    if qn and qn in tn:
        return "normalized"
    ql, tl = (re.sub("[^0-9a-z]+", "", x.lower()) for x in (qn, tn))
    return "loose" if ql and ql in tl else None


def next_turn_verdicts(rows):
    """rows: (conv_id, turn, text). A missing next turn and one without text are no block."""
    text = {(c, t): x for c, t, x in rows}
    key = lambda r: (r[0], r[1], str(r[2]))
    return sorted(((c, t, "no_such_block" if text.get((c, t + 1)) is None else verdict(None if x is None else x[2:62], text[c, t + 1])) for c, t, x in rows), key=key)


def judged(spark, path):
    got = catalog.QUERIES["quote_verify_next_turn"](spark, path).select("conv_id", "turn", "verdict").collect()
    return sorted(map(tuple, got), key=lambda r: (r[0], r[1], str(r[2])))


def test_quotes_of_all_turns(spark, tmp_path):
    rows = [(c, t, x) for c, turns in enumerate(TURNS) for t, x in enumerate(turns)]
    spark.createDataFrame(rows, "conv_id long, turn long, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = judged(spark, str(tmp_path))
    assert got == next_turn_verdicts(rows) and len(got) == len(rows)
    assert [v for c, t, v in got if t == 0][:4] == ["normalized", "normalized", "exact", "loose"]


def test_quotes_over_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "text").collect()]
    got = judged(spark, SF)
    assert got == next_turn_verdicts(rows) and len(got) == len(rows)
