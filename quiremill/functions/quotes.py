"""Quotes compared with texts: the ladder exact, normalized, loose, fuzzy. Only what the first three leave needs Python."""

from __future__ import annotations

import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

# Characters folded to their plain form, and those without width.
DASHES = "‐‑‒–—―−"
SINGLE = "‘’‚‛′"
DOUBLE = "“”„‟″"
INVISIBLE = "​‌‍⁠﻿­"
FUZZY_COVERAGE = 0.92
FUZZY_RUN = 0.4
FUZZY_MIN_CHARS = 40
_FOLD = str.maketrans({**dict.fromkeys(DASHES, "-"), **dict.fromkeys(SINGLE, "'"), **dict.fromkeys(DOUBLE, '"'), "…": "...", **dict.fromkeys(INVISIBLE)})


def normalized_text(text: str | None) -> str:
    return " ".join(unicodedata.normalize("NFKC", text).translate(_FOLD).split()) if text else ""


@F.pandas_udf(StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def normalized(text: Column) -> Column:
    """X7. NFKC, dashes and quotes folded, white space collapsed, case kept. Pure ASCII stays in the JVM."""
    text = F.coalesce(text, F.lit(""))
    plain = F.when(text.rlike(r"^\p{ASCII}*$"), text).otherwise(_nfkc(text))
    t = F.translate(plain, INVISIBLE, "")
    t = F.translate(t, DASHES + SINGLE + DOUBLE, "-" * len(DASHES) + "'" * len(SINGLE) + '"' * len(DOUBLE))
    return F.trim(F.regexp_replace(F.replace(t, F.lit("…"), F.lit("...")), r"(?U)\s+", " "))


def loosened(text: Column) -> Column:
    """X8. Normalized, then only a-z and 0-9 of the lower-cased text."""
    return F.regexp_replace(F.lower(normalized(text)), "[^0-9a-z]+", "")


def fuzzy_measures(quote: str, text: str) -> tuple[float, float]:
    """(coverage, longest run) as shares of the quote's length, over loosened forms."""
    m = SequenceMatcher(None, quote, text, autojunk=False)
    return sum(b.size for b in m.get_matching_blocks()) / len(quote), m.find_longest_match(0, len(quote), 0, len(text)).size / len(quote)


@F.pandas_udf(StructType().add("coverage", DoubleType()).add("longest_run", DoubleType()))
def fuzzy(quotes: pd.Series, texts: pd.Series) -> pd.DataFrame:
    """X9. For rows that no cheaper level matched; null where the quote is too short to say."""
    out = [fuzzy_measures(q, t) if q and t and len(q) >= FUZZY_MIN_CHARS else (None, None) for q, t in zip(quotes, texts, strict=True)]
    return pd.DataFrame(out, columns=["coverage", "longest_run"], dtype="float64")


def cheap_verdict(quote: Column, text: Column) -> Column:
    """X9 without its last level: exact, normalized, loose, empty_quote or null."""
    q, t = F.coalesce(quote, F.lit("")), F.coalesce(text, F.lit(""))
    qn, tn, ql, tl = normalized(q), normalized(t), loosened(q), loosened(t)
    return (
        F.when(F.trim(F.regexp_replace(q, r"(?U)\s+", " ")) == "", "empty_quote")
        .when(F.contains(t, q), "exact")
        .when((qn != "") & F.contains(tn, qn), "normalized")
        .when((ql != "") & F.contains(tl, ql), "loose")
    )
