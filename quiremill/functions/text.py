"""Scalar text functions as columns: headings, citations, cells, identifiers, names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Heading aliases by section, tried in this order.
STAR = "[*★☆✪✩]"
ALIASES: tuple[tuple[str, str], ...] = (
    ("abstract", r"abstract|summary|graphical\s+abstract|one[-\s]sentence\s+summary"),
    ("introduction", r"introduction|background"),
    (
        "methods",
        r"(?:online|extended|supplement(?:al|ary)|detailed|expanded)?\s*(?:star\s*" + STAR + r"?\s*)?(?:materials?\s+and\s+)?methods?|methods?\s+and\s+materials?"
        r"|experimental\s+(?:procedures?|methods?|design|model)|experimental\s+model(?:\s+and\s+subject\s+details?)?|quantification\s+and\s+statistical\s+analysis"
        r"|supplement(?:al|ary)\s+experimental\s+procedures?|methods?\s+summary|materials?\s+and\s+methods?|method\s+details?|star\s*" + STAR + r"?\s*methods?",
    ),
    ("results", r"results?\s+and\s+discussion|results?|findings"),
    ("discussion", r"discussion"),
    ("conclusions", r"conclusions?|concluding\s+remarks"),
    ("figure_legends", r"(?:supplementary\s+|extended\s+data\s+)?figure\s+legends?|legends?\s+(?:to|for)\s+figures?"),
    ("supplementary", r"supplement(?:al|ary)\s+(?:information|material|data|notes?|methods?|results?)|extended\s+data|supporting\s+information"),
    (
        "data_availability",
        r"(?:(?:data|code|materials?|software)\s+(?:and\s+\w+\s+)?availability|availability\s+of\s+(?:data|code)(?:\s+and\s+materials?)?)(?:\s+statements?)?|accession\s+(?:codes?|numbers?)",
    ),
    ("references", r"references?\s+and\s+notes|references?|bibliography|literature\s+cited|works\s+cited"),
    (
        "back_matter",
        r"acknowledge?ments?|author\s+contributions?|competing\s+interests?|conflicts?\s+of\s+interest|funding|ethics\s+\w+|declarations?|additional\s+information|reporting\s+summary|abbreviations",
    ),
)
# JATS sec-type to section.
SEC_TYPES: dict[str, str] = {
    "intro": "introduction", "introduction": "introduction", "methods": "methods", "materials|methods": "methods", "methods|materials": "methods", "materials-and-methods": "methods",
    "subjects|methods": "methods", "results": "results", "results|discussion": "results", "discussion": "discussion", "conclusions": "conclusions", "supplementary-material": "supplementary",
    "abstract": "abstract", "data-availability": "data_availability", "availability": "data_availability", "COI-statement": "back_matter", "acknowledgement": "back_matter",
    "funding-information": "back_matter", "ref-list": "references",
}
# An optional number or bullet before a heading; what an entry of a reference list looks like.
HEADING_PREFIX = r"(?:(?:\d+(?:\.\d+)*|[IVXLC]+|[d●▪•⁃])\s*[.)]?\s*)?"
CITATION = r"^\s*\d{1,4}\s*[.)]\s+\S|\(\d{4}[a-z]?\)|\bet\s+al\b|\bdoi\s*:|doi\.org/"
MAX_HEADING_CHARS = 120
MIN_GLUED_REMAINDER = 40
MAX_HEADING_WORDS = 12
# The shape of a DOI in running text, and title words that say nothing.
DOI = r"10\.\d{4,9}/[^\s\"'<>()\[\],;]+"
TITLE_STOPWORDS = (
    "the", "and", "for", "with", "from", "that", "this", "into", "onto", "upon", "over", "under", "during", "between", "across", "their", "these", "those",
    "human", "cell", "cells", "cellular", "single", "analysis", "analyses", "reveals", "reveal", "identifies", "identify", "study", "studies", "using",
)
TITLE_TOKEN_CHARS = 4


def collapsed(text: Column) -> Column:
    """White space of any kind as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def section_of_heading(heading: Column, sec_type: Column | None = None) -> Column:
    """X3. The section that a heading names, the JATS type first; null if it names none or is too long."""
    line = collapsed(heading)
    fits = (line != "") & (F.length(line) <= MAX_HEADING_CHARS)
    by_alias = F.coalesce(*(F.when(fits & line.rlike(rf"(?iU)^\s*{HEADING_PREFIX}(?:{body})\s*[:.]?\s*$"), name) for name, body in ALIASES))
    if sec_type is None:
        return by_alias
    pairs = F.create_map(*(F.lit(x) for pair in SEC_TYPES.items() for x in pair))
    return F.coalesce(F.try_element_at(pairs, F.trim(sec_type)), by_alias)


def looks_like_heading(text: Column) -> Column:
    """X4. A line that may be a heading of any kind: short, without a sentence's end, a known one or all or mostly capitalised."""
    line = F.trim(text)
    tokens = F.filter(F.split(collapsed(line), " "), lambda w: w != "")
    alpha = F.filter(tokens, lambda w: w.rlike(r"^\p{L}"))
    upper = F.filter(alpha, lambda w: w.rlike(r"^\p{Lu}"))
    shouted = (F.upper(line) == line) & (F.lower(line) != line)
    needed = F.greatest(F.lit(2), F.floor(F.size(alpha) * 0.8).cast("int"))
    able = (line != "") & (F.length(line) <= MAX_HEADING_CHARS) & ~line.rlike(r"[.,;]$")
    general = F.size(tokens).between(1, MAX_HEADING_WORDS) & (F.size(alpha) > 0) & (shouted | (F.size(upper) >= needed))
    return F.coalesce(able & (section_of_heading(line).isNotNull() | general), F.lit(False))


def glued_heading(text: Column) -> Column:
    """X5. STRUCT<section, heading, rest> of a paragraph that begins with a known heading and then a new sentence of ``MIN_GLUED_REMAINDER`` characters or more; else null."""
    tries = []
    for name, body in ALIASES:
        pattern = rf"^\s*(?i:{body})\b\s*[:.]?\s+(?=[A-Z0-9])"
        head = F.regexp_extract(text, f"({pattern})", 1)
        rest = F.trim(F.substring(text, F.length(head) + 1, F.length(text)))
        found = F.struct(F.lit(name).alias("section"), F.regexp_replace(head, r"^[ :.]+|[ :.]+$", "").alias("heading"), rest.alias("rest"))
        tries.append(F.when(head != "", found))
    first = F.coalesce(*tries)  # the first alias that matches decides, even if what follows is too short
    return F.when(F.length(first["rest"]) >= MIN_GLUED_REMAINDER, first)


def looks_like_citation(text: Column) -> Column:
    """X6. May this be an entry of a reference list?"""
    return F.coalesce(text.rlike(f"(?iU){CITATION}"), F.lit(False))


def words(text: Column) -> Column:
    """X12. Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def shingles(tokens: Column, size: int = 8) -> Column:
    """X12. Each run of ``size`` words as one string, in order; empty below ``size`` words."""
    n = F.size(tokens)
    return F.when(n >= size, F.transform(F.sequence(F.lit(1), n - (size - 1)), lambda i: F.array_join(F.slice(tokens, i, size), " "))).otherwise(F.array().cast("array<string>"))


def normalized_doi(raw: Column) -> Column:
    """X13. The DOI in ``raw``, lower-cased, without a resolver before and punctuation behind it; null if there is none."""
    found = F.lower(F.regexp_extract(F.trim(raw), r"(?i)(10\.\d{4,9}/\S+)", 1))
    return F.nullif(F.regexp_replace(found, r"[.,;:)\]\s]+$", ""), F.lit(""))


def doi_slug(doi: Column) -> Column:
    """X13. A name for files: / as _, other unsafe characters as -, long ones cut with a hash behind."""
    safe = F.regexp_replace(F.regexp_replace(doi, "/", "_"), r"[^A-Za-z0-9._-]", "-")
    return F.when(F.length(safe) > 150, F.concat(F.left(safe, F.lit(150)), F.lit("-"), F.left(F.sha2(doi, 256), F.lit(8)))).otherwise(safe)


def cited_dois(text: Column, exclude: Column, limit: int = 3) -> Column:
    """X15. Distinct DOIs in order of appearance, ``exclude`` left out."""
    found = F.transform(F.regexp_extract_all(text, F.lit(DOI), F.lit(0)), lambda d: F.lower(F.regexp_replace(d, r"[.,;:)]+$", "")))
    skip = F.coalesce(F.lower(F.trim(exclude)), F.lit(""))
    return F.slice(F.array_distinct(F.filter(found, lambda d: d != skip)), 1, limit)


def squashed(text: Column) -> Column:
    """Lower case without white space, to find what line breaks cut."""
    return F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", ""))


def mentions_doi(text: Column, doi: Column) -> Column:
    return F.coalesce((F.length(doi) > 0) & F.contains(squashed(text), squashed(doi)), F.lit(False))


def significant_words(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.regexp_replace(F.lower(text), "[^0-9a-z]+", " "), " "), lambda w: (F.length(w) >= TITLE_TOKEN_CHARS) & ~w.isin(*TITLE_STOPWORDS)))


def title_overlap(text: Column, title: Column) -> Column:
    """X16. Share of a title's significant words that a text holds; null if the title has none."""
    wanted = significant_words(F.coalesce(title, F.lit("")))
    held = F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^0-9a-z]+", " "), " ")
    return F.when(F.size(wanted) > 0, F.size(F.array_intersect(wanted, held)) / F.size(wanted))


def identity(text: Column, doi: Column, title: Column, least_chars: int = 200, least_overlap: float = 0.6) -> Column:
    """X17. STRUCT<verified, matched_on, title_overlap, opening>: is this the document of this DOI?"""
    chars, by_doi, overlap = F.length(F.coalesce(text, F.lit(""))), mentions_doi(text, doi), title_overlap(text, title)
    by_title = F.coalesce(overlap >= least_overlap, F.lit(False))
    undecidable = (chars < least_chars) & ~by_doi
    return F.struct(
        (undecidable | by_doi | by_title).alias("verified"),
        F.when(by_doi, "doi").when(~undecidable & by_title, "title").when(undecidable, "undecidable").alias("matched_on"),
        F.when(~by_doi & ~undecidable, overlap).alias("title_overlap"),
        F.when(~(undecidable | by_doi | by_title), F.left(collapsed(F.left(text, F.lit(400))), F.lit(200))).alias("opening"),
    )


def clean_cell(value: Column) -> Column:
    """X1. A cell's text: no-break spaces are spaces, white space is one space, nothing is null."""
    return F.nullif(collapsed(F.translate(value.cast("string"), " ", " ")), F.lit(""))


# How cells of each type read.
NUMBER = r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*%?$"
DATE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}.*)?$"
NON_FINITE = r"(?i)^[-+]?(inf|infinity|nan)$"


def value_kind(cell: Column) -> Column:
    """X2. boolean, number, date or text of a clean cell; null of a null."""
    return F.when(cell.isNull(), None).when(F.lower(cell).isin("true", "false", "yes", "no", "y", "n"), "boolean").when(cell.rlike(NUMBER), "number").when(cell.rlike(DATE), "date").otherwise("text")


def as_number(cell: Column) -> Column:
    """X2. The number in a numeric cell, per cent signs left out; null of all others."""
    return F.when(cell.rlike(NUMBER), F.regexp_replace(cell, r"[%\s]", "").try_cast("double"))


def dehyphenated(text: Column) -> Column:
    """X19. Line breaks within words closed: a hyphen goes, but stays beside a digit or before a capital; soft hyphens and zero-width characters go."""
    t = F.regexp_replace(text, "[­​‌‍⁠﻿]", "")
    t = F.regexp_replace(t, r"(?<=\d)-\s*\n\s*|-\s*\n\s*(?=[\d\p{Lu}])", "-")
    t = F.regexp_replace(t, r"(?<=\p{L})-\s*\n\s*(?=\p{Ll})", "")
    return collapsed(F.translate(t, " ", " "))


def is_page_number(line: Column) -> Column:
    """X20. A line that only counts pages."""
    return F.coalesce(F.trim(line).rlike(r"(?i)^(page\s*)?\d{1,4}(\s*(/|of)\s*\d{1,4})?$"), F.lit(False))


def in_margin(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column) -> Column:
    """X21. Is a box within the outer 12 % above and below, or 8 % left and right?"""
    return (y1 <= height * 0.12) | (y0 >= height * 0.88) | (x1 <= width * 0.08) | (x0 >= width * 0.92)


def sanitized_name(name: Column) -> Column:
    """X14. The last part of a path with unsafe characters as _."""
    return F.regexp_replace(F.element_at(F.split(name, r"[/\\]"), -1), r"[^A-Za-z0-9._-]+", "_")


def ordinal_name(ordinal: Column, name: Column) -> Column:
    return F.concat(F.lpad(ordinal.cast("string"), 2, "0"), F.lit("_"), sanitized_name(name))


def tri_state(flag: Column) -> Column:
    """X28. Y or N as a boolean; all else is unknown."""
    return F.when(F.upper(F.trim(flag)) == "Y", True).when(F.upper(F.trim(flag)) == "N", False)


def label_of_caption(caption: Column, most: int = 40) -> Column:
    """X25. What stands before a caption's first full stop, if short."""
    head = F.trim(F.split_part(caption, F.lit("."), F.lit(1)))
    return F.when((head != "") & (F.length(head) <= most), head)


def human_bytes(n: Column) -> Column:
    """X24."""
    return F.when(n < 1024, F.format_string("%d B", n)).when(n < 1 << 20, F.format_string("%.1f KB", n / 1024)).when(n < 1 << 30, F.format_string("%.1f MB", n / (1 << 20))).otherwise(F.format_string("%.1f GB", n / (1 << 30)))


def url_without_fragment(url: Column) -> Column:
    """X27."""
    return F.split_part(url, F.lit("#"), F.lit(1))


def safe_member_name(name: Column) -> Column:
    """X27. An archive member's name, null if it leaves the archive or is a folder or hidden."""
    path = F.regexp_replace(name, r"\\", "/")
    bad = path.startswith("/") | path.rlike(r"(^|/)\.\.(/|$)") | path.endswith("/") | path.rlike(r"(^|/)(\.|__MACOSX/)") | path.rlike(r"^[A-Za-z]:")
    return F.when(~bad & (path != ""), path)


def stripped_tags(markup: Column) -> Column:
    """X18."""
    return collapsed(F.regexp_replace(markup, "<[^>]+>", " "))


def jats_article_type(markup: Column) -> Column:
    """X18. The root element's article-type, lower-cased; null if absent."""
    root = F.regexp_extract(markup, r"(?i)<article\b[^>]*>", 0)
    return F.nullif(F.lower(F.trim(F.regexp_extract(root, r"""(?i)\barticle-type\s*=\s*["']([^"']+)["']""", 1))), F.lit(""))


def tidied_citations(text: Column) -> Column:
    """X26. Punctuation that is left where citations were taken out: empty brackets, doubled commas, space before a stop."""
    t = F.regexp_replace(text, r"[\[(]\s*[,;–-]*\s*[\])]", "")
    t = F.regexp_replace(t, r"([,;])(\s*[,;])+", "$1")
    return collapsed(F.regexp_replace(t, r"\s+(?=[.,;:])", ""))
