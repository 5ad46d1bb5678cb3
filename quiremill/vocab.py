"""Closed vocabularies. Rows and statuses are compared by these words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_KINDS = ("heading", "paragraph", "caption", "table", "metadata")
ROLES = ("main_text", "supplement", "non_evidence")
SECTIONS = ("abstract", "introduction", "methods", "results", "discussion", "conclusions", "figure_legends", "supplementary", "data_availability", "back_matter", "references")
FILE_STATUSES = ("ok", "no_text", "no_text_scanned_pdf", "image_no_text", "media_no_text", "data_file_skipped", "unsupported_format", "too_large", "missing", "unreadable", "garbled_text_encoding", "parser_error")
BENIGN_STATUSES = ("image_no_text", "media_no_text", "data_file_skipped")
CAVEATS = ("supplements_expected_but_missing", "supplement_set_unverified", "main_text_thin", "landing_page_only", "manifest_entry_without_a_path", "main_text_is_not_the_requested_article")
ARTICLE_STATUSES = ("complete", "partial", "failed", "no_manifest")
FETCH_STATUSES = ("complete", "partial", "failed", "evicted")
FULLTEXT_STATUSES = ("ok", "scanned_pdf_suspected", "not_research_article", "identity_unverified", "paywalled", "not_in_oa_subset", "proxy_not_configured", "session_expired", "javascript_challenge", "publisher_stub_page", "link_resolver_error", "not_a_pdf", "download_failed", "not_found")
FULLTEXT_USABLE = ("ok", "scanned_pdf_suspected")
SUPPLEMENT_STATUSES = ("none_listed", "fetched", "fetched_unverified", "partial_failure", "expected_but_missing", "none_retrieved", "page_not_parsed", "unknown_none_found", "not_requested")
SUPPLEMENTS_SETTLED = ("none_listed", "fetched", "not_requested")
#: Failures that name a cause, the most telling first.
PDF_DIAGNOSES = ("paywalled", "session_expired", "proxy_not_configured", "publisher_stub_page", "link_resolver_error")
LABEL_SOURCES = ("jats", "jats_caption", "manifest", "review", "none")
HEADER_CONFIDENCES = ("low", "high", "confirmed")
READINESS = ("ready", "ready_with_caveats", "text_unavailable", "not_extracted", "not_fetched")
TRUSTWORTHY = ("ready", "ready_with_caveats")
LEVELS = ("study", "sample")
TRUTH_ROLES = ("own", "reused", "not_an_accession")
#: The strongest verdict on a quote first.
QUOTE_VERDICTS = ("exact", "normalized", "loose", "fuzzy", "wrong_block", "no_such_block", "empty_quote", "quote_not_found", "no_evidence")
CELL_TYPES = ("number", "date", "boolean", "text", "mixed", "empty")


def outside(df: DataFrame, column: str, allowed: tuple[str, ...], nullable: bool = False) -> DataFrame:
    """Values of ``column`` outside the vocabulary, with their number of rows: (value, n). Nothing is dropped unseen."""
    bad = ~F.coalesce(F.col(column).isin(*allowed), F.lit(nullable) & F.col(column).isNull())
    return df.where(bad).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
