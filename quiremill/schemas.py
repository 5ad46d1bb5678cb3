"""Explicit schemas of stored records, as DDL. JSON is read under these; rows that don't fit are kept aside and counted."""

from __future__ import annotations

IDENTIFIERS = (
    "struct<doi: string, pmid: string, pmcid: string, title: string, journal: string, year: string, license: string, is_open_access: boolean, in_epmc: boolean, in_pmc: boolean, "
    "has_pdf: boolean, has_suppl: boolean, is_preprint: boolean, pub_types: array<string>, corrects_doi: string, resolved_by: array<string>, lookup_notes: array<string>>"
)
FILE = "struct<path: string, status: string, bytes: bigint, sha256: string, tier: string>"
SUPPLEMENT = "struct<path: string, bytes: bigint, sha256: string, index: int, original_name: string, label: string, tier: string, content_type: string, url: string>"
MANIFEST = (
    f"doi string, doi_raw string, slug string, fetched_at string, fetcher_version string, status string, identifiers {IDENTIFIERS}, fulltext {FILE}, fulltext_xml {FILE}, landing_html {FILE}, "
    f"supplementary array<{SUPPLEMENT}>, supplementary_status string, tiers_tried array<string>, attempts array<struct<tier: string, action: string, status: string>>, problems array<string>, evicted boolean"
)
COLUMN = "struct<name: string, dtype: string, n_values: bigint, n_empty: bigint, n_unique: bigint, values: array<string>, examples: array<string>, min: double, max: double, median: double, n_non_finite: bigint>"
CARD = (
    "struct<source_file: string, locator: string, title: string, caption: string, header: array<string>, header_row: int, header_rows: array<int>, header_confidence: string, n_columns: int, n_rows: int, "
    f"n_rows_total: int, truncated: boolean, columns: array<{COLUMN}>, sample_rows: array<array<string>>, columns_dropped: int, notes: array<string>>"
)
BLOCK = (
    "slug string, index int, block_id string, kind string, role string, origin string, source_file string, locator string, section string, section_source string, section_path array<string>, label string, "
    "caption string, chars int, text_sha256 string, text string, locator_ref struct<page: int, bbox: array<double>, block_no: int>"
)
EXTRACTION = (
    "slug string, status string, caveats array<string>, main_text struct<path: string, status: string, origin: string, source: string, blocks: int, chars: int, section_labelling: struct<confidence: string, method: string>>, "
    "supplementary array<struct<path: string, status: string, label: string, label_source: string>>, supplementary_by_status map<string, int>, extraction_key string, blocks_sha256 string"
)
LABEL = "slug string, doi string, aspect string, complete boolean, accessions array<struct<accession: string, repository: string, level: string, role: string, note: string>>"
ANSWER = (
    "slug string, pos int, kind string, key struct<path: string, source_file: string, locator: string, text_sha256: string, ordinal: int>, source_sha256 string, card_fingerprint string, verdict string, note string, `by` string, at string, "
    "override struct<header_row: int, has_header: boolean, has_content: boolean, evidence: boolean, label: string, caption: string, section: string, main_text_source: string>"
)
