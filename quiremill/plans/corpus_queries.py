"""Queries over the corpus-wide operators: records, files, links, rollups, checks, cards."""

from __future__ import annotations

from pyspark.sql import functions as F

from quiremill.functions import text as T
from quiremill.operators import cards, corpus, fetch, review
from quiremill.sources.tables import read

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


_SECTION = "case lang when 'en' then 'methods' when 'de' then 'results' when 'es' then 'introduction' end"


def _sectioned(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    section = F.when(F.col("lang") == "en", "methods").when(F.col("lang") == "de", "results").when(F.col("lang") == "es", "introduction")
    return d.select(F.col("source").alias("slug"), section.alias("section"), "text", F.col("lang").alias("source_file"), F.when(F.col("doc_id") % 7 == 0, "table").otherwise("paragraph").alias("kind"), "doc_id")


@query(
    rf"""with b as (select source as slug, {_SECTION} as section, text from documents),
a as (select slug, count(*) as total_blocks, count(section) as labelled_blocks, sum(length(text))::bigint as total_chars, sum(case when section is not null then length(text) else 0 end)::bigint as labelled_chars, list_sort(list_distinct(list(section) filter (where section is not null))) as present from b group by slug)
select slug, total_blocks, labelled_blocks, total_chars, labelled_chars, round(labelled_chars / total_chars, 2) as coverage, array_to_string(present, ',') as sections_found, array_to_string(list_filter(['methods', 'results'], lambda s: not list_contains(present, s)), ',') as sections_missing,
case when len(present) = 0 then 'none' when not (list_contains(present, 'methods') and list_contains(present, 'results')) then 'low' when round(labelled_chars / total_chars, 2) < 0.75 then 'low' else 'ok' end as confidence from a"""
)
def section_coverage(spark, sf_dir):
    """Labelled share of sources' documents, the language standing for the section."""
    c = corpus.section_coverage(_sectioned(spark, sf_dir))
    return c.select("slug", "total_blocks", "labelled_blocks", "total_chars", "labelled_chars", "coverage", F.array_join("sections_found", ",").alias("sections_found"), F.array_join("sections_missing", ",").alias("sections_missing"), "confidence")


@query(
    r"""select l_orderkey as slug, count(*) as tables, count(*) filter (where l_linestatus = 'O') as header_low, count(*) filter (where l_returnflag = 'A') as headerless, count(*) filter (where l_quantity > 40) as truncated, sum(case when l_linenumber > 3 then l_linenumber else 0 end)::bigint as columns_dropped from lineitem group by 1"""
)
def review_signals(spark, sf_dir):
    """A10: an order's lines as cards."""
    li = read(spark, sf_dir, "lineitem")
    c = li.select(
        F.col("l_orderkey").alias("slug"), F.when(F.col("l_linestatus") == "O", "low").otherwise("high").alias("header_confidence"), F.when(F.col("l_returnflag") != "A", 0).alias("header_row"), (F.col("l_quantity") > 40).alias("truncated"), F.when(F.col("l_linenumber") > 3, F.col("l_linenumber").cast("long")).alias("columns_dropped")
    )
    return corpus.review_signals(c)


@query(r"""with c as (select user_id, event_type, count(*) as n from events group by all) select user_id, string_agg(event_type || '=' || n, ',' order by event_type) as census from c group by user_id""")
def census(spark, sf_dir):
    """A user's events by type."""
    c = corpus.census(read(spark, sf_dir, "events"), "user_id", "event_type")
    return c.select("user_id", F.array_join(F.transform(F.map_entries("census"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("census"))


@query(rf"""select source as slug, count(distinct lang) as files, count(*) as blocks, sum(length(text))::bigint as chars, count(*) filter (where doc_id % 7 = 0) as tables, coalesce(array_to_string(list_sort(list_distinct(list({_SECTION}) filter (where {_SECTION} is not null))), ','), '') as sections from documents group by source""")
def corpus_totals(spark, sf_dir):
    """Files, blocks, characters, tables and sections of sources."""
    return corpus.totals(_sectioned(spark, sf_dir)).withColumn("sections", F.array_join("sections", ","))


@query(
    r"""with f as (select l_orderkey, list(l_linenumber::varchar) as paths, list(l_linenumber::varchar) filter (where l_quantity < 49) as held from lineitem group by 1)
select o_orderkey, case when o_orderstatus = 'P' then true when o_orderstatus = 'F' then len(list_filter(paths, lambda p: not list_contains(coalesce(held, []), p))) = 0 else false end as done from orders join f on l_orderkey = o_orderkey"""
)
def fetch_complete(spark, sf_dir):
    """FL9: orders as articles, their lines as files."""
    n = F.col("l_linenumber").cast("string")
    f = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(n).alias("paths"), F.collect_list(F.when(F.col("l_quantity") < 49, n)).alias("held"))
    j = read(spark, sf_dir, "orders").join(f, F.col("l_orderkey") == F.col("o_orderkey"))
    status = F.when(F.col("o_orderstatus") == "P", "evicted").when(F.col("o_orderstatus") == "F", "complete").otherwise("failed")
    return j.select("o_orderkey", corpus.fetch_complete(status, F.col("paths"), F.col("held")).alias("done"))


_DOI_LINE = "case when p_partkey % 7 = 0 then '# note' when p_partkey % 5 = 0 then 'no such ' || p_brand else 'https://doi.org/10.1234/' || replace(p_brand, '#', '-') || '.  # ' || p_name end"


def _doi_lines(spark, sf_dir):
    k = F.col("p_partkey")
    line = F.when(k % 7 == 0, "# note").when(k % 5 == 0, F.concat(F.lit("no such "), "p_brand")).otherwise(F.concat(F.lit("https://doi.org/10.1234/"), F.replace("p_brand", F.lit("#"), F.lit("-")), F.lit(".  # "), "p_name"))
    return read(spark, sf_dir, "part").select(k.alias("pos"), line.alias("line"))


@query(rf"""with l as (select p_partkey as pos, trim(split_part({_DOI_LINE}, '#', 1)) as bare from part) select lower(rtrim(regexp_extract(bare, '(10\.[0-9]{{4,9}}/\S+)', 1), '.,;:)]')) as doi, min(pos) as first_at, count(*) as mentions from l where bare like '%10.1234%' group by 1""")
def doi_list(spark, sf_dir):
    """SC26, X13, ST2: distinct DOIs of a list with comments and bad lines."""
    return corpus.doi_lines(_doi_lines(spark, sf_dir), "pos")[0]


@query(rf"""with l as (select p_partkey as pos, trim(split_part({_DOI_LINE}, '#', 1)) as bare from part) select pos, bare as line from l where bare <> '' and bare not like '%10.1234%'""")
def doi_rejects(spark, sf_dir):
    """SC26: lines of the list that hold no DOI."""
    return corpus.doi_lines(_doi_lines(spark, sf_dir), "pos")[1]


@query(
    r"""select o_orderkey, case when o_orderkey % 3 = 2 then null else c_custkey::varchar end as slug from orders join customer on o_custkey = c_custkey"""
)
def article_resolve(spark, sf_dir):
    """SC2: articles asked for by DOI, by path, and by names that none has."""
    a = read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("slug"), F.concat(F.lit("10.5555/c"), "c_custkey").alias("doi"))
    k = F.col("o_orderkey")
    w = read(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 3 == 0, F.concat(F.lit("doi:10.5555/C"), "o_custkey")).when(k % 3 == 1, F.concat(F.lit("corpus/"), "o_custkey", F.lit("/"))).otherwise(F.concat(F.lit("x"), "o_custkey")).alias("wanted"))
    return corpus.resolved(w, a).select("o_orderkey", "slug")


@query(r"""select p_partkey, regexp_extract('corpus/' || p_partkey || '/manifest.json', 'corpus/([^/]+)/', 1) as slug from part where p_size % 2 = 0""")
def article_dirs(spark, sf_dir):
    """SC1: folders that hold a manifest."""
    k = F.col("p_partkey").cast("string")
    files = read(spark, sf_dir, "part").select(F.explode(F.array(F.concat(F.lit("corpus/"), k, F.lit("/paper.pdf")), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("corpus/"), k, F.lit("/manifest.json"))))).alias("path"))
    return corpus.article_dirs(files).select(F.col("slug").cast("long").alias("p_partkey"), "slug")


@query(r"""select c_custkey, c_acctbal from customer order by c_acctbal desc, c_custkey limit 20""")
def largest_first(spark, sf_dir):
    """S3: the 20 largest; the limit is what is asked for."""
    return corpus.listing(read(spark, sf_dir, "customer"), 20, size="c_acctbal", name="c_custkey").select("c_custkey", "c_acctbal")


@query(r"""with e as (select user_id, event_id, event_type from events where event_type <> 'view' qualify row_number() over (partition by user_id order by event_id) <= 3) select * from e""")
def sample_rows(spark, sf_dir):
    """The first three rows of a user that hold a value."""
    e = read(spark, sf_dir, "events").withColumn("cells", F.array(F.lit("  "), F.when(F.col("event_type") != "view", F.col("event_type"))))
    return corpus.first_rows(e, ["user_id"], "event_id", "cells").select("user_id", "event_id", "event_type")


@query(r"""select min(page_id) as page_id, split_part(url, '#', 1) as url from pages group by 2""")
def link_dedupe(spark, sf_dir):
    """ST6: addresses that differ in their fragment only, as links of one page."""
    p = read(spark, sf_dir, "pages").withColumn("link", F.explode(F.array("url", F.concat("url", F.lit("#part"))))).withColumn("group", F.lit(1))
    return corpus.distinct_links(p, "group", "page_id", "link").select("page_id", T.url_without_fragment(F.col("link")).alias("url"))


@query(r"""select distinct l_partkey as part from lineitem where l_partkey not in (select l_partkey from lineitem where l_returnflag = 'R' and l_quantity > 48)""")
def spec_lost(spark, sf_dir):
    """ST7: parts that a list of returned ones would lose."""
    li = read(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "part")
    return corpus.lost(li, li.where("l_returnflag = 'R' and l_quantity > 48"), "part")


@query(
    r"""select l_orderkey, l_linenumber, case when l_linenumber = 4 then 'no_path' when o_orderkey is null then 'missing' else 'ok' end as status from lineitem left join (select o_orderkey from orders where o_orderstatus = 'F') on o_orderkey = l_orderkey and l_linenumber % 2 = 1"""
)
def files_on_disk(spark, sf_dir):
    """Lines as manifest entries, some without a path, against files of finished orders."""
    e = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_orderkey").alias("slug"), F.when(F.col("l_linenumber") != 4, F.col("l_linenumber").cast("string")).alias("path"))
    o = read(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    f = o.select(F.col("o_orderkey").alias("slug"), F.explode(F.array(*(F.lit(str(i)) for i in (1, 3, 5, 7)))).alias("path"), F.lit(10).alias("bytes"))
    return corpus.on_disk(e, f).select("l_orderkey", "l_linenumber", "status")


@query(r"""select o_orderkey, case when o_orderkey % 2 = 0 then '10.1038/s' || o_custkey end as doi from orders""")
def corrected_article(spark, sf_dir):
    """The DOI in the first notice relation that has one."""
    o = read(spark, sf_dir, "orders")
    ref = F.concat(F.lit("Nature. 2025. doi: 10.1038/S"), "o_custkey", F.lit("."))
    r = F.array(F.struct(F.lit("Erratum in").alias("type"), F.lit("doi: 10.1038/other.").alias("reference")), F.struct(F.lit("Retraction of").alias("type"), F.lit("no identifier").alias("reference")), F.struct(F.when(F.col("o_orderkey") % 2 == 0, " Erratum for ").otherwise("Comment on").alias("type"), ref.alias("reference")))
    return o.select("o_orderkey", corpus.corrected_doi(r).alias("doi"))


@query(r"""select page_id, case when page_id % 3 = 0 then url when page_id % 3 = 1 then url || ',' || url || '/b' else '' end as urls from pages""")
def open_pdf_urls(spark, sf_dir):
    """Open PDF addresses among a page's."""
    k = F.col("page_id")
    s = lambda style, code, url: F.struct(F.lit(style).alias("style"), F.lit(code).alias("code"), url.alias("url"))
    u, b = F.col("url"), F.concat("url", F.lit("/b"))
    e = F.when(k % 3 == 0, F.array(s("PDF", "oa", u), s("html", "OA", b), s("pdf", "S", b))).when(k % 3 == 1, F.array(s("pdf", "F", u), s("pdf", "OA", b))).otherwise(F.array(s("doi", "OA", u), s("pdf", "OA", F.lit(""))))
    return read(spark, sf_dir, "pages").select("page_id", F.array_join(corpus.open_urls(e), ",").alias("urls"))


@query(r"""select user_id, bool_or(event_type = 'error' and value < 50) as expired from events group by 1""")
def expired_sessions(spark, sf_dir):
    """Users with an attempt that found the session expired."""
    a = F.struct(F.when(F.col("event_type") == "error", "proxy_browser").otherwise("open").alias("tier"), F.when(F.col("value") < 50, "session_expired").otherwise("ok").alias("status"))
    return read(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_list(a).alias("attempts")).select("user_id", corpus.session_expired(F.col("attempts")).alias("expired"))


@query(r"""select doc_id, doc_id % 3 = 1 as pdf, case when doc_id % 5 = 0 then 'author_manuscript' else 'published' end as rendition, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') as squashed from documents""")
def renditions(spark, sf_dir):
    """Magic bytes behind white space, marks of manuscripts, letters and digits of documents."""
    d, k = read(spark, sf_dir, "documents"), F.col("doc_id")
    opening = F.concat(F.when(k % 5 == 0, F.lit("Published in final edited form as: ")).otherwise(F.lit("")), F.col("text"))
    content = F.concat(F.when(k % 3 == 1, F.lit(" \n%PDF-1.7 ")).otherwise(F.lit("<html>%PDF")), F.col("text")).cast("binary")
    return d.select("doc_id", corpus.looks_like_pdf(content).alias("pdf"), corpus.rendition(opening).alias("rendition"), corpus.alnum(F.col("text")).alias("squashed"))


@query(
    r"""select l_orderkey, l_linenumber, row_number() over (partition by l_orderkey order by l_linenumber, l_shipmode) as index, 'supplementary/' || lpad((row_number() over (partition by l_orderkey order by l_linenumber, l_shipmode))::varchar, 2, '0') || '_' || regexp_replace(l_shipmode || ' file.xlsx', '[^A-Za-z0-9._-]+', '_', 'g') as path,
 length(l_shipmode)::int as bytes, sha256(l_shipmode) as sha256 from (select l_orderkey, l_linenumber, l_returnflag || '/' || l_linestatus as l_shipmode0, l_returnflag || l_linestatus as l_shipmode from lineitem)"""
)
def stored_entries(spark, sf_dir):
    """C27, SK4, X14: an order's lines as stored files."""
    mode = F.concat("l_returnflag", "l_linestatus")
    f = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.struct("l_linenumber", mode).alias("pos"), F.concat(F.lit("a/"), mode, F.lit(" file.xlsx")).alias("name"), mode.cast("binary").alias("content"))
    return corpus.stored_entries(f, "l_orderkey", "pos", "name").select("l_orderkey", "l_linenumber", "index", "path", "bytes", "sha256")


@query(
    r"""with m as (select source as slug, doc_id, row_number() over (partition by source order by lang <> 'en', case when lang <> 'en' then lang end, doc_id) - 1 as index from documents) select slug, doc_id, index::int as index from m"""
)
def blocks_in_order(spark, sf_dir):
    """ST5: English documents as main text, then the other languages as files."""
    d = read(spark, sf_dir, "documents").select(F.col("source").alias("slug"), "doc_id", F.col("doc_id").alias("index"), "lang")
    no = F.when(F.col("lang") == "de", 0).when(F.col("lang") == "es", 1).otherwise(2)
    return corpus.in_file_order(d.where("lang = 'en'"), d.where("lang <> 'en'").withColumn("file_no", no)).select("slug", "doc_id", "index")


@query(
    r"""with f as (select l_orderkey as slug, count(distinct l_linenumber) as n, count(distinct l_linenumber) filter (where l_returnflag <> 'R') as held from lineitem group by 1), o as (select o_orderkey, o_orderstatus, n, held from orders join f on slug = o_orderkey)
select o_orderkey as slug, 'pdf_present' as check, o_orderstatus = 'F' as ok from o where o_orderkey % 2 = 0 union all select o_orderkey, 'pdf_present', null from o where o_orderkey % 2 = 1
union all select o_orderkey, 'supplementary_status', o_orderstatus = 'F' from o union all select o_orderkey, 'supplements_matched', n = held from o union all select o_orderkey, 'supplements_extra', null from o"""
)
def ground_truth(spark, sf_dir):
    """Orders checked against what their lines should have brought."""
    li = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("slug"), F.sha2(F.concat_ws("-", "l_orderkey", "l_linenumber"), 256).alias("sha256"), F.col("l_linenumber").cast("string").alias("file"), "l_returnflag")
    files = li.groupBy("slug").agg(F.collect_list(F.struct("file", "sha256", F.array().cast("array<string>").alias("members"))).alias("files"))
    o = read(spark, sf_dir, "orders").withColumn("slug", F.col("o_orderkey"))
    spec = o.select("slug", (F.col("o_orderkey") % 2 == 0).alias("has_pdf"), F.lit("F").alias("expected_status")).join(files, "slug")
    rec = o.select("slug", (F.col("o_orderstatus") == "F").alias("pdf_ok"), F.col("o_orderstatus").alias("status"))
    return corpus.checked(spec, rec, li.where("l_returnflag <> 'R'").select("slug", "sha256")).select("slug", "check", "ok")


@query(r"""with e as (select user_id, count(*) filter (where value < 2) as open, count(*) as n from events group by 1) select user_id as slug, n as accessions from e where open = 0""")
def label_split(spark, sf_dir):
    """SK7: users whose answers are all given."""
    a = read(spark, sf_dir, "events").select(F.col("user_id").alias("slug"), F.col("event_id").alias("pos"), F.col("event_type").alias("accession"), F.when(F.col("value") >= 2, "own").alias("role"))
    return corpus.label_split(a)[0].select("slug", F.size("accessions").cast("long").alias("accessions"))


@query(
    r"""select 'n' || c_nationkey as sheet, 0 as header_row, 'high' as header_confidence, 'Customer|Segment|Balance' as header, 3 as n_columns, count(*) as n_rows, count(distinct lower(c_mktsegment)) as segments, min(c_acctbal) as low, max(c_acctbal) as high, 2::bigint as first_data_row, count(*) + 1 as last_data_row
 from customer group by c_nationkey"""
)
def card_build(spark, sf_dir):
    """C1, C2, W3, W11, A1, S5, ST8: a card per nation's sheet of customers."""
    c = cards.cards(_customer_sheets(spark, sf_dir))
    col = lambda i: F.get("columns", F.lit(i))
    return c.select(
        "sheet", "header_row", "header_confidence", F.array_join("header", "|").alias("header"), "n_columns", "n_rows", col(1)["n_unique"].alias("segments"), col(2)["min"].alias("low"), col(2)["max"].alias("high"),
        F.col("data_ref.first_data_row").cast("long").alias("first_data_row"), F.col("data_ref.last_data_row").cast("long").alias("last_data_row"),
    )


def _customer_sheets(spark, sf_dir):
    """Customers as sheets of their nations: a header, then rows in order of key."""
    from pyspark.sql import Window

    c = read(spark, sf_dir, "customer").withColumn("n", F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")))
    body = c.select(F.concat(F.lit("n"), "c_nationkey").alias("sheet"), F.col("n").alias("row_no"), F.array("c_name", "c_mktsegment", F.col("c_acctbal").cast("string")).alias("cells"))
    head = c.select(F.concat(F.lit("n"), "c_nationkey").alias("sheet")).distinct().select("sheet", F.lit(0).alias("row_no"), F.array(F.lit("Customer"), F.lit("Segment"), F.lit("Balance")).alias("cells"))
    return head.unionByName(body).withColumn("source_file", F.lit("customers.xlsx"))


@query(
    r"""with c as (select c_nationkey, c_name, c_mktsegment, row_number() over (partition by c_nationkey order by c_custkey) + 1 as row from customer)
select 'n' || c_nationkey as sheet, row, c_name || '|' || c_mktsegment as cells, false as is_header from c where row <= 21 union all select distinct 'n' || c_nationkey, 1, 'Customer|Segment', true from customer"""
)
def card_rows(spark, sf_dir):
    """SC20: header and first 20 rows behind each card."""
    s = _customer_sheets(spark, sf_dir)
    return cards.rows_behind(cards.cards(s), s).select("sheet", F.col("row").cast("long").alias("row"), F.array_join(F.slice("cells", 1, 2), "|").alias("cells"), "is_header")


@query(r"""select doc_id, len(regexp_extract_all(text || '-' || chr(10) || 'Next', '[0-9]-\s*\n|-\s*\n\s*[0-9A-ZÀ-ÖØ-Þ]')) as kept, len(regexp_extract_all(text || '-' || chr(10) || 'Next', '\p{L}-\s*\n\s*\p{Ll}')) as joined from documents""")
def hyphen_tallies(spark, sf_dir):
    """Hyphens at line ends that stay or go, the text's last one before a capital."""
    t = F.concat("text", F.lit("-\nNext"))
    return read(spark, sf_dir, "documents").select("doc_id", corpus.hyphen_tallies(t).alias("h")).select("doc_id", F.col("h.kept").cast("long").alias("kept"), F.col("h.joined").cast("long").alias("joined"))


@query(r"""select doc_id, text from documents where coalesce(case lang when 'en' then 'methods' when 'de' then 'references' end, '') <> 'references'""")
def candidate_blocks(spark, sf_dir):
    """C14: blocks outside of reference lists."""
    d = read(spark, sf_dir, "documents").withColumn("section", F.when(F.col("lang") == "en", "methods").when(F.col("lang") == "de", "references"))
    return corpus.candidates_outside(d).select("doc_id", "text")


# Queries of operators that other modules hold.


@query(
    r"""with p as (select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title, url from pages)
select page_id, case when page_id % 4 = 0 then 'pub_types' when page_id % 4 = 1 then 'article_type' when page_id % 4 = 2 then 'title' end as why from p"""
)
def not_research(spark, sf_dir):
    """FL11: the signal that says a page is no research article."""
    k, title = F.col("page_id"), F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    types = F.when(k % 4 == 0, F.array(F.lit("Journal Article"), F.lit(" Published Erratum "))).otherwise(F.array(F.lit("Journal Article")))
    return read(spark, sf_dir, "pages").select("page_id", fetch.not_research(F.when(k % 4 == 1, " Correction ").otherwise("research-article"), F.when(k % 4 == 2, F.concat(F.lit("Author Correction: "), title)).otherwise(title), types).alias("why"))


@query(
    r"""with m as (select l_orderkey, l_linenumber, case l_linenumber % 4 when 0 then 'f' || l_linenumber || '.jpg' when 1 then repeat('x', 8 - l_linenumber) || '.pdf' when 2 then 'a.nxml' else 'b.xlsx' end as name from lineitem)
select l_orderkey, l_linenumber, case when name like '%.jpg' then 'media' when name like '%.nxml' then 'xml' when name like '%.pdf' and row_number() over (partition by l_orderkey, name like '%.pdf' order by length(name), name) = 1 then 'fulltext' else 'supplement' end as part from m"""
)
def package_split(spark, sf_dir):
    """FL21: lines as members of a package."""
    n = F.col("l_linenumber").cast("int")
    name = F.when(n % 4 == 0, F.concat(F.lit("f"), n.cast("string"), F.lit(".jpg"))).when(n % 4 == 1, F.concat(F.repeat(F.lit("x"), 8 - n), F.lit(".pdf"))).when(n % 4 == 2, "a.nxml").otherwise("b.xlsx")
    return fetch.split_package(read(spark, sf_dir, "lineitem").withColumn("name", name), "l_orderkey").select("l_orderkey", "l_linenumber", "part")


def _re2(pattern: str) -> str:
    return pattern.replace("'", "''")


_HEADINGS = "when ".join(f"regexp_matches(line, '^\\s*{_re2(T.HEADING_PREFIX)}(?:{_re2(body)})\\s*[:.]?\\s*$', 'i') then '{name}' " for name, body in T.ALIASES)


@query(
    rf"""with l as (select doc_id, case doc_id % 6 when 0 then '2. Materials and Methods' when 1 then ' RESULTS: ' when 2 then 'Data availability statement' when 3 then 'Literature Cited' when 4 then left(text, 30) else 'IV) Online methods' end as heading from documents),
n as (select doc_id, trim(regexp_replace(heading, '\s+', ' ', 'g')) as line from l) select doc_id, case when line = '' or length(line) > 120 then null when {_HEADINGS} end as section from n"""
)
def heading_sections(spark, sf_dir):
    """Sections that headings name."""
    k = F.col("doc_id") % 6
    h = F.when(k == 0, "2. Materials and Methods").when(k == 1, " RESULTS: ").when(k == 2, "Data availability statement").when(k == 3, "Literature Cited").when(k == 4, F.left("text", F.lit(30))).otherwise("IV) Online methods")
    return read(spark, sf_dir, "documents").select("doc_id", T.section_of_heading(h).alias("section"))


@query(
    r"""with d as (select doc_id, 'See https://doi.org/10.1234/A' || doc_id || '. and 10.9999/same, again 10.9999/same;' as t from documents)
select doc_id, '10.1234/a' || doc_id as doi, '10.1234_a' || doc_id as slug, '10.9999/same' as cited from d"""
)
def doi_functions(spark, sf_dir):
    """DOIs normalised, as names of files, and cited ones without the own."""
    t = F.concat(F.lit("See https://doi.org/10.1234/A"), F.col("doc_id"), F.lit(". and 10.9999/same, again 10.9999/same;"))
    own = T.normalized_doi(F.concat(F.lit(" doi:10.1234/A"), F.col("doc_id"), F.lit(".")))
    return read(spark, sf_dir, "documents").select("doc_id", own.alias("doi"), T.doi_slug(own).alias("slug"), F.array_join(T.cited_dois(t, own), ",").alias("cited"))


@query(r"""select c_custkey, c_mktsegment = 'BUILDING' as tri from customer where c_mktsegment in ('BUILDING', 'MACHINERY') union all select c_custkey, null from customer where c_mktsegment not in ('BUILDING', 'MACHINERY')""")
def tri_states(spark, sf_dir):
    """Y and N as booleans, all else unknown."""
    s = F.col("c_mktsegment")
    return read(spark, sf_dir, "customer").select("c_custkey", T.tri_state(F.when(s == "BUILDING", " y ").when(s == "MACHINERY", "N").otherwise(s)).alias("tri"))


@query(r"""select l_orderkey as slug, sum(l_quantity::bigint)::bigint as bytes, count(*) as files from lineitem group by 1""")
def corpus_usage(spark, sf_dir):
    """Bytes and files per article."""
    return fetch.usage(read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("slug"), F.col("l_quantity").cast("long").alias("bytes")))


@query(r"""select event_type as url, min(event_id) as first_at, count(*) as mentions, count(*) > 1 as repeated from events group by 1""")
def distinct_in_order(spark, sf_dir):
    """ST2: distinct values with first place and mentions."""
    from quiremill.operators import blocks

    return blocks.distinct_in_order(read(spark, sf_dir, "events").withColumnRenamed("event_type", "url"), "url", "event_id")


@query(r"""select o_orderkey, 'label ' || o_custkey as label from orders where o_orderkey % 2 = 0 union all select o_orderkey, null from orders where o_orderkey % 2 = 1""")
def caption_labels(spark, sf_dir):
    """What stands before a caption's first stop, if short."""
    cap = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit(" label "), "o_custkey", F.lit(". More."))).otherwise(F.repeat(F.lit("long caption "), 5))
    return read(spark, sf_dir, "orders").select("o_orderkey", T.label_of_caption(cap).alias("label"))


@query(
    r"""select user_id as slug, event_type as kind, max(event_id) as last, count(*) as n from events group by all"""
)
def last_by_kind(spark, sf_dir):
    """The last answer of each kind with the number of answers."""
    a = review.latest(read(spark, sf_dir, "events").withColumnRenamed("user_id", "slug").withColumnRenamed("event_type", "kind"), ["slug", "kind"], "event_id")
    return a.select("slug", "kind", F.col("event_id").alias("last"), (F.col("replaced") + 1).alias("n"))
