"""Queries over documents, benchmark, conversations and pages: blocks, layout, finding, verifying, auditing."""

from __future__ import annotations

from pyspark.sql import functions as F

from quiremill.functions import quotes as Q
from quiremill.functions import text as T
from quiremill.operators import audit, blocks, fetch, layout, select
from quiremill.sources.tables import read

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


#: Lines of documents as DuckDB sees them; position counts from 0.
LINES = r"""lines as (select doc_id, pos, text from (select doc_id, unnest(string_split(text, chr(10))) as text, unnest(range(len(string_split(text, chr(10))))) as pos from documents) where trim(text) <> '')"""


def doc_blocks(spark, sf_dir):
    return blocks.lines_as_blocks(read(spark, sf_dir, "documents"))


@query(
    rf"""with {LINES}, n as (select doc_id, pos, text, row_number() over (partition by doc_id order by pos) - 1 as index, sha256(text) as text_sha256 from lines)
select doc_id as slug, index::int as index, text_sha256, length(text)::int as chars,
  left(sha256('main_text' || chr(0) || 'txt' || chr(0) || 'text' || chr(0) || 'line ' || pos || chr(0) || 'paragraph' || chr(0) || text_sha256 || chr(0) || '0'), 16) as block_id from n"""
)
def blocks_number(spark, sf_dir):
    """Index, digest and identity of every line."""
    return blocks.numbered(doc_blocks(spark, sf_dir)).select("slug", "index", "text_sha256", "chars", "block_id")


def _as_sectioned(spark, sf_dir):
    """Documents as blocks of their source: the language stands for the section, French for none."""
    d = read(spark, sf_dir, "documents").withColumn("section", F.when(F.col("lang") != "fr", F.col("lang")))
    return d.select(F.col("source").alias("slug"), F.col("doc_id").alias("index"), F.col("doc_id").cast("string").alias("block_id"), F.when(F.col("doc_id") % 7 == 0, "table").otherwise("paragraph").alias("kind"), F.lit("main_text").alias("role"), F.col("source").alias("source_file"), "section", F.length("text").alias("chars"), "text")


@query(r"""select source as slug, doc_id as index from documents where lang not in ('de') and contains(lower(text), 'licensed') and contains(source, 'src1')""")
def blocks_filter(spark, sf_dir):
    """FL1: files, text and excluded sections; a null section stays."""
    return blocks.filtered(_as_sectioned(spark, sf_dir), files=["src1"], contains="Licensed", exclude_sections=["de"]).select("slug", "index")


@query(r"""select source as slug, doc_id as index, row_number() over (partition by source order by case when lang = 'en' then 0 when lang = 'fr' then 1 else 2 end, doc_id) as place from documents""")
def prefer_rank(spark, sf_dir):
    """Asked section, none, others."""
    from pyspark.sql import Window

    b = _as_sectioned(spark, sf_dir).withColumn("rank", blocks.preference(["en"]))
    return b.select("slug", "index", F.row_number().over(Window.partitionBy("slug").orderBy("rank", "index")).cast("long").alias("place"))


@query(
    r"""with recursive b as (select source as slug, doc_id, length(text)::bigint as chars, doc_id % 7 = 0 as is_table, row_number() over (partition by source order by doc_id) as n from documents),
w as (select slug, n, case when chars <= 60000 and (not is_table or true) then chars else 0 end as used, (chars <= 60000)::int as kept from b where n = 1
  union all select b.slug, b.n, w.used + case when w.used + b.chars <= 60000 and (not b.is_table or 60000 - w.used >= 400) then b.chars else 0 end,
    w.kept + (w.used + b.chars <= 60000 and (not b.is_table or 60000 - w.used >= 400))::int from w join b on b.slug = w.slug and b.n = w.n + 1)
select slug, max(n)::bigint as considered, arg_max(used, n) as used, arg_max(kept, n)::bigint as n_kept from w group by slug"""
)
def pack_greedy(spark, sf_dir):
    """A greedy pack per source."""
    p = blocks.packed(_as_sectioned(spark, sf_dir))
    return p.select("slug", F.col("considered").cast("long").alias("considered"), "used", "n_kept")


@query(r"""select source, text_md5 as digest, min(doc_id) as kept, count(*) as copies from (select source, md5(text) as text_md5, doc_id from documents) group by all""")
def first_kept(spark, sf_dir):
    """ST1: the first document of each (source, text)."""
    d = read(spark, sf_dir, "documents").withColumn("digest", F.md5("text"))
    return blocks.first_kept(d, ["source", "digest"], "doc_id").select("source", "digest", F.col("doc_id").alias("kept"), "copies")


@query(rf"""with {LINES} select text, count(distinct doc_id) as pages from lines where length(text) <= 100 group by text having count(distinct doc_id) >= 3""")
def running_lines(spark, sf_dir):
    """Short lines that many documents share."""
    b = doc_blocks(spark, sf_dir).select(F.lit("corpus").alias("slug"), F.col("slug").alias("page"), "text")
    return layout.running_lines(b).select("text", "pages")


@query(
    rf"""with {LINES}, r as (select text from lines where length(text) <= 100 group by text having count(distinct doc_id) >= 3)
select doc_id as slug, count(*) as considered, count(*) filter (where r.text is not null) as furniture from lines left join r using (text) group by doc_id"""
)
def drop_furniture(spark, sf_dir):
    """Lines per document and how many of them are furniture."""
    b = doc_blocks(spark, sf_dir).select(F.lit("corpus").alias("corpus"), "slug", F.col("slug").alias("page"), "text")
    out = layout.without_furniture(b, layout.running_lines(b, group="corpus"), group="corpus")
    return out.groupBy("slug").agg(F.count(F.lit(1)).alias("considered"), F.count_if(F.col("dropped_as") == "furniture").alias("furniture"))




@query(
    rf"""with {LINES}, h as (select doc_id, pos, text, case when regexp_full_match(text, '[^ ]{{1,14}}') then case when starts_with(lower(text), 'th') then 'abstract' when starts_with(lower(text), 'o') then 'methods'
   when starts_with(lower(text), 'e') then 'references' else 'results' end end as h from lines),
r as (select *, sum((h is not null)::int) over (partition by doc_id order by pos rows unbounded preceding) as run from h),
s as (select *, first_value(h) over (partition by doc_id, run order by pos) as sec, first_value(pos) over (partition by doc_id, run order by pos) as rs,
   coalesce(sum(case when h is null then length(text) else 0 end) over (partition by doc_id, run order by pos rows between unbounded preceding and 1 preceding), 0) as before from r),
o as (select *, h is null and coalesce(sec = 'abstract', false) and before > 600 as over from s),
a as (select *, min(case when over then pos end) over (partition by doc_id, sec) as ab from o)
select doc_id as slug, pos, case when sec is null or rs > ab or over or (sec = 'references' and h is null and not regexp_matches(text, '^\s*[0-9]{{1,4}}\s*[.)]\s+\S|\([0-9]{{4}}[a-z]?\)|\bet\s+al\b|\bdoi\s*:|doi\.org/', 'i')) then null else sec end as carried from a"""
)
def section_carry(spark, sf_dir):
    """Sections carried forward from one-word lines."""
    from quiremill.limits import Limits

    low = F.lower("text")
    name = F.when(low.startswith("th"), "abstract").when(low.startswith("o"), "methods").when(low.startswith("e"), "references").otherwise("results")
    head = F.col("text").rlike(r"^[^ ]{1,14}$")
    b = doc_blocks(spark, sf_dir).withColumn("kind", F.when(head, "heading").otherwise("paragraph")).withColumn("section", F.when(head, name))
    return layout.carried_sections(b, Limits(max_bounded_section_chars=600), order="pos").select("slug", "pos", "carried")


_WORDS = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
_SHINGLES = "list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))"


@query(rf"""with b as (select item_id, {_WORDS} as w from benchmark), s as (select item_id, unnest({_SHINGLES}) as shingle from b where len(w) >= 8) select shingle, min(item_id) as item_id from s group by shingle having count(distinct item_id) = 1""")
def shingle_index(spark, sf_dir):
    """8-word shingles that one benchmark item alone has."""
    return audit.shingle_index(read(spark, sf_dir, "benchmark"), "item_id", [])


@query(
    rf"""with b as (select item_id, {_WORDS} as w from benchmark), s as (select item_id, unnest({_SHINGLES}) as shingle from b where len(w) >= 8),
ix as (select shingle, min(item_id) as item_id from s group by shingle having count(distinct item_id) = 1),
d as (select doc_id, {_WORDS} as w from documents), ds as (select doc_id, unnest({_SHINGLES}) as shingle, unnest(range(len(w) - 7)) as pos from d where len(w) >= 8),
v as (select doc_id, item_id, count(*) as votes, min(pos) as first from ds join ix using (shingle) group by all)
select doc_id, arg_max(item_id, (votes, -first)) as item_id, max(votes)::bigint as votes, sum(votes)::bigint as shared from v group by doc_id"""
)
def shingle_align(spark, sf_dir):
    """The benchmark item that most of a document's shingles vote for."""
    ix = audit.shingle_index(read(spark, sf_dir, "benchmark"), "item_id", [])
    return audit.voted(read(spark, sf_dir, "documents"), ix, "item_id", ["doc_id"], []).select("doc_id", "item_id", "votes", "shared")


@query(
    r"""with q as (select item_id, doc_id, text from (select item_id, b.text as quote, doc_id, d.text from benchmark b, documents d where contains(d.text, b.text))),
b as (select q.item_id, q.doc_id, instr(q.text, bm.text) - 1 as pos, q.text from q join benchmark bm using (item_id))
select item_id, doc_id, pos::bigint as pos, (len(string_split(left(text, pos), chr(10))) - 1)::bigint as line, 'exact' as verdict from b"""
)
def quote_verify_exact(spark, sf_dir):
    """Benchmark texts as quotes against all documents: where each is found and in which line.

    Three tokens from inside a quote are joined to documents' runs of three tokens, which leaves few pairs to compare in full.
    """
    b, d = read(spark, sf_dir, "benchmark"), read(spark, sf_dir, "documents")
    # A token strictly inside a quote is a whole token of every text that holds the quote; three of them in a row make the key.
    tokens = lambda c: F.regexp_extract_all(c, F.lit(r"\S+"), F.lit(0))
    inner = F.slice(tokens(F.col("quote")), 2, 3)
    asked = b.select("item_id", F.col("text").alias("quote")).withColumn("key", F.when(F.size(tokens(F.col("quote"))) >= 5, F.array_join(inner, " ")))
    t = F.col("_tokens")
    keys = F.when(F.size(t) >= 3, F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(t) - 2), lambda i: F.array_join(F.slice(t, i, 3), " "))))
    hits = d.select("doc_id", tokens(F.col("text")).alias("_tokens")).select("doc_id", F.explode(keys).alias("key")).join(asked.where("key is not null").select("item_id", "key"), "key").select("item_id", "doc_id").distinct()
    short = asked.where("key is null")
    pairs = hits.join(asked.select("item_id", "quote"), "item_id").join(d.select("doc_id", "text"), "doc_id")
    if short.take(1):  # a few words: nothing to join on
        pairs = pairs.select("item_id", "doc_id", "quote", "text").unionByName(d.join(short, F.contains(d["text"], short["quote"])).select("item_id", "doc_id", "quote", "text"))
    found = pairs.where(F.contains("text", "quote")).withColumn("pos", (F.instr("text", F.col("quote")) - 1).cast("long"))
    line = (F.size(F.split(F.left("text", F.col("pos").cast("int")), "\n")) - 1).cast("long")
    return found.select("item_id", "doc_id", "pos", line.alias("line"), F.lit("exact").alias("verdict"))


@query()
def quote_verify_next_turn(spark, sf_dir):
    """The start of each turn against the next one, by the cheap levels. No SQL: DuckDB has no NFKC; tests/test_whole_texts.py holds all turns against brute force."""
    c = read(spark, sf_dir, "conversations")
    q = c.select("conv_id", "turn", F.substring("text", 3, 60).alias("quote"))
    j = q.join(c.select("conv_id", (F.col("turn") - 1).alias("turn"), "text"), ["conv_id", "turn"], "left")
    v = F.when(F.col("text").isNull(), "no_such_block").otherwise(Q.cheap_verdict(F.col("quote"), F.col("text")))
    return j.select("conv_id", "turn", v.alias("verdict"))


@query()
def quote_verify_ladder(spark, sf_dir):
    """All levels, the fuzzy one and the sweep over other blocks: turns quoted with typing errors under right, wrong and unknown blocks. Rows only: SQL has no difflib."""
    c = read(spark, sf_dir, "conversations")
    b = c.select(F.col("conv_id").alias("slug"), F.col("turn").cast("string").alias("block_id"), F.col("turn").alias("index"), "text")
    typed = F.concat(F.substring("text", 1, 50), F.when(F.col("turn") % 2 == 0, F.lit("x")).otherwise(F.lit("")), F.substring("text", 51, 60))
    named = F.when(F.col("turn") % 3 == 2, F.lit("none")).when(F.col("turn") % 5 == 4, F.lit("0")).otherwise(F.col("turn").cast("string"))
    claims = c.select(F.col("conv_id").alias("slug"), F.col("turn").cast("string").alias("claim_id"), F.lit(0).alias("n"), named.alias("block_id"), typed.alias("quote"))
    v = select.verified_quotes(claims, b)
    return v.select("slug", "claim_id", "verdict", "found_in", F.round("coverage", 4).alias("coverage"), F.round("longest_run", 4).alias("longest_run"))


_PATTERNS = [("mail", r"[A-Za-z0-9._]+@[a-z0-9.]+[a-z]", "study"), ("license", r"Licensed|Released", "study"), ("ip", r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}", "sample")]


# \b of RE2 knows ASCII words only. A letter or number beyond ASCII becomes A, a mark, a: no hit ends before the A, and the mark takes what follows in the word out of the search.
@query(
    r"""with t as (select doc_id, regexp_replace(replace(text, chr(1), chr(2)), '[^\x00-\x7F\P{L}]|[^\x00-\x7F\P{N}]', 'A' || chr(1) || 'a', 'g') as text from documents),
h as (select doc_id, unnest(regexp_extract_all(text, '(\x01[A-Za-z0-9_]+|\b(?:[A-Za-z0-9._]+@[a-z0-9.]+[a-z])\b|\b(?:Licensed|Released)\b|\b(?:[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})\b)')) as accession from t)
select doc_id as slug, accession, case when contains(accession, '@') then 'mail' when accession in ('Licensed', 'Released') then 'license' else 'ip' end as repository, count(*) as n from h where not starts_with(accession, chr(1)) group by all"""
)
def finder_mentions(spark, sf_dir):
    """Hits of a pattern table in all documents, counted per document."""
    d = read(spark, sf_dir, "documents")
    b = d.select(F.col("doc_id").alias("slug"), F.lit(0).alias("index"), F.col("doc_id").cast("string").alias("block_id"), F.lit(None).cast("string").alias("section"), F.lit("paragraph").alias("kind"), "text")
    return select.mentions(b, _PATTERNS).groupBy("slug", "accession", "repository").agg(F.count(F.lit(1)).alias("n"))


@query()
def finder_candidates(spark, sf_dir):
    """A2, A3, X11: candidates with sentences and places. Rows only: the sentence walk has no short SQL form."""
    b = doc_blocks(spark, sf_dir).select("slug", F.col("pos").alias("index"), F.col("locator").alias("block_id"), F.lit(None).cast("string").alias("section"), "kind", "text")
    c = select.candidates(select.mentions(b, _PATTERNS))
    return c.select("slug", "accession", "level", F.size("mentions").alias("n"), F.col("first.index").alias("first_index"), F.get("mentions", F.lit(0))["sentence"].alias("sentence"))


@query(
    r"""with p as (select doc_id, source, contains(lower(text), 'worthless') or contains(lower(text), 'pathetic') or contains(lower(text), 'disgusting') as predicted from documents),
t as (select p.source, count(*) filter (where predicted and toxic = 1) as hits, count(*) filter (where predicted) as predicted, count(*) filter (where toxic = 1) as truth from p join labels using (doc_id) group by source)
select count(*) as articles, sum(hits)::bigint as hits, sum(predicted)::bigint as predicted, sum(truth)::bigint as truth, sum(predicted - hits)::bigint as false_positives,
  sum(hits) / nullif(sum(predicted), 0)::double as precision, sum(hits) / nullif(sum(truth), 0)::double as recall from t"""
)
def score_micro(spark, sf_dir):
    """A4, ST3, J7: toxic words as a predictor of toxic labels, per source, summed before dividing."""
    low = F.lower("text")
    d = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id").withColumn("hit", F.contains(low, F.lit("worthless")) | F.contains(low, F.lit("pathetic")) | F.contains(low, F.lit("disgusting")))
    acc = F.struct(F.col("doc_id").cast("string").alias("accession"), F.when(F.col("toxic") == 1, "own").otherwise("reused").alias("role"))
    g = d.groupBy(F.col("source").alias("slug")).agg(F.array_compact(F.collect_list(F.when(F.col("hit"), F.col("doc_id").cast("string")))).alias("predicted"), F.collect_list(acc).alias("accessions")).withColumn("complete", F.lit(True))
    s = select.score(select.scores_per_article(g.select("slug", "predicted"), g.select("slug", "complete", "accessions")))
    return s.select("articles", *(F.col(c).cast("long").alias(c) for c in ("hits", "predicted", "truth", "false_positives")), "precision", "recall")


@query(
    r"""with p as (select source as slug, case when quality = 1 then 'good' else 'bad' end as reference, case when contains(text, '###') or contains(text, '!!') or contains(text, ' | ') then 'bad' else 'good' end as candidate from documents join labels using (doc_id)),
s as (select slug, reference as section, count(*) filter (where reference = candidate) as tp, count(*) filter (where reference <> candidate) as fn, 0 as fp from p group by all union all
      select slug, candidate, 0, 0, count(*) filter (where reference <> candidate) from p group by all)
select slug, section, sum(tp)::bigint as tp, sum(fn)::bigint as fn, sum(fp)::bigint as fp, sum(tp) / nullif(sum(tp) + sum(fp), 0)::double as precision, sum(tp) / nullif(sum(tp) + sum(fn), 0)::double as recall from s group by slug, section"""
)
def audit_scores(spark, sf_dir):
    """A mark-based guess of quality against labels, per source."""
    bad = F.contains("text", F.lit("###")) | F.contains("text", F.lit("!!")) | F.contains("text", F.lit(" | "))
    d = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id")
    return audit.section_scores(d.select(F.col("source").alias("slug"), F.when(F.col("quality") == 1, "good").otherwise("bad").alias("reference"), F.when(bad, "bad").otherwise("good").alias("candidate")))


@query(
    r"""with o as (select o_custkey as slug, o_orderkey as index, o_totalprice as place from orders), s as (select *, place < lag(place) over (partition by slug order by index) as back from o),
i as (select a.slug, count(*) as inverted from o a join o b on a.slug = b.slug and a.index < b.index and a.place > b.place group by a.slug)
select slug, count(*) as blocks, count(*) filter (where back) as backward_steps, coalesce(max(inverted), 0)::bigint as inverted_pairs,
  count(*) filter (where back) / nullif(count(*) - 1, 0)::double as backward_fraction, coalesce(max(inverted), 0) / nullif(count(*) * (count(*) - 1) / 2, 0)::double as inverted_fraction from s left join i using (slug) group by slug"""
)
def reading_order(spark, sf_dir):
    """Is a customer's orders' price in order of key?"""
    o = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("slug"), F.col("o_orderkey").alias("index"), F.col("o_totalprice").alias("place"))
    return audit.reading_order(o)


@query(
    r"""with t as (select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title, regexp_replace(html, '<[^>]+>', ' ', 'g') as body from pages),
w as (select page_id, list_filter(list_distinct(string_split(regexp_replace(lower(title), '[^0-9a-z]+', ' ', 'g'), ' ')), lambda x: length(x) >= 4 and x not in ('the','and','for','with','from','that','this','into','onto','upon','over','under','during','between','across','their','these','those','human','cell','cells','cellular','single','analysis','analyses','reveals','reveal','identifies','identify','study','studies','using')) as wanted,
  string_split(regexp_replace(lower(body), '[^0-9a-z]+', ' ', 'g'), ' ') as held from t)
select page_id, case when len(wanted) > 0 then len(list_filter(wanted, lambda x: list_contains(held, x))) / len(wanted)::double end as overlap from w"""
)
def title_overlap(spark, sf_dir):
    """How much of a page's title its text holds."""
    p = read(spark, sf_dir, "pages").withColumn("title", F.regexp_extract("html", "<title>([^<]*)</title>", 1)).withColumn("body", F.regexp_replace("html", "<[^>]+>", " "))
    return p.select("page_id", T.title_overlap(F.col("body"), F.col("title")).alias("overlap"))


@query(
    r"""with b as (select page_id, url, lower(regexp_replace(left(html, 200000), '\s+', ' ', 'g')) as body from pages)
select page_id, case when contains(body, 'preparing to download') or contains(body, 'checking your browser') then 'javascript_challenge' when contains(body, 'unknown resource') then 'proxy_not_configured' when contains(body, 'purchase pdf') then 'paywalled' end as denial,
  string_split(url, '#')[1] as url from b"""
)
def html_status(spark, sf_dir):
    """FL10, X27: refusals that pages announce, and addresses without fragments."""
    p = read(spark, sf_dir, "pages")
    return p.select("page_id", fetch.denial(F.col("url"), F.col("html")).alias("denial"), T.url_without_fragment(F.col("url")).alias("url"))


@query()
def html_runs(spark, sf_dir):
    """SC14, FL18: text runs of pages, of 80 characters or more, first of those that begin alike. Rows only: SQL has no HTML parser."""
    from quiremill.sources import parsers

    return parsers.html_blocks(read(spark, sf_dir, "pages"), "page_id", "html").select("slug", "index", "kind", "chars", "status")


@query(
    r"""select doc_id, (lower(text) <> text and upper(text) = text) as shouted, regexp_matches(trim(text), '^\s*[0-9]{1,4}\s*[.)]\s+\S|\([0-9]{4}[a-z]?\)|\bet\s+al\b|\bdoi\s*:|doi\.org/', 'i') as citation, length(trim(regexp_replace(text, '\s+', ' ', 'g'))) as chars,
 len(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')) as words from documents"""
)
def text_features(spark, sf_dir):
    """Case, citation look and words of documents."""
    d, t = read(spark, sf_dir, "documents"), F.col("text")
    return d.select("doc_id", ((F.lower(t) != t) & (F.upper(t) == t)).alias("shouted"), T.looks_like_citation(F.trim(t)).alias("citation"), F.length(T.collapsed(t)).cast("long").alias("chars"), F.size(T.words(t)).cast("long").alias("words"))
