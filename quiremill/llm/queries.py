"""The registered query of each training-data operator, over its whole table, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiremill.llm import bpe, embed_dedup, fingerprint, html_text, license_scan, mixing, ngram_join, quality, sharding, url_filter
from quiremill.llm.common import shared_dir
from quiremill.sources.tables import read

URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


#: The rank file of the tokenizer; a parameter of bpe.round_trip.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families of every document, confirmed ones and whether there is licence text of an unknown one, with all passages."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = license_scan.scan(docs, license_scan.train(docs))
    families = F.array_sort(F.array_distinct(F.transform("licenses", lambda s: s["family"])))
    return found.select("doc_id", F.array_remove(families, license_scan.UNKNOWN).alias("families"), F.array_contains(families, license_scan.UNKNOWN).alias("has_unknown"), F.size("licenses").cast("long").alias("n_passages"), "licenses")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of what they decode to."""
    found = bpe.round_trip(read(spark, sf_dir, "documents").select("doc_id", "text"), RANKS)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings of one label at a cosine of 0.93 or more."""
    return embed_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of all documents whose 4-word shingles have a Jaccard similarity of 0.85 or more."""
    return ngram_join.similar_classes(read(spark, sf_dir, "documents"))


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts, and likeness to these and to the next documents."""
    return fingerprint.fingerprints_with_next(read(spark, sf_dir, "documents"))


def slot_map_path(spark: SparkSession, sf_dir: str, n_shards: int = 16) -> str:
    """Where the map of a table is kept: the same path in each run, in the shared folder."""
    return f"{shared_dir(spark)}/quiremill/slot-map-{n_shards}-{hashlib.sha256(sf_dir.encode()).hexdigest()[:16]}"


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards under the slot map kept for this table, which is edited where it isn't even any more; law ``bytes``."""
    found = sharding.shard(read(spark, sf_dir, "documents"), slot_map_path(spark, sf_dir), 16)
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weight, score and decision for every document."""
    return quality.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    return url_filter.judge_urls(read(spark, sf_dir, "pages"), url_filter.rules_frame(spark, URL_RULES))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = html_text.extract(read(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to 150 % of their words by weights 3, 1, 2."""
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


QUERIES = {
    f.__name__: f
    for f in (op1_license_scan, op2_bpe, op3_embedding_dedup, op4_ngram_join, op5_fingerprint, op6_sharding, op7_quality, op8_url_filter, op9_html_text, op10_mixing)
}

ORACLES: dict[str, str] = {}
ORACLES["op8_url_filter"] = r"""
with p as (select page_id, coalesce(case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) end, '') rest from pages),
h as (select page_id, regexp_extract(rest, '^[^/?#]*') raw, rest from p),
u as (select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') path from h),
rules(rh, rp, action) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block'))
select page_id, host, path, max_by(rh || rp, length(rh || rp)) as rule, coalesce(max_by(action, length(rh || rp)), 'allow') as verdict
from u left join rules on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp)
group by page_id, host, path
"""
ORACLES["op3_embedding_dedup"] = r"""
with recursive v as (select vec_id, label, embedding::double[] as e from embeddings where label is not null and embedding is not null and len(embedding) > 0
  and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (select a.vec_id as x, b.vec_id as y from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.93),
reach(vec_id, root) as (select vec_id, vec_id from embeddings union select y, root from reach join links on vec_id = x),
c as (select vec_id, min(root) as component_id from reach group by vec_id), n as (select x, count(*) as n_links from links group by x)
select vec_id, coalesce(n_links, 0)::bigint as n_links, component_id, vec_id = component_id as kept from c left join n on vec_id = x
"""
ORACLES["op4_ngram_join"] = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
s as (select distinct doc_id, unnest(case when len(ws) >= 4 then list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as sh from w),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as x, b.doc_id as y, count(*) as k from s a join s b on a.sh = b.sh and a.doc_id <> b.doc_id group by all),
links as (select x, y from p join n a on a.doc_id = x join n b on b.doc_id = y where 100 * k >= 85 * (a.n + b.n - k)),
reach(doc_id, root) as (select doc_id, doc_id from documents union select y, root from reach join links on doc_id = x)
select doc_id, coalesce(max(n.n), 0)::bigint as n_shingles, min(root) as component_id from reach left join n using (doc_id) group by doc_id
"""
ORACLES["op10_mixing"] = r"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size, (('0x' || left(md5('mix:' || doc_id), 12))::bigint + 0.5) / 281474976710656.0::double as u from documents),
o as (select *, case when size > 0 then u / (1 - u) / size end as rank from d),
s as (select source, sum(size)::bigint as source_size, ([3, 1, 2])[(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight from d group by source),
l as (select *, 2.0::double * source_size as cap, (1.5::double * sum(source_size) over () - (sum(2.0::double * source_size) over o - 2.0::double * source_size)) / (sum(weight) over () - sum(weight) over o + weight) as level
  from s window o as (order by 2.0 * source_size / weight, source nulls last rows unbounded preceding)),
t as (select source, source_size, case when cap <= level * weight then cap else weight * max(case when cap > level * weight then level end) over () end as target from l),
r as (select *, case when source_size > 0 then least(target / source_size, 2.0) else 0.0 end as rate from t),
q as (select *, floor(rate)::int as certain, greatest(target - floor(rate)::int * source_size, 0.0) as rest from r),
c as (select d.doc_id, d.source, d.size, d.rank, q.source_size, q.target, q.certain, q.rest, sum(d.size) over (partition by d.source order by d.rank, d.doc_id rows unbounded preceding) as upto from o d join q on d.source is not distinct from q.source),
m as (select *, upto <= rest as drawn, rest - max(case when upto <= rest then upto else 0 end) over (partition by source) as missing from c),
k as (select *, row_number() over (partition by source, drawn order by abs(size - missing), rank, doc_id) = 1 and not drawn and abs(size - missing) < missing as closing from m),
f as (select *, case when size > 0 then least(certain + (case when rest > 0 and (drawn or closing) then 1 else 0 end), 2) else 0 end as copies from k)
select doc_id, size, source_size, target, (copies * size)::bigint as taken, source, copies::int as copies from f
"""
