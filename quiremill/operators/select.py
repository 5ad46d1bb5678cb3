"""Finding, verifying and judging: identifiers in blocks, quotes, readiness, scores against labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quiremill.functions import quotes as Q

STUDY, SAMPLE = "study", "sample"
# Identifier shapes of public repositories (repository, pattern, level), tried in this order.
ACCESSIONS: tuple[tuple[str, str, str], ...] = (
    ("GEO", r"GSE\d{4,}", STUDY), ("GEO", r"GSM\d{4,}", SAMPLE), ("SRA", r"SRP\d{5,}", STUDY), ("SRA", r"SR[RXS]\d{5,}", SAMPLE), ("ENA", r"ERP\d{5,}", STUDY), ("ENA", r"ER[RXS]\d{5,}", SAMPLE),
    ("DDBJ", r"DRA\d{5,}", STUDY), ("DDBJ", r"DR[RXS]\d{5,}", SAMPLE), ("BioProject", r"PRJ(?:NA|EB|DB|CA)\d{3,}", STUDY), ("BioSample", r"SAM[NED][A-Z]?\d{5,}", SAMPLE),
    ("ArrayExpress", r"E-[A-Z]{4}-\d+", STUDY), ("EGA", r"EGAS\d{6,}", STUDY), ("EGA", r"EGA[DN]\d{6,}", SAMPLE), ("dbGaP", r"phs\d{6}(?:\.v\d+(?:\.p\d+)?)?", STUDY), ("Synapse", r"syn\d{7,}", STUDY),
    ("GSA", r"(?:HRA|CRA|OEP)\d{6}", STUDY), ("ProteomeXchange", r"PXD\d{6}", STUDY), ("MassIVE", r"MSV\d{9}", STUDY), ("BioStudies", r"S-BSST\d+", STUDY), ("ImmPort", r"SDY\d{3,}", STUDY),
)
SENTENCE_WINDOW = 400
#: Between a letter, number or underscore of any script and something else; \b of the JVM leaves out numbers that are no digits, and from version 19 on all but ASCII.
EDGE = r"(?:(?<![\p{L}\p{N}_])(?=[\p{L}\p{N}_])|(?<=[\p{L}\p{N}_])(?![\p{L}\p{N}_]))"


def mentions(blocks: DataFrame, patterns: Sequence[tuple[str, str, str]] = ACCESSIONS, keep: Sequence[str] = ("slug", "index", "block_id", "section", "kind")) -> DataFrame:
    """X10, X11. One row per hit: accession, repository, level, nth (of the block, from 0), at (code points before it), sentence.

    One alternation finds hits; splitting at it gives the texts between them, whose lengths give positions. Patterns are a parameter.
    """
    alternation = f"{EDGE}(?:{'|'.join(p for _, p, _ in patterns)}){EDGE}"
    hits = F.regexp_extract_all("text", F.lit(f"({alternation})"), F.lit(1))
    b = blocks.where(F.col("text").rlike(alternation)).withColumn("_hits", hits).withColumn("_gaps", F.split("text", alternation))
    b = b.select(*keep, "text", "_gaps", "_hits", F.posexplode("_hits").alias("nth", "accession"))
    length = lambda acc, x: acc + F.length(x)
    at = F.aggregate(F.slice("_gaps", F.lit(1), F.col("nth") + 1), F.lit(0), length) + F.aggregate(F.slice("_hits", F.lit(1), F.col("nth")), F.lit(0), length)
    kinds = F.coalesce(*(F.when(F.col("accession").rlike(rf"^(?:{p})$"), F.struct(F.lit(r).alias("repository"), F.lit(level).alias("level"))) for r, p, level in patterns))
    b = b.withColumn("at", at).withColumn("_k", kinds)
    return b.select(*keep, "nth", "accession", "_k.repository", "_k.level", "at", sentence(F.col("text"), F.col("at"), F.length("accession"), F.col("kind")).alias("sentence"))


def sentence(text: Column, at: Column, size: Column, kind: Column) -> Column:
    """X11. The sentence around a hit, looked for in ``SENTENCE_WINDOW`` characters to each side; of a table, its line."""
    left = F.greatest(at - SENTENCE_WINDOW, F.lit(0))
    before = F.substring(text, left + 1, at - left)
    after = F.substring(text, at + 1, size + SENTENCE_WINDOW)
    tail = F.regexp_extract(before, r"(?s)^(?:.*(?:[.?!] |\.\n|\n\n))?(.*)$", 1)
    head = F.regexp_extract(after, r"(?s)^(.*?)(?:(?<=[.?!])(?= )|(?<=\.)(?=\n)|(?<=\n)(?=\n)|$)", 1)
    prose = F.trim(F.regexp_replace(F.concat(tail, head), r"(?U)\s+", " "))
    line = F.concat(F.element_at(F.split(F.substring(text, F.lit(1), at), "\n"), -1), F.get(F.split(F.substring(text, at + 1, F.length(text)), "\n"), F.lit(0)))
    return F.when(kind == "table", F.trim(line)).otherwise(prose)


def candidates(found: DataFrame, group: str = "slug") -> DataFrame:
    """A2. One row per accession of an article: its mentions in order, distinct sections in order (- for none), first place, and a null role to fill."""
    m = F.struct("index", "nth", "block_id", "section", "sentence")
    c = found.groupBy(group, "accession", "repository", "level").agg(F.array_sort(F.collect_list(m)).alias("mentions"), F.min(F.struct("index", "nth")).alias("first"))
    sections = F.array_distinct(F.transform("mentions", lambda x: F.coalesce(x["section"], F.lit("-"))))
    return c.withColumn("sections", sections).withColumn("role", F.lit(None).cast("string"))


def by_level(found: DataFrame, group: str = "slug") -> DataFrame:
    """A3."""
    return found.groupBy(group).agg(*(F.sort_array(F.collect_list(F.when(F.col("level") == x, F.col("accession")))).alias(x) for x in (STUDY, SAMPLE)))


def naive_own(found: DataFrame, group: str = "slug") -> DataFrame:
    """C9. The baseline: every study-level accession is the article's own."""
    return found.groupBy(group).agg(F.array_sort(F.collect_set(F.when(F.col("level") == STUDY, F.col("accession")))).alias("predicted"))


def verified_quotes(claims: DataFrame, blocks: DataFrame) -> DataFrame:
    """J5, J6, X9. claims: (slug, claim_id, n, block_id, quote). Adds verdict, found_in, coverage and longest_run.

    Levels run from cheap to dear, each over what the ones before left: the named block's three text comparisons, then fuzzy ones by
    Python, then the article's other blocks, joined by slug only for quotes that are still unmatched; the first in document order is told.
    A block that isn't there is no_such_block, whatever the quote.
    """
    b = blocks.select("slug", "block_id", "index", "text")
    j = claims.join(b.withColumn("_there", F.lit(True)), ["slug", "block_id"], "left").withColumn("_v", F.when(F.col("_there").isNull(), "no_such_block").otherwise(Q.cheap_verdict(F.col("quote"), F.col("text"))))
    done = j.where("_v is not null").select(*claims.columns, F.col("_v").alias("verdict"), F.lit(None).cast("double").alias("coverage"), F.lit(None).cast("double").alias("longest_run"))
    rest = j.where("_v is null").withColumn("_f", Q.fuzzy(Q.loosened(F.col("quote")), Q.loosened(F.col("text"))))
    near = F.coalesce((F.col("_f.coverage") >= Q.FUZZY_COVERAGE) & (F.col("_f.longest_run") >= Q.FUZZY_RUN), F.lit(False))
    rest = rest.select(*claims.columns, F.when(near, "fuzzy").alias("verdict"), F.col("_f.coverage").alias("coverage"), F.col("_f.longest_run").alias("longest_run"))
    open_ = rest.where("verdict is null").select("slug", "claim_id", "n", F.col("block_id").alias("_named"), "quote")
    others = open_.join(b, "slug").where((F.col("block_id") != F.col("_named")) & Q.cheap_verdict(F.col("quote"), F.col("text")).isin("exact", "normalized", "loose"))
    elsewhere = others.groupBy("slug", "claim_id", "n").agg(F.min_by("block_id", "index").alias("found_in"))
    out = done.unionByName(rest).join(elsewhere, ["slug", "claim_id", "n"], "left")
    return out.withColumn("verdict", F.coalesce("verdict", F.when(F.col("found_in").isNotNull(), "wrong_block"), F.lit("quote_not_found")))


#: Rank of a verdict: the weakest evidence decides a claim.
def verdict_rank(verdict: Column) -> Column:
    from quiremill.vocab import QUOTE_VERDICTS

    return F.array_position(F.array(*map(F.lit, QUOTE_VERDICTS)), verdict)


def claim_verdicts(verified: DataFrame) -> DataFrame:
    """A5. Per claim the weakest verdict of its evidence and whether all of it was found."""
    r = verified.withColumn("_r", verdict_rank(F.col("verdict")))
    return r.groupBy("slug", "claim_id").agg(F.max_by("verdict", "_r").alias("verdict"), (F.max("_r") <= 4).alias("verified"), F.count(F.lit(1)).alias("evidence"))


# Caveats and statuses by what they mean.
BLOCKING = ("supplements_expected_but_missing", "manifest_entry_without_a_path", "main_text_thin", "landing_page_only")
SUBSTITUTED = ("landing_page_only", "main_text_thin")
TEXT_LOST = ("no_text_scanned_pdf", "unsupported_format", "too_large", "missing", "unreadable", "garbled_text_encoding", "parser_error")
GAP_CAVEATS = ("supplements_expected_but_missing", "supplement_set_unverified", "manifest_entry_without_a_path")


def readiness(articles: DataFrame) -> DataFrame:
    """FL5. Adds state and gaps. articles: has_manifest, has_record, status, main_status, main_blocks, caveats, lost (statuses of unread files), labelling.

    A rejected document beside good text is a gap too: main_text_is_not_the_requested_article.
    """
    caveats = F.coalesce("caveats", F.array().cast("array<string>"))
    has = lambda c: F.array_contains(caveats, c)
    substituted = F.array_sort(F.array_intersect(caveats, F.array(*map(F.lit, SUBSTITUTED))))
    no_text = (F.col("status") == "failed") | (F.coalesce("main_status", F.lit("ok")) != "ok") | (F.coalesce("main_blocks", F.lit(0)) == 0) | (F.size(substituted) > 0)
    lost = F.size(F.array_intersect(F.coalesce("lost", F.array().cast("array<string>")), F.array(*map(F.lit, TEXT_LOST)))) > 0
    gaps = F.array_compact(
        F.array(
            *(F.when(has(c), c) for c in GAP_CAVEATS), F.when(lost, "supplement_text_unread"), F.when(F.col("labelling").isin("low", "none"), F.concat(F.lit("section_labelling_"), "labelling")),
            F.when(has("main_text_is_not_the_requested_article"), "main_text_is_not_the_requested_article"),
        )
    )
    none = F.array().cast("array<string>")
    state = (
        F.when(~F.coalesce("has_manifest", F.lit(False)), "not_fetched").when(~F.coalesce("has_record", F.lit(False)), "not_extracted").when(F.coalesce(no_text, F.lit(False)), "text_unavailable")
        .when(F.size(gaps) > 0, "ready_with_caveats").otherwise("ready")
    )
    a = articles.withColumn("state", state)
    shown = F.when(F.col("state").isin("not_fetched", "not_extracted"), none).when(F.col("state") == "text_unavailable", F.when(F.size(substituted) > 0, substituted).otherwise(F.array(F.lit("main_text_missing")))).otherwise(gaps)
    return a.withColumn("gaps", shown)


def readiness_rollup(assessed: DataFrame) -> DataFrame:
    """A15."""
    return assessed.groupBy("state").agg(F.count(F.lit(1)).alias("articles")).withColumn("trustworthy", F.col("state").isin("ready", "ready_with_caveats"))


def own_set(accessions: str = "accessions") -> Column:
    """C10."""
    return F.array_sort(F.array_distinct(F.transform(F.filter(accessions, lambda a: a["role"] == "own"), lambda a: a["accession"])))


def label_template(found: DataFrame, by: str = "") -> DataFrame:
    """C12. One label to fill per article: its candidates with null roles."""
    a = F.struct("accession", "repository", "level", F.lit(None).cast("string").alias("role"), F.lit("").alias("note"))
    return found.groupBy("slug").agg(F.array_sort(F.collect_list(a)).alias("accessions")).select("slug", F.lit("accessions").alias("aspect"), F.lit(False).alias("complete"), F.lit(by).alias("by"), "accessions")


def scores_per_article(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """A4, ST3. predictions: (slug, predicted); labels: (slug, complete, accessions). Recall is null unless the label is complete, 1 if it is and there was nothing to find."""
    j = predictions.join(labels, "slug").withColumn("truth", own_set()).withColumn("predicted", F.array_distinct("predicted"))
    j = j.withColumn("hits", F.array_sort(F.array_intersect("predicted", "truth"))).withColumn("false_positives", F.array_sort(F.array_except("predicted", "truth"))).withColumn("missed", F.array_sort(F.array_except("truth", "predicted")))
    role = F.map_from_entries(F.transform(F.expr("array_distinct(transform(accessions, a -> a.accession))"), lambda x: F.struct(x, F.array_max(F.transform(F.filter("accessions", lambda a: a["accession"] == x), lambda a: F.coalesce(a["role"], F.lit("")))))))
    called = lambda r: F.filter("false_positives", lambda x: F.coalesce(F.try_element_at(role, x), F.lit("\0")) == r)
    return j.select(
        "slug", "complete", "predicted", "truth", "hits", "false_positives", "missed", F.try_divide(F.size("hits"), F.size("predicted")).alias("precision"),
        F.when(F.col("complete"), F.coalesce(F.try_divide(F.size("hits"), F.size("truth")), F.lit(1.0))).alias("recall"),
        called("reused").alias("called_own_but_reused"), called("not_an_accession").alias("called_own_but_not_an_accession"), called("\0").alias("called_own_but_unlabelled"),
    )


def score(per_article: DataFrame) -> DataFrame:
    """A4. One row: sums over all articles, divided once. Recall is over complete labels only, null if they hold nothing."""
    whole = F.col("complete")
    a = per_article.agg(
        F.count(F.lit(1)).alias("articles"), F.count_if(whole).alias("articles_complete"), F.sum(F.size("hits")).alias("hits"), F.sum(F.size("predicted")).alias("predicted"),
        F.sum(F.when(whole, F.size("truth")).otherwise(0)).alias("truth"), F.sum(F.when(whole, F.size("hits")).otherwise(0)).alias("_found"),
        *(F.sum(F.size(c)).alias(c) for c in ("called_own_but_reused", "called_own_but_not_an_accession", "called_own_but_unlabelled")),
    )
    return a.withColumn("precision", F.try_divide("hits", "predicted")).withColumn("recall", F.try_divide("_found", "truth")).withColumn("false_positives", F.col("predicted") - F.col("hits")).drop("_found")


def unmatched(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """J7. Slugs with a label but no prediction, and the other way round."""
    a = labels.select("slug").join(predictions.select("slug"), "slug", "left_anti").withColumn("missing", F.lit("prediction"))
    return a.unionAll(predictions.select("slug").join(labels.select("slug"), "slug", "left_anti").withColumn("missing", F.lit("label")))
