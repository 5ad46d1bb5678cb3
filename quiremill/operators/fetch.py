"""Decisions about fetched documents: denials, identity, status ladders, rollups, retention. No network."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiremill.functions import text as T
from quiremill.limits import DEFAULT, Limits
from quiremill.vocab import FULLTEXT_USABLE, PDF_DIAGNOSES, SUPPLEMENTS_SETTLED

# Phrases of pages that refuse access, and hosts of sign-in services.
PAYWALL = (
    "purchase this article", "purchase pdf", "buy this article", "rent this article", "get access to this article", "access through your institution", "institutional access", "sign in to read",
    "subscribe to view", "subscription required", "this article is available to subscribers", "check access to the full text", "choose an option to locate", "already a subscriber", "one-time purchase",
)
PROXY_NOT_CONFIGURED = ("has not been configured for access", "attempted to view a page that has not been configured", "unknown resource")
SSO = ("two-step authentication", "duo push", "secured by duo")
SSO_HOSTS = ("duosecurity.com",)
LINK_RESOLVER = ("serviceerrorresponse", "could not find eid for link resolver")
JS_CHALLENGE = ("preparing to download", "pow-o", "checking your browser", "enable javascript and cookies to continue")
# What is not a research article, by JATS type, publication type and title.
NOT_RESEARCH_JATS = ("correction", "corrigendum", "erratum", "retraction", "partial-retraction", "retraction-notice", "editorial", "expression-of-concern", "editorial-expression-of-concern")
NOT_RESEARCH_TYPES = ("published erratum", "correction", "corrigendum", "erratum", "retraction of publication", "expression of concern")
NOT_RESEARCH_TITLE = (
    r"(?i)^\s*(author correction|publisher correction|correction( to)?|corrigendum|erratum|retraction( note| notice)?|retracted|withdrawn|(editorial )?expression of concern|addendum|matters arising)\s*:"
)
DENIAL_HEAD = 200_000


def _any(body: Column, phrases: tuple[str, ...]) -> Column:
    return F.exists(F.array(*map(F.lit, phrases)), lambda p: F.contains(body, p))


def denial(url: Column, content: Column, sso_hosts: tuple[str, ...] = SSO_HOSTS, sso: tuple[str, ...] = SSO) -> Column:
    """FL10. The refusal that a page's first 200,000 characters announce, the most specific first; null for none. Hosts and phrases of an institution's own sign-in pages are given by its users."""
    body = F.lower(F.regexp_replace(F.left(F.coalesce(content, F.lit("")), F.lit(DENIAL_HEAD)), r"(?U)\s+", " "))
    host = _any(F.coalesce(url, F.lit("")), sso_hosts)
    return (
        F.when(_any(body, JS_CHALLENGE), "javascript_challenge").when(_any(body, PROXY_NOT_CONFIGURED), "proxy_not_configured").when(_any(body, LINK_RESOLVER), "link_resolver_error")
        .when(host | _any(body, sso), "session_expired").when(_any(body, PAYWALL), "paywalled")
    )


def not_research(article_type: Column, title: Column, pub_types: Column) -> Column:
    """FL11. Which signal says that this is no research article: pub_types, article_type or title; null for none."""
    types = F.transform(F.coalesce(pub_types, F.array().cast("array<string>")), lambda t: F.lower(F.trim(t)))
    return (
        F.when(F.arrays_overlap(types, F.array(*map(F.lit, NOT_RESEARCH_TYPES))), "pub_types")
        .when(F.lower(F.trim(article_type)).isin(*NOT_RESEARCH_JATS), "article_type").when(title.rlike(NOT_RESEARCH_TITLE), "title")
    )


def suppl_flag_believable(has_suppl: Column, is_preprint: Column, is_open_access: Column, in_epmc: Column, in_pmc: Column) -> Column:
    """FL7. May "no supplements" be believed? Only of an index that holds the article's files; unknown is not no."""
    held = F.coalesce(in_epmc, F.lit(False)) | F.coalesce(in_pmc, F.lit(False))
    return has_suppl.eqNullSafe(F.lit(False)) & ~F.coalesce(is_preprint, F.lit(False)) & ~is_open_access.eqNullSafe(F.lit(False)) & held


def supplement_status(wanted: Column, believable: Column, collected: Column, reported: Column, has_suppl: Column) -> Column:
    """FL6. The order of the steps decides: outcomes before reports, stronger words before weaker."""
    said = lambda s: F.array_contains(reported, s)
    got = collected > 0
    return (
        F.when(~wanted, "not_requested").when(believable, "none_listed").when(got & said("fetched"), "fetched").when(got & said("fetched_unverified"), "fetched_unverified").when(got, "partial_failure")
        .when(said("none_listed"), "none_listed").when(has_suppl.eqNullSafe(F.lit(True)), "expected_but_missing").when(said("partial_failure"), "none_retrieved").when(said("page_not_parsed"), "page_not_parsed")
        .otherwise("unknown_none_found")
    )


def fetch_status(fulltext: Column, supplementary: Column, has_xml: Column) -> Column:
    """FL8. complete, partial or failed."""
    usable = F.coalesce(fulltext.isin(*FULLTEXT_USABLE), F.lit(False))
    settled = F.coalesce(supplementary.isin(*SUPPLEMENTS_SETTLED), F.lit(False))
    return F.when(usable & settled, "complete").when(usable | F.coalesce(has_xml, F.lit(False)) | F.coalesce(supplementary.isin("fetched", "fetched_unverified", "partial_failure"), F.lit(False)), "partial").otherwise("failed")


def best_failure(reports: DataFrame, group: str = "slug", status: str = "status", order: str = "tier_ord") -> DataFrame:
    """FL14. Per article the status that explains most: the first usable one; else the highest diagnosis; else the last generic one."""
    rank = F.array_position(F.array(*map(F.lit, PDF_DIAGNOSES)), F.col(status))
    usable = F.col(status).isin(*FULLTEXT_USABLE)
    a = reports.groupBy(group).agg(
        F.min_by(status, F.when(usable, F.col(order))).alias("_ok"), F.min_by(status, F.when(rank > 0, rank)).alias("_named"), F.max_by(status, F.when(F.col(status).isNotNull(), F.col(order))).alias("_last"),
        F.max(usable.cast("int")).alias("_u"), F.max((rank > 0).cast("int")).alias("_d"),
    )
    return a.select(group, F.when(F.col("_u") == 1, F.col("_ok")).when(F.col("_d") == 1, F.col("_named")).otherwise(F.col("_last")).alias(status))


def pdf_status(size: Column, is_pdf: Column, refused: Column, pages: Column, chars: Column, paywall_text: Column, limits: Limits = DEFAULT) -> Column:
    """FL13. Whether downloaded bytes are accepted, and if not why."""
    stub = F.coalesce(paywall_text, F.lit(False)) & ((pages <= 2) | (size < 30_000))
    return F.when(size < 100, "download_failed").when(~is_pdf & refused.isNotNull(), refused).when(~is_pdf, "not_a_pdf").when(stub, "publisher_stub_page").when(chars < limits.min_pdf_text_chars, "scanned_pdf_suspected").otherwise("ok")


def main_text_choice(renditions: DataFrame, limits: Limits = DEFAULT, group: str = "slug") -> DataFrame:
    """FL15, FL16, C29. One rendition per article. renditions: (slug, source, status, chars, forced, rejected).

    A reviewer's choice first, then XML that is long enough, PDF, scanned PDF or thin XML by length (a tie: XML), the landing page. Rejected ones don't stand unless nothing does.
    """
    ok, chars = F.col("status") == "ok", F.coalesce("chars", F.lit(0))
    rank = (
        F.when(F.coalesce("forced", F.lit(False)), 0).when(F.coalesce("rejected", F.lit(False)), 9).when((F.col("source") == "jats") & ok & (chars >= limits.min_main_text_chars), 1)
        .when((F.col("source") == "pdf") & ok, 2).when(F.col("source").isin("jats", "pdf") & (chars > 0), 3).when((F.col("source") == "landing") & ok, 4).otherwise(8)
    )
    r = renditions.withColumn("_rank", rank).withColumn("_size", F.when(F.col("_rank") == 3, -chars).otherwise(F.lit(0)))
    w = Window.partitionBy(group).orderBy("_rank", "_size", (F.col("source") != "jats").cast("int"), "source")
    best = r.withColumn("_n", F.row_number().over(w)).where("_n = 1")
    missing = F.col("_rank") >= 8
    return best.select(group, F.when(~missing, F.col("source")).alias("main_text"), F.when(missing, "missing").otherwise(F.col("status")).alias("status"), (~missing & (F.coalesce("chars", F.lit(0)) < limits.min_main_text_chars)).alias("thin"))


def article_status(files: DataFrame, group: str = "slug") -> DataFrame:
    """FL17. files: (slug, role, status, caveats). complete iff there is usable main text, no blocking file and no blocking caveat."""
    from quiremill.operators.select import BLOCKING
    from quiremill.vocab import BENIGN_STATUSES

    a = files.groupBy(group).agg(
        F.coalesce(F.bool_or((F.col("role") == "main_text") & (F.col("status") == "ok")), F.lit(False)).alias("usable"), F.bool_or(~F.col("status").isin("ok", *BENIGN_STATUSES)).alias("blocked"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("caveats")))).alias("caveats"), F.bool_or(F.col("status") == "ok").alias("any"),
    )
    caveat = F.arrays_overlap("caveats", F.array(*map(F.lit, BLOCKING)))
    return a.select(group, "caveats", F.when(F.col("usable") & ~F.col("blocked") & ~caveat, "complete").when(F.col("usable") | F.col("any"), "partial").otherwise("failed").alias("status"))


def eviction(articles: DataFrame, max_bytes: int, order: str = "fetched_at", key: str = "slug", partition: str | None = None) -> DataFrame:
    """W7. Adds evict: articles go oldest first until the rest is within ``max_bytes``; evicted ones and the newest stay out of it. ``partition`` sets budgets of their own."""
    by = Window.partitionBy(*([partition] if partition else []))
    w = by.orderBy(order, key)
    a = articles.withColumn("_newest", F.row_number().over(by.orderBy(F.col(order).desc(), F.col(key).desc())) == 1)
    a = a.withColumn("_can", ~F.col("_newest") & ~F.coalesce("evicted", F.lit(False)))
    total = F.sum(F.when(~F.coalesce("evicted", F.lit(False)), F.col("bytes")).otherwise(0)).over(by)
    freed = F.coalesce(F.sum(F.when(F.col("_can"), F.col("bytes")).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return a.withColumn("freed_before", freed).withColumn("evict", F.col("_can") & (total - F.col("freed_before") > max_bytes)).drop("_newest", "_can")


def evicted_manifest(manifests: DataFrame) -> DataFrame:
    """C20. What an evicted article keeps: its manifest with freed bytes and each file marked."""
    freed = F.aggregate("supplementary", F.coalesce("fulltext.bytes", F.lit(0)).cast("long"), lambda a, f: a + F.coalesce(f["bytes"], F.lit(0)))
    return manifests.withColumn("freed_bytes", freed).withColumn("supplementary", F.transform("supplementary", lambda f: f.withField("evicted", F.lit(True)))).withColumn("status", F.lit("evicted")).withColumn("evicted", F.lit(True))


def usage(files: DataFrame) -> DataFrame:
    """A13. Bytes and files per article."""
    return files.groupBy("slug").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("files"))


def breaker(attempts: DataFrame, group: str, order: str, failed: str, trip: int = 3) -> DataFrame:
    """W10. Adds streak (failures in a row up to here) and dropped: a tier is dropped after ``trip`` of them, for good."""
    w = Window.partitionBy(group).orderBy(order)
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    a = attempts.withColumn("_run", F.sum(F.when(F.col(failed), 0).otherwise(1)).over(up))
    a = a.withColumn("streak", F.sum(F.col(failed).cast("int")).over(Window.partitionBy(group, "_run").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))
    return a.withColumn("dropped", F.coalesce(F.max((F.col("streak") >= trip).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)) == 1, F.lit(False))).drop("_run")


def first_known(base: DataFrame, lookups: list[DataFrame], key: str, columns: list[str]) -> DataFrame:
    """SC24. Each column's first non-null value over lookups in order, and which lookup gave it."""
    out = base
    for i, one in enumerate(lookups):
        out = out.join(one.select(key, *(F.col(c).alias(f"_{i}_{c}") for c in columns)), key, "left")
    given = lambda c: [F.col(f"_{i}_{c}") for i in range(len(lookups))]
    return out.select(*base.columns, *(F.coalesce(*given(c)).alias(c) for c in columns), *(F.coalesce(*(F.when(x.isNotNull(), F.lit(i)) for i, x in enumerate(given(c)))).alias(f"{c}_from") for c in columns))


def latest_version(rows: DataFrame, group: str, version: str) -> DataFrame:
    """S9. The row with the largest version; one that is no number is 0."""
    w = Window.partitionBy(group).orderBy(F.coalesce(F.col(version).try_cast("int"), F.lit(0)).desc(), version)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def split_package(members: DataFrame, group: str = "slug", name: str = "name") -> DataFrame:
    """FL21. Adds part: media, xml, fulltext (the shortest named PDF) or supplement."""
    low = F.lower(name)
    w = Window.partitionBy(group, low.rlike(r"\.pdf$")).orderBy(F.length(name), name)
    kind = F.when(low.rlike(r"\.(jpe?g|png|gif|tiff?|svg|mp4|mov|avi|webm)$"), "media").when(low.rlike(r"\.n?xml$"), "xml").when(low.rlike(r"\.pdf$") & (F.row_number().over(w) == 1), "fulltext").otherwise("supplement")
    return members.withColumn("part", kind)


def file_class(name: Column) -> Column:
    """FL19. image, media, data, document, sheet, archive or other by extension."""
    ext = F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1))
    sets = {"image": "jpg jpeg png gif tif tiff svg bmp eps", "media": "mp4 mov avi webm mp3 wav mpg", "sheet": "csv tsv xlsx xls", "document": "pdf docx txt html htm xml nxml", "archive": "zip gz tgz tar", "data": "h5 h5ad rds rdata npz mat bam fastq"}
    out = None
    for kind, names in sets.items():
        out = (F if out is None else out).when(ext.isin(*names.split()), kind)
    return out.otherwise("other")


def supplement_link(url: Column, label: Column) -> Column:
    """FL12. Does a link lead to a supplementary file? By its address without fragment, or what it is called."""
    hint = r"(?i)suppl|additional[ _-]?file|supporting[ _-]?info|moesm|mmc\d|extended[ _-]?data"
    return F.coalesce(T.url_without_fragment(url).rlike(hint), F.lit(False)) | F.coalesce(label.rlike(hint), F.lit(False))


def revalidated(articles: DataFrame) -> DataFrame:
    """C6. Adds verdict, why and changed. articles: (slug, status, doi, title, article_type, pub_types, head_text). The status changes only if the verdict does; problems are added once."""
    why = not_research(F.col("article_type"), F.col("title"), F.col("pub_types"))
    known = T.identity(F.col("head_text"), F.col("doi"), F.col("title"))
    a = articles.withColumn("why", why).withColumn("identity", known)
    verdict = F.when(F.col("why").isNotNull(), "not_research_article").when(~F.col("identity.verified"), "identity_unverified").when(F.col("status").isin("not_research_article", "identity_unverified"), "ok").otherwise(F.col("status"))
    return a.withColumn("verdict", verdict).withColumn("changed", ~F.col("verdict").eqNullSafe(F.col("status")))


def prioritised_labels(entries: DataFrame, labels: DataFrame, keys: str = "keys") -> DataFrame:
    """J1. Each entry's label by the first of its keys that has one. entries: (slug, entry, keys); labels: (slug, key, label)."""
    k = entries.select("slug", "entry", F.posexplode(keys).alias("pos", "key"))
    hit = k.join(labels, ["slug", "key"]).groupBy("slug", "entry").agg(F.min_by("label", "pos").alias("label"), F.min_by("key", "pos").alias("matched_key"))
    return entries.select("slug", "entry").join(hit, ["slug", "entry"], "left")


def shared_labels(entries: DataFrame, label: str = "label") -> DataFrame:
    """A11. Labels that two entries of an article or more bear: they tell none apart."""
    return entries.where(F.col(label).isNotNull()).groupBy("slug", label).agg(F.count(F.lit(1)).alias("n")).where("n >= 2")


def resolved_label(review: Column, jats: Column, jats_shared: Column, caption: Column, manifest: Column, manifest_shared: Column) -> Column:
    """J2. STRUCT<label, label_source>: review, unshared JATS, a short caption head, unshared manifest, none."""
    own = lambda x, shared: F.when(~F.coalesce(shared, F.lit(False)), x)
    steps = [(review, "review"), (own(jats, jats_shared), "jats"), (T.label_of_caption(caption), "jats_caption"), (own(manifest, manifest_shared), "manifest")]
    found = [F.when(x.isNotNull(), F.struct(x.alias("label"), F.lit(s).alias("label_source"))) for x, s in steps]
    return F.coalesce(*found, F.struct(F.lit(None).cast("string").alias("label"), F.lit("none").alias("label_source")))


def digest_match(expected: DataFrame, universe: DataFrame) -> DataFrame:
    """J10. Is each expected file there: by its own digest, or all of its members' by theirs? expected: (slug, file, sha256, members ARRAY<STRING>); universe: (slug, sha256)."""
    u = universe.select("slug", "sha256").distinct()
    own = expected.select("slug", "file", "sha256").join(u, ["slug", "sha256"], "left_semi").select("slug", "file", F.lit(True).alias("whole"))
    m = expected.select("slug", "file", F.explode("members").alias("sha256")).distinct().join(u.withColumn("_in", F.lit(True)), ["slug", "sha256"], "left")
    parts = m.groupBy("slug", "file").agg(F.bool_and(F.coalesce("_in", F.lit(False))).alias("by_members"))
    out = expected.select("slug", "file").join(own, ["slug", "file"], "left").join(parts, ["slug", "file"], "left")
    return out.select("slug", "file", (F.coalesce("whole", F.lit(False)) | F.coalesce("by_members", F.lit(False))).alias("found"))


def extras(expected: DataFrame, universe: DataFrame) -> DataFrame:
    """J11. Files that nothing expected."""
    all_ = expected.select("slug", F.explode(F.array_compact(F.array_append(F.coalesce("members", F.array().cast("array<string>")), F.col("sha256")))).alias("sha256"))
    return universe.join(all_.distinct(), ["slug", "sha256"], "left_anti")


def failures(checks: DataFrame) -> DataFrame:
    """C23. Checks that failed; those that only report have a null."""
    return checks.where(F.col("ok").eqNullSafe(F.lit(False)))
