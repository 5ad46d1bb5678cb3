import random

import pytest
from pyspark.sql import functions as F

from quiremill import vocab
from quiremill.limits import Limits, overlaid
from quiremill.operators import audit, blocks, fetch, layout, review, select, tables
from quiremill.sources import parsers


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_numbered_ids_are_unique_and_stable(spark):
    d = spark.createDataFrame([(1, "same\nsame\nother"), (2, "same")], "doc_id long, text string")
    b = blocks.lines_as_blocks(d).withColumn("locator", F.lit("l"))
    n = blocks.numbered(b)
    assert rows(n, "slug", "index", "ordinal") == [(1, 0, 0), (1, 1, 1), (1, 2, 0), (2, 0, 0)]
    assert n.select("slug", "block_id").distinct().count() == 4
    assert rows(n, "block_id") == rows(blocks.numbered(b.repartition(3)), "block_id")


def test_pack_skips_and_goes_on(spark):
    b = spark.createDataFrame([("s", 0, "a", 50, "paragraph"), ("s", 1, "b", 60, "paragraph"), ("s", 2, "c", 10, "table"), ("s", 3, "d", 40, "paragraph")], "slug string, index int, block_id string, chars int, kind string")
    p = blocks.packed(b, budget=100, headroom=60).first()
    assert (p.kept, p.dropped, p.used, p.dropped_chars) == (["a", "d"], ["b", "c"], 90, 70)


def _pack(items, budget, headroom):
    """The walk itself, over (index, block_id, chars, kind) in order."""
    used, gone, kept, dropped = 0, 0, [], []
    for _, name, chars, kind in items:
        if chars is not None and used + chars <= budget and (kind not in ("table", None) or budget - used >= headroom):
            used += chars
            kept.append(name)
        else:
            gone = None if gone is None or chars is None else gone + chars
            dropped.append(name)
    return len(items), used, kept, dropped, gone, len(kept)


@pytest.mark.parametrize("head", [2, 256])
def test_pack_is_the_walk_and_gathers_no_growing_lists(spark, head, monkeypatch):
    rng, groups = random.Random(7), {}
    for slug in ["a", "b", "c", None, "late"]:
        sizes = [0, 0, 1, 2, 3, 7, 20, 45, 99, None] if slug != "late" else [0, 1, 1, 2]
        groups[slug] = [(i // 2, f"b{i // 3:03}", rng.choice(sizes), rng.choice(["table", "paragraph", "paragraph"])) for i in range(90)] if slug != "c" else [(i, f"b{i}", 500, "table") for i in range(9)]
    for slug, items in groups.items():
        groups[slug] = sorted(items, key=lambda x: (x[0], x[1], (x[2] is not None, x[2] or 0), x[3] == "table"))
    flat = [(slug, *x) for slug, items in groups.items() for x in items]
    rng.shuffle(flat)
    b = spark.createDataFrame(flat, "slug string, index int, block_id string, chars int, kind string")
    walk = blocks.pack_marks
    monkeypatch.setattr(blocks, "pack_marks", lambda *args: walk(*args, head=head))
    for budget, headroom in ((100, 30), (60, 60), (20, 30)):
        p = blocks.packed(b, budget, headroom)
        got = {r.slug: (r.considered, r.used, r.kept, r.dropped, r.dropped_chars, r.n_kept) for r in p.collect()}
        assert got == {slug: _pack(items, budget, headroom) for slug, items in groups.items()}
    plan = p.select("slug", "used", "n_kept")._jdf.queryExecution().optimizedPlan().toString()
    assert "array_append" not in plan and "collect_list" not in plan


def test_filter_and_preference(spark):
    b = spark.createDataFrame([(0, "methods", "f1", "Alpha"), (1, None, "f2", "beta"), (2, "references", "f2", "alpha")], "index int, section string, source_file string, text string")
    assert rows(blocks.filtered(b, exclude_sections=["references"], contains="ALPHA"), "index") == [(0,)]
    assert rows(blocks.filtered(b, exclude_sections=["references"]), "index") == [(0,), (1,)]
    assert rows(b.select(blocks.preference(["methods"]).alias("p"), "index"), "index", "p") == [(0, 0), (1, 1), (2, 2)]


def test_json_and_markdown(spark):
    b = spark.createDataFrame([("s", 1, "t2", "paragraph", "f", float("nan")), ("s", 0, "t1", "heading", "f", 1.0)], "slug string, index int, text string, kind string, source_file string, x double")
    assert '"x"' not in [r.value for r in blocks.as_json(b.where("index = 1")).collect()][0]
    assert blocks.markdown(b).first().markdown == "<!-- f -->\n\n## t1\n\nt2"
    assert blocks.blocks_digest(b).first().lines == 2


def _fold(items, cap):
    """The tracker as one walk, to hold the windows against."""
    now, used, gone, out = None, 0, set(), []
    for kind, section, text in items:
        if kind == "heading" and section:
            now, used = (None if section in gone else section), 0
            if section in gone:
                now = ("refused", section)
            out.append(None if section in gone else section)
            continue
        label = now if isinstance(now, str) else None
        if label in layout.BOUNDED and used > cap:
            gone.add(label)
            label = None
            out.append(None)
            used += len(text)
            continue
        used += len(text)
        out.append(None if label in layout.LOW_VALUE and "et al" not in text else label)
    return out


def test_carried_sections_as_a_walk(spark):
    import random

    rng, data, want = random.Random(5), [], {}
    for doc in range(60):
        items = []
        for i in range(rng.randrange(1, 25)):
            head = rng.random() < 0.25
            items.append(("heading" if head else "paragraph", rng.choice(["abstract", "methods", "references", "conclusions"]) if head else None, "x" * rng.randrange(1, 9) + (" et al" if rng.random() < 0.3 else "")))
        for i, (k, s, t) in enumerate(items):
            data.append((doc, i, k, s, t))
        want[doc] = _fold(items, 12)
    b = spark.createDataFrame(data, "slug int, index int, kind string, section string, text string")
    for r in layout.carried_sections(b, Limits(max_bounded_section_chars=12)).collect():
        assert r.carried == want[r.slug][r["index"]], (r, want[r.slug])


def test_furniture(spark):
    lines = spark.createDataFrame([("s", p, t) for p in range(3) for t in ("Journal of X", f"{p + 1}", f"own {p}")], "slug string, page int, text string")
    out = layout.without_furniture(lines, layout.running_lines(lines))
    assert rows(out.groupBy("dropped_as").count().na.fill("kept"), "dropped_as", "count") == [("furniture", 3), ("kept", 3), ("page_number", 3)]


def test_headings_split(spark):
    b = spark.createDataFrame([("s", 0, "Methods"), ("s", 1, "Results Overview of the experimental approach and its many parts"), ("s", 2, "x")], "slug string, index int, text string")
    assert rows(layout.with_headings(b).na.fill(""), "index", "part", "kind", "section", "dropped_as")[:3] == [(0, 0, "heading", "methods", ""), (1, 0, "heading", "results", ""), (1, 1, "paragraph", "", "")]


def test_repeating_header_and_composition(spark):
    df = spark.createDataFrame([(["a", "b", "a", "b"],), (["i", "a", "b", "a", "b"],), (["n/a"] * 4,), (["a", "b"],)], "c array<string>")
    got = [r.r and tuple(r.r) for r in df.select(tables.repeating_header(F.col("c")).alias("r")).collect()]
    assert got == [(0, 2), (1, 2), None, None]
    df = spark.createDataFrame([(["G1", None, "G2", None], ["a", "b", "a", "b"])], "u array<string>, l array<string>")
    assert df.select(tables.composed_header(F.col("u"), F.col("l"), F.lit(4)).alias("x")).first().x == ["G1 / a", "G1 / b", "G2 / a", "G2 / b"]


def test_profile_median_is_the_upper_one(spark):
    c = spark.createDataFrame([(i, "n", v) for i, v in enumerate(["1", "2", "3", "4", None])] + [(i, "t", v) for i, v in enumerate(["B", "a", "b"])], "row_no int, column string, value string")
    p = {r.column: r for r in tables.profiles(c).collect()}
    assert (p["n"].median, p["n"].min, p["n"].max, p["n"].n_empty, p["n"].dtype) == (3.0, 1.0, 4.0, 1, "number")
    assert p["t"]["values"] == ["a", "B"] and p["t"].n_unique == 2


def test_profile_of_many_numbers_walks_no_list_of_them(spark):
    rng = random.Random(3)
    columns = {"wide": [f"{rng.choice(['', '-'])}{rng.random() * 10 ** rng.randint(-5, 9):.3g}" for _ in range(999)], "few": [rng.choice(["0", "-0", "7", "7.0", "12%"]) for _ in range(500)], "near": [str(1.7e9 + i) for i in range(64)], "one": ["1e400"], "text": [f"t{i}" for i in range(40)], "mixed": ["x", "1"]}
    c = spark.createDataFrame([(g, i, k, v) for g in ("g", None) for k, vs in columns.items() for i, v in enumerate(vs)], "sheet string, row_no int, column string, value string")
    profile = tables.profiles(c, ["sheet"])
    p = {(r.sheet, r.column): r for r in profile.collect()}
    assert len(p) == 12
    for sheet in ("g", None):
        for k in ("wide", "few", "near", "one"):
            x = sorted(float(v.rstrip("%")) for v in columns[k])
            assert (p[sheet, k].median, p[sheet, k].min, p[sheet, k].max, p[sheet, k].n_values) == (x[len(x) // 2], x[0], x[-1], len(x))
        assert p[sheet, "text"].examples == ["t0", "t1", "t2", "t3", "t4"] and p[sheet, "mixed"].dtype == "mixed" and p[sheet, "mixed"].median is None
    assert " aggregate(" not in profile._jdf.queryExecution().optimizedPlan().toString()


def test_card_rendering_counts_what_it_hides(spark):
    lines = spark.createDataFrame([("s", i, "x" * 30) for i in range(10)], "slug string, position int, line string")
    r = tables.rendered_card(lines, ["slug"], Limits(max_card_chars=125)).first()
    assert (r.columns_shown, r.columns_hidden) == (3, 7)


def test_mentions(spark):
    b = spark.createDataFrame([("s", 0, "b0", "methods", "paragraph", "Some prose. Data are in GSE12345 and GSM9999 here. More."), ("s", 1, "b1", None, "table", "one\nid GSE12345 x\nend")], "slug string, index int, block_id string, section string, kind string, text string")
    m = select.mentions(b)
    assert rows(m, "index", "accession", "level", "at", "sentence") == [
        (0, "GSE12345", "study", 24, "Data are in GSE12345 and GSM9999 here."), (0, "GSM9999", "sample", 37, "Data are in GSE12345 and GSM9999 here."), (1, "GSE12345", "study", 7, "id GSE12345 x"),
    ]
    c = {r.accession: r for r in select.candidates(m).collect()}
    assert c["GSE12345"].sections == ["methods", "-"] and len(c["GSE12345"].mentions) == 2
    assert select.naive_own(m).first().predicted == ["GSE12345"]


def test_verified_quotes(spark):
    text = "The quick brown fox jumps over the lazy dog while seventeen sailors sing"
    b = spark.createDataFrame([("s", "b0", 0, text), ("s", "b1", 1, "another block with other words")], "slug string, block_id string, index int, text string")
    claims = spark.createDataFrame(
        [("s", "c0", 0, "b0", "quick brown"), ("s", "c1", 0, "b1", "quick brown"), ("s", "c2", 0, "bx", ""), ("s", "c3", 0, "b0", text.replace("lazy", "lzy")), ("s", "c4", 0, "b0", "no such words")],
        "slug string, claim_id string, n int, block_id string, quote string",
    )
    v = select.verified_quotes(claims, b)
    assert rows(v, "claim_id", "verdict") == [("c0", "exact"), ("c1", "wrong_block"), ("c2", "no_such_block"), ("c3", "fuzzy"), ("c4", "quote_not_found")]
    assert rows(select.claim_verdicts(v), "claim_id", "verified")[0] == ("c0", True)
    assert vocab.outside(v, "verdict", vocab.QUOTE_VERDICTS).count() == 0


def test_scores(spark):
    acc = "array<struct<accession: string, role: string>>"
    labels = spark.createDataFrame([("a", True, [("X", "own"), ("Y", "reused")]), ("b", False, [("Z", "own")]), ("c", True, [])], f"slug string, complete boolean, accessions {acc}")
    preds = spark.createDataFrame([("a", ["X", "Y", "Q"]), ("b", []), ("c", [])], "slug string, predicted array<string>")
    per = {r.slug: r for r in select.scores_per_article(preds, labels).collect()}
    assert (per["a"].hits, per["a"].called_own_but_reused, per["a"].called_own_but_unlabelled, per["a"].recall) == (["X"], ["Y"], ["Q"], 1.0)
    assert per["b"].precision is None and per["b"].recall is None and per["c"].recall == 1.0
    s = select.score(select.scores_per_article(preds, labels)).first()
    assert (s.precision, s.recall, s.articles) == (1 / 3, 1.0, 3)


def test_readiness(spark):
    d = "has_manifest boolean, has_record boolean, status string, main_status string, main_blocks int, caveats array<string>, lost array<string>, labelling string"
    a = spark.createDataFrame(
        [(False, None, None, None, None, None, None, None), (True, False, None, None, None, None, None, None), (True, True, "failed", "ok", 3, None, None, None), (True, True, "complete", "ok", 3, ["main_text_thin"], None, None),
         (True, True, "partial", "ok", 3, ["main_text_is_not_the_requested_article"], None, "ok"), (True, True, "complete", "ok", 3, [], [], "ok")], d,
    )
    got = [(r.state, r.gaps) for r in select.readiness(a).collect()]
    assert got == [("not_fetched", []), ("not_extracted", []), ("text_unavailable", ["main_text_missing"]), ("text_unavailable", ["main_text_thin"]), ("ready_with_caveats", ["main_text_is_not_the_requested_article"]), ("ready", [])]


def test_denial_and_notice(spark):
    p = spark.createDataFrame([("u", "Please   PURCHASE pdf"), ("https://x.duosecurity.com/", "hi"), ("u", "Checking your browser; purchase pdf"), ("u", "fine"), (None, None)], "url string, html string")
    assert [r.d for r in p.select(fetch.denial(F.col("url"), F.col("html")).alias("d")).collect()] == ["paywalled", "session_expired", "javascript_challenge", None, None]
    t = spark.createDataFrame([("Retraction: x",), ("Retraction of the cilium",)], "t string")
    assert [r.x for r in t.select(fetch.not_research(F.lit(None).cast("string"), F.col("t"), F.lit(None).cast("array<string>")).alias("x")).collect()] == ["title", None]


def test_eviction(spark):
    a = spark.createDataFrame([("a", "1", 50, False), ("b", "2", 50, True), ("c", "3", 50, False), ("d", "4", 50, False)], "slug string, fetched_at string, bytes long, evicted boolean")
    assert rows(fetch.eviction(a, 100), "slug", "evict") == [("a", True), ("b", False), ("c", False), ("d", False)]
    assert rows(fetch.eviction(a, 0), "slug", "evict") == [("a", True), ("b", False), ("c", True), ("d", False)]


def test_main_text_choice(spark):
    r = spark.createDataFrame(
        [("a", "jats", "ok", 5000, False, False), ("a", "pdf", "ok", 9000, False, False), ("b", "jats", "ok", 100, False, False), ("b", "pdf", "no_text_scanned_pdf", 100, False, False), ("c", "landing", "ok", 50, False, False), ("d", "pdf", "ok", 5000, False, True)],
        "slug string, source string, status string, chars int, forced boolean, rejected boolean",
    )
    assert rows(fetch.main_text_choice(r).na.fill("-"), "slug", "main_text", "thin") == [("a", "jats", False), ("b", "jats", True), ("c", "landing", True), ("d", "-", False)]


def test_digest_match(spark):
    e = spark.createDataFrame([("s", "f1", "h1", None), ("s", "f2", "h2", ["m1", "m2"]), ("s", "f3", "h3", ["m1", "m9"])], "slug string, file string, sha256 string, members array<string>")
    u = spark.createDataFrame([("s", "h1"), ("s", "m1"), ("s", "m2"), ("s", "zz")], "slug string, sha256 string")
    assert rows(fetch.digest_match(e, u), "file", "found") == [("f1", True), ("f2", True), ("f3", False)]
    assert rows(fetch.extras(e, u), "sha256") == [("zz",)]


def test_review(spark):
    b = spark.createDataFrame([("s", "b0", None, None), ("s", "b1", "methods", "heading")], "slug string, block_id string, section string, section_source string")
    a = spark.createDataFrame([("s", "b0", "results"), ("s", "b1", "results")], "slug string, block_id string, section string")
    assert rows(review.reviewed_sections(b, a), "block_id", "section", "section_source") == [("b0", "results", "review"), ("b1", "methods", "heading")]
    q = spark.createDataFrame([("s", "header", i) for i in range(30)] + [("s", "main_text", 0)], "slug string, kind string, pos int")
    top = review.queue(q).orderBy("place").collect()
    assert len(top) == 25 and top[0].kind == "main_text" and top[0].hidden == 6
    cards = spark.createDataFrame([("s", "f", "l", 3, "low")], "slug string, source_file string, locator string, header_row int, header_confidence string")
    no = spark.createDataFrame([("s", "f", "l", None, False)], "slug string, source_file string, locator string, header_row int, has_header boolean")
    assert tuple(review.overridden(cards, no).select("header_row", "header_confidence").first()) == (None, "confirmed")


def test_reading_order_and_votes(spark):
    a = spark.createDataFrame([("s", i, p) for i, p in enumerate([1, 3, 2, 0])], "slug string, index int, place int")
    r = audit.reading_order(a).first()
    assert (r.backward_steps, r.inverted_pairs) == (2, 4)
    ref = spark.createDataFrame([("r1", "a b c d e f g h i j"), ("r2", "q b c d e f g h i z")], "name string, text string")
    ix = audit.shingle_index(ref, "name", [], 8)
    docs = spark.createDataFrame([(1, "x a b c d e f g h i"), (2, "nothing here at all to see in this one")], "doc int, text string")
    assert rows(audit.voted(docs, ix, "name", ["doc"], [], 8), "doc", "name", "votes") == [(1, "r1", 1)]


def test_parsers(spark):
    import io
    import zipfile

    page = "<html><head><meta name='citation_title' content='T'></head><body><script>no</script><p>" + "word " * 30 + "</p><p>" + "word " * 30 + "</p><p>short</p></body></html>"
    got = parsers.html_blocks(spark.createDataFrame([(1, page), (2, "<p>hi</p>"), (3, None)], "id int, html string"), "id", "html")
    assert rows(got, "slug", "kind", "status") == [(1, "metadata", "ok"), (1, "paragraph", "ok")]
    jats = "<!DOCTYPE article><article><body><sec sec-type='methods'><title>Methods</title><p>We used &alpha;<xref ref-type='bibr'>1</xref>.</p><table-wrap><label>Table 1</label><caption><p>Cap</p></caption><table><tr><td>a</td><td>b</td></tr></table></table-wrap></sec></body></article>"
    b = spark.createDataFrame([(jats,), ("<bad",)], "x string").select(parsers.jats_blocks("x").alias("b")).collect()
    assert [(x.kind, x.section, x.label) for x in b[0].b] == [("heading", "methods", None), ("paragraph", "methods", None), ("caption", "methods", "Table 1"), ("table", "methods", "Table 1")] and b[0].b[1].text == "We used α." and b[1].b is None
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a.csv", "x;y\n1;2\n\n3;4\n")
        z.writestr("../evil.csv", "")
        z.writestr("b.exe", "")
    files = spark.createDataFrame([("p.zip", bytearray(out.getvalue())), ("q.zip", bytearray(b"no"))], "path string, content binary")
    m = parsers.zip_members(files)
    assert rows(m.na.fill("-"), "path", "member", "skip_reason") == [("p.zip", "../evil.csv", "unsafe"), ("p.zip", "a.csv", "-"), ("p.zip", "b.exe", "extension"), ("q.zip", "-", "unreadable")]
    c = parsers.csv_rows(m.where("skip_reason is null").select(F.col("member").alias("path"), "content"))
    assert rows(c, "row_no", "n_rows_total")[-1] == (3, 3) and c.where("row_no = 1").first().cells == ["1", "2"]
    kinds = spark.createDataFrame([(bytearray(b"%PDF-1.4"), ""), (bytearray(b"hello"), "text/csv; x"), (bytearray(b"plain words"), ""), (bytearray(range(32)), "")], "c binary, t string")
    assert [r.k for r in kinds.select(parsers.sniffed(F.col("c"), F.col("t")).alias("k")).collect()] == ["pdf", "csv", "txt", "bin"]


def test_limits_and_config():
    limits, rejected = Limits.configured({"max_columns": "7", "odd": 1, "max_sheets": "many", "max_file_mb": -1})
    assert limits.max_columns == 7 and limits.max_sheets == Limits().max_sheets and set(rejected) == {"odd", "max_sheets", "max_file_mb"}
    assert overlaid({"a": {"b": 1}, "c": 2}, {"a": {"d": 3}, "e": 4}) == {"a": {"b": 1, "d": 3}, "c": 2, "e": 4}
    assert overlaid({"a": {"b": 1}}, {"a": 5}) == {"a": 5} and overlaid({"a": 1}, {"a": {"b": 2}}) == {"a": {"b": 2}} and overlaid({"a": 1}, None) == {"a": 1}
