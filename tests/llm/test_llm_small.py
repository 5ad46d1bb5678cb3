"""Edge cases of each training-data operator: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from quiremill.llm import bpe, components, embed_dedup, fingerprint, html_text, license_scan, mixing, ngram_join, quality, sharding, url_filter
from quiremill.llm.common import shared_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, sources=None):
    return spark.createDataFrame([(i, t, "en", sources[i] if sources else "s", len(t or "")) for i, t in enumerate(texts)], DOCS)


@pytest.fixture(scope="module")
def ranks():
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 7))) for _ in range(n))


# 1


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    return license_scan.Model([prose(rng, 12) for _ in range(200)])


def test_license_families(model):
    assert model.accuracy > 0.97
    assert [s["family"] for s in model.scan("x\nReleased under the MIT License.\ny")] == ["mit"]
    assert [s["family"] for s in model.scan("Licensed under the Zorblax License.")] == ["unknown"]
    assert model.scan("She is a licensed physician.") == [] and model.scan(None) == [] and model.scan("") == []
    inside = "word " * 200 + "Licensed under the Apache License, Version 2.0. " + "word " * 200
    found = model.scan(inside)
    assert [s["family"] for s in found] == ["apache-2.0"] and "Apache License" in inside[found[0]["start"] : found[0]["end"]]


def test_license_scan_keeps_rows(spark, model):
    d = documents(spark, [None, "", "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-NC 4.0."]).withColumn("licenses", F.lit("clash"))
    out = license_scan.scan(d, model).collect()
    assert [len(r.licenses) for r in sorted(out, key=lambda r: r.doc_id)] == [0, 0, 1, 1]
    assert license_scan.scan(d.limit(0), model).count() == 0


# 2


def test_bpe_as_the_library(spark, ranks):
    rng = random.Random(2)
    texts = [None, "", "it's  we'll\n\n 12345 x", "a" * 3000, "日本語テキスト" * 50, "<|endoftext|>", "é\x1cx  y​  ", "".join(chr(rng.randrange(32, 0x2FFF)) for _ in range(500)), "same", "same"]
    c = bpe.Codec(ranks)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=c.ranks, special_tokens={})
    assert bpe.PATTERN == public_tokenizers.PATTERN
    d = documents(spark, texts).withColumn("ids", F.lit(1)).withColumn("_row", F.lit(2))
    out = sorted(bpe.round_trip(d, ranks).collect(), key=lambda r: r.doc_id)
    assert [r.ids for r in out] == [enc.encode_ordinary(t or "") for t in texts]
    assert [bytes(r.decoded) for r in out] == [(t or "").encode() for t in texts]
    assert out[0]["_row"] == 2
    again = bpe.decode(bpe.round_trip(d, ranks).drop("decoded"), ranks)
    assert {r.doc_id: bytes(r.decoded) for r in again.collect()}[4] == texts[4].encode()
    assert bpe.round_trip(d.limit(0), ranks).count() == 0


def test_bpe_stretches(ranks, monkeypatch):
    rng = random.Random(3)
    c, texts = bpe.Codec(ranks), [prose(rng, 300) + "  \n" * 40 + "z" * 90]
    whole = c.round_trip(texts)
    monkeypatch.setattr(bpe, "STRETCH", 37)
    assert c.round_trip(texts) == whole


# 3


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((40, 16))
    rows = []
    for i in range(600):
        v = base[rng.integers(40)] + rng.standard_normal(16) * rng.choice([0.0, 0.1, 0.25, 0.4])
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(2))))
    rows += [(600, None, 0), (601, [0.0] * 16, 0), (602, [float("nan")] * 16, 0), (603, [None] * 16, 0), (604, rows[0][1], None), (605, rows[0][1], rows[0][2]), (606, [], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("component", F.lit("clash"))
    got = {r.vec_id: r for r in embed_dedup.near_duplicates(df, tile=16).collect()}
    ok = [r for r in rows if r[2] is not None and r[0] not in (600, 601, 602, 603, 606)]
    x = np.array([r[1] for r in ok], np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = (x @ x.T >= 0.93) & (np.array([r[2] for r in ok])[:, None] == np.array([r[2] for r in ok]))
    np.fill_diagonal(link, False)
    root = np.arange(len(ok))
    while True:
        new = np.array([min([root[i], *root[link[i]]]) for i in range(len(ok))])
        if (new == root).all():
            break
        root = new
    assert len(got) == len(rows) and link.sum() > 1000
    for i, r in enumerate(ok):
        g = got[r[0]]
        assert (g.n_links, g.component_id, g.kept) == (link[i].sum(), ok[root[i]][0], ok[root[i]][0] == r[0])
    for i in (600, 601, 602, 603, 604, 606):
        assert tuple(got[i])[1:] == (0, i, True)
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_in_double_precision(spark):
    """A pair whose cosine is below the threshold in double precision and at it in single; vectors of other lengths, null ids, huge and tiny components."""
    e = 1e-9
    at = lambda c: [c, (1 - c * c) ** 0.5, 0.0]
    rows = [(1, [1.0, 0.0, 0.0], 0), (2, at(0.93 - e), 0), (3, [1e200, 0.0, 0.0], 1), (4, [x * 1e-200 for x in at(0.94)], 1), (5, [1.0, 0.0], 0), (6, [2.0, 0.0], 0), (None, [0.0, 0.0, 1.0], 2), (None, [0.0, 0.0, 1.0], 2), (9, [0.0, 0.1, 1.0], 2)]
    got = embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    links = {r.vec_id: (r.n_links, r.component_id) for r in got if r.vec_id is not None}
    assert links == {1: (0, 1), 2: (0, 2), 3: (1, 3), 4: (1, 3), 5: (1, 5), 6: (1, 5), 9: (2, 9)}
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(2, 9, False)] * 2


def test_components_of_a_long_chain(spark):
    pairs = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(7, 7), (500, 400), (400, 500)], "u long, v long")
    got = {r.node: r.component for r in components.components(pairs).collect()}
    assert {got[i] for i in range(61)} == {0} and got[500] == 400 and 7 in got


# 4


def shingle_set(text, size=4):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def test_ngram_join_against_brute_force(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(60):
        words = prose(rng, rng.choice([1, 3, 5, 12, 40, 150, 400])).split()
        for _ in range(rng.randrange(1, 6)):
            w = list(words)
            for _ in range(rng.randrange(0, 1 + len(w) // 25)):
                w[rng.randrange(len(w))] = prose(rng, 1)
            texts.append(" ".join(w) if rng.random() < 0.8 else " \n".join(w).upper())
    texts += [None, "", "  \n ", "x", "x", "X", " "]
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * k >= 85 * (len(sets[i]) + len(sets[j]) - k):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    df = documents(spark, texts).withColumn("node", F.lit(1)).withColumn("n_shingles", F.lit(2))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_classes(df, tile=4).collect()}
    assert got == {i: (len(sets[i]), find(i)) for i in range(len(texts))}
    assert ngram_join.similar_classes(df.limit(0)).count() == 0


def test_no_partner_within_the_bound_is_missed():
    rng = np.random.default_rng(6)
    for n in (6, 7, 13, 40, 200, 900):
        for _ in range(60):
            a = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
            for drop in (n // 14, n // 8, n // 7):
                b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 64, drop // 3, dtype=np.uint64)]))
                k = len(np.intersect1d(a, b))
                if 100 * k >= 85 * (len(a) + len(b) - k) and len(a) != k:
                    assert len(np.intersect1d(ngram_join.sketch_keys(a), ngram_join.sketch_keys(b)))
                    p, q = (np.frombuffer(ngram_join.parity(x), np.uint64)[None, :] for x in (a, b))
                    w = min(p.shape[1], q.shape[1])
                    assert np.bitwise_count(ngram_join.fold(p, w) ^ ngram_join.fold(q, w)).sum() <= len(a) + len(b) - 2 * k


def test_word_hashes_of_stretches(monkeypatch):
    raw = ("ab  Cd\t" * 50 + "x" * 300 + " end").encode()
    whole = ngram_join.word_hashes(raw)
    monkeypatch.setattr(ngram_join, "STRETCH", 16)
    assert (ngram_join.word_hashes(raw) == whole).all() and len(whole) == 102 and len(np.unique(whole)) == 4


# 5


def test_fingerprints(spark):
    rng = random.Random(7)
    a = prose(rng, 400)
    texts = [None, "", a, a, prose(rng, 3), " ".join(a.split()[:300] + prose(rng, 100).split()), "naïve 文 text of few words"]
    df = documents(spark, texts).withColumn("h", F.lit("clash")).withColumn("bins", F.lit(1))
    got = {r.doc_id: r for r in fingerprint.fingerprints_with_next(df).collect()}
    order = sorted(range(len(texts)), reverse=True)
    import hashlib

    for i, j in zip(order, [*order[1:], order[0]], strict=True):
        t, n = texts[i] or "", texts[j] or ""
        k = len(t) // 2
        edited = t[: len(t) - k] + n[:k]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        true = lambda x, y: len(shingle_set(x, 5) & shingle_set(y, 5)) / max(1, len(shingle_set(x, 5) | shingle_set(y, 5))) if x.split() or y.split() else 1.0
        assert abs(got[i].near_edited - true(t, edited)) < 0.15 and abs(got[i].near_next - true(t, n)) < 0.15
    assert got[2].fingerprint == got[3].fingerprint != got[5].fingerprint and got[0].fingerprint == got[1].fingerprint == ""
    assert fingerprint.fingerprints_with_next(df.limit(0)).count() == 0
    assert fingerprint.fingerprints_with_next(df.limit(3).unionAll(df.limit(3))).count() == 6


# 6


def test_sharding(spark):
    rng = random.Random(8)
    texts = [None, "", *("x" * rng.randrange(1, 3000) for _ in range(500)), "same", "same"]
    df = documents(spark, texts).withColumn("slot", F.lit(1)).withColumn("shard", F.lit(1))
    path = shared_path(spark, "map")
    got = sharding.shard(df, path, 8).collect()
    assert all(r.size == len(texts[r.doc_id] or "") + 1 and r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) for r in got)
    held, places = Counter(), defaultdict(list)
    for r in got:
        held[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(held.values()) < 1.02 * min(held.values())
    loads = [(r.slot, r.bytes, r.rows) for r in sharding.load_map(spark, path).collect()]
    old = {r.slot: r.shard for r in sharding.load_map(spark, path, 0).collect()}
    new = sharding.grown_map(old, loads)
    moved = {s for s in old if old[s] != new[s]}
    assert moved and all(new[s] == 8 for s in moved)
    again = sharding.shard(df, path, 8)
    assert sorted((r.doc_id, r.shard) for r in again.collect()) == sorted((r.doc_id, r.shard) for r in got)
    assert sharding.load_map(spark, path).first().version == 0
    sharding.store_map(spark, sharding.map_rows(new, loads, 1), path)
    assert sharding.load_map(spark, path).select("version").distinct().collect()[0][0] == 1
    assert sharding.shard(df.limit(0), shared_path(spark, "map"), 8).count() == 0


def test_sharding_edits_its_map(spark):
    """More rows of one kind: few slots move, and the newest version is what later runs load. Rows repeated often and null ids are numbered without gaps."""
    rng = random.Random(18)
    df = spark.createDataFrame([(i, "x" * rng.randrange(1, 400)) for i in range(3000)] + [(None, "y" * rng.randrange(1, 90)) for _ in range(300)] + [(7, "same")] * 400, "doc_id long, text string").repartition(9)
    path = shared_path(spark, "map")
    first = {(r.doc_id, r.size, r.text_crc32): r.shard for r in sharding.shard(df, path, 8).collect()}
    heavy = [s for s in range(8)]
    more = spark.createDataFrame([(i, "z" * (3000 if i % 3 else 10)) for i in range(10_000, 10_400)], "doc_id long, text string")
    got = sharding.shard(df.unionAll(more), path, 8).collect()
    held, places = Counter(), defaultdict(list)
    for r in got:
        held[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert len(got) == 4100 and all(sorted(p) == list(range(len(p))) for p in places.values()) and sorted(held) == heavy
    assert max(held.values()) < 1.02 * min(held.values())
    assert sharding.load_map(spark, path).first().version == 1 and sharding.load_map(spark, path, 0).count() > 0
    stayed = sum(first[k] == r.shard for r in got if (k := (r.doc_id, r.size, r.text_crc32)) in first)
    assert stayed > 0.7 * 3700


# 7


def test_quality(spark):
    rng = random.Random(9)
    good = [prose(rng, 40) for _ in range(150)]
    bad = [" ".join(w + "###" for w in prose(rng, 40).split()) for _ in range(50)]
    df = documents(spark, [*good, *bad, None, "", good[0]]).withColumn("id", F.lit("clash")).withColumn("good", F.lit(1))
    labels = spark.createDataFrame([(i, int(i < 150), 0) for i in range(0, 200, 2)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id: r.kept for r in quality.resample(df, labels).collect()}
    assert [i for i in range(150) if not kept[i]] == [] and [i for i in range(150, 202) if kept[i]] == [] and kept[202]
    assert quality.resample(df.limit(0), labels).count() == 0
    assert quality.resample(df, labels.limit(0)).where("kept").count() == 201


def test_quality_against_brute_force(spark, monkeypatch):
    """Weights are sums of log ratios of counted n-grams, and the k with the largest noisy weights are kept, not the k with the largest weights."""
    import hashlib
    import math
    import re

    rng = random.Random(19)
    texts = [" ".join(rng.choice(["one", "Two", "3", "four!", "five"] if i % 3 else ["one", "six", "se-ven", "Two"]) for _ in range(rng.randrange(1, 9))) for i in range(300)] + [None, "", "  ", "word " * 500]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(100)], "doc_id long, quality int, toxic int")
    features = quality.Features()
    grams = [Counter(np.concatenate([*features(t), np.empty(0, np.int64)]).tolist()) for t in texts]
    for t, g in zip(texts, grams, strict=True):  # words once each, two grams for each pair of neighbours
        n = len(re.findall(r"\w+|[^\w\s]+", t or ""))
        assert sum(g.values()) == max(0, 3 * n - 2)
    raw, target = sum(grams, Counter()), sum((grams[i] for i in range(100) if i % 3), Counter())
    part = sum(target.values()) / sum(raw.values())
    weight = [sum(n * math.log((target[b] + 300 * part) / (part * (raw[b] + 300))) for b, n in g.items()) if g else None for g in grams]
    noise = [-math.log(-math.log((int(hashlib.md5(f"gumbel:{i}".encode()).hexdigest()[:12], 16) + 0.5) / (1 << 48))) for i in range(len(texts))]
    got = {r.doc_id: r for r in quality.resample(documents(spark, texts), labels, k=120).collect()}
    score = {i: w + e for i, (w, e) in enumerate(zip(weight, noise, strict=True)) if w is not None}
    assert all(got[i].log_weight is None if w is None else abs(got[i].log_weight - w) < 1e-6 for i, w in enumerate(weight))
    drawn = set(sorted(score, key=score.get)[-120:])
    assert {i for i, r in got.items() if r.kept} == drawn != set(sorted(score, key=lambda i: weight[i])[-120:])
    some = quality.resample(documents(spark, texts), labels).where("kept").count()
    assert some == round(sum(min(1, math.exp(w)) for w in weight if w is not None))
    monkeypatch.setattr(quality, "STRETCH", 7)
    assert [Counter(np.concatenate([*features(t), np.empty(0, np.int64)]).tolist()) for t in texts] == grams


def test_kth_largest(spark):
    rng = random.Random(10)
    xs = [rng.choice([rng.gauss(0, 1), 0.5, -1e6]) for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in xs], "score double")
    for k in (1, 7, 250, 499, 500, 900):
        assert quality.kth_largest(df, k, 16) == sorted(xs, reverse=True)[min(k, 500) - 1]


# 8


def test_url_filter(spark):
    from quiremill.llm.queries import URL_RULES

    urls = ["http://A.org/x", "https://example.org/es/1", "http://w.Example.org/en/12#q", "http://example.org/en/2", "http://org", "http://org?x", "http://x.com/fr/", "http://x.com/de/a?b", "http://badexample.com/es/", "nothing", None, "ftp://u@x.org:80/a", "http://aorg/", "http://x.com/fr/", "://org/"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(0, urls[0], "h")], "page_id long, url string, host string")
    got = url_filter.judge_urls(df, url_filter.rules_frame(spark, URL_RULES)).collect()
    assert len(got) == len(urls) + 1

    def brute(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        import re

        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fits = [(h + p, a) for h, p, a in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, action = max(fits, key=lambda x: len(x[0]), default=(None, "allow"))
        return host, path, rule, action

    assert sorted((r.page_id, r.host, r.path, r.rule or "", r.verdict) for r in got) == sorted((i, *(x or "" for x in brute(u))) for i, u in [*enumerate(urls), (0, urls[0])])
    assert url_filter.judge_urls(df.limit(0), url_filter.rules_frame(spark, URL_RULES)).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(df, url_filter.rules_frame(spark, URL_RULES).limit(0)).collect()} == {"allow"}


# 9


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("just words", "just words"),
        ("<body><nav><a href=x>Menu</a></nav><article><h1>Head</h1><p>First <b>bold</b>&amp;co.<p>Second\n para&eacute;</article><footer>foot</footer>", "Head First bold&co. Second paraé"),
        ("<body><header>Site</header><div class='sidebar'>side text that is long enough to matter</div><div id=main><p>" + "Main words here. " * 20 + "</p><p>More.</p></div><div class='comments'><p>" + "I disagree. " * 40 + "</p></div></body>", ("Main words here. " * 20).strip() + " More."),
        ("<article><p>Text that counts.</p><div class='ad'>Buy!</div><aside>Note</aside><form><input><p>Sign up</form><script>var x='</p>'</script><p>And more text.</p></article><div class=cookie-notice>We use cookies</div>", "Text that counts. And more text."),
        ("<article><p>Cut off page te", "Cut off page te"),
        ("<article><p>Cut off tag</p><p cla", "Cut off tag"),
        ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>", "one two a b"),
    ],
)
def test_main_text(html, text):
    assert html_text.main_text(html) == text


def test_main_text_nested_deeply():
    assert html_text.main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"


def test_extract_keeps_rows(spark):
    df = spark.createDataFrame([(1, "u", None, "old"), (1, "u", "<p>x</p>", "old")], "page_id long, url string, html string, text string")
    assert sorted(r.text for r in html_text.extract(df).collect()) == ["", "x"]
    assert html_text.extract(df.limit(0)).count() == 0


# 10


def brute_targets(sizes, share=1.5):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not over:
            return out | {s: weight[s] * level for s in free}
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        free -= over
    return out


def test_mixing(spark):
    rng = random.Random(11)
    names = ["a", "b", "Z", "é", None, "empty"]
    texts, sources = [], []
    for _ in range(800):
        sources.append(rng.choice([*names[:5], "b", "b"]))
        texts.append(prose(rng, int(rng.lognormvariate(3, 1)) + 1))
    texts += [None, "", "one"]
    sources += ["empty", "empty", None]
    df = documents(spark, texts, sources).withColumn("size", F.lit("clash")).withColumn("cell", F.lit(1))
    got = mixing.mix(df, cells=64).collect()
    sizes = Counter()
    for r in got:
        assert r.size == len((texts[r.doc_id] or "").split()) and r.taken <= 2 * r.size and r.taken == r.copies * r.size
        sizes[r.source] += r.size
    want, taken = brute_targets(dict(sizes)), Counter()
    for r in got:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
    for s, t in want.items():
        assert abs(taken[s] - t) <= 0.02 * t + 1
    key = lambda rows: sorted((r.doc_id, r.taken) for r in rows)
    assert key(got) == key(mixing.mix(df.repartition(7)).collect()) and mixing.mix(df.limit(0)).count() == 0
    assert mixing.mix(df.unionAll(df)).count() == 2 * len(got)


def test_mixing_takes_tied_rows_one_by_one(spark):
    rows = [(None, "w " * 10, "a")] * 600 + [(i, "w " * 11, "b") for i in range(900)] + [(7, "x " * 5, None)] * 40 + [(8, "x " * 3, None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6).withColumn("rid", F.lit("clash"))
    got = mixing.mix(df, keep=["rid"]).collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 2 * r.size and r.rid == "clash"
    assert len(got) == len(rows) and all(abs(taken[s] - target[s]) <= {"a": 10, "b": 11, None: 5}[s] for s in target)


def test_mixing_ranks_by_odds_over_size(spark):
    """Long documents are drawn once more oftener than short ones, by their odds."""
    rng = random.Random(12)
    rows = [(i, "w " * rng.choice([10, 100]), "a") for i in range(4000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), share=1.2).collect()
    share = {n: sum(r.copies == 2 for r in got if r.size == n) / sum(r.size == n for r in got) for n in (10, 100)}
    odds = lambda p: p / (1 - p)
    assert 6 < odds(share[100]) / odds(share[10]) < 16
    rank = sorted((r for r in got), key=lambda r: (lambda u: u / (1 - u) / r.size)((int(__import__("hashlib").md5(f"mix:{r.doc_id}".encode()).hexdigest()[:12], 16) + 0.5) / (1 << 48)))
    drawn = [r.copies == 2 for r in rank]
    assert drawn[: sum(drawn) - 1] == [True] * (sum(drawn) - 1)


def test_runs_of_heavy_keys(spark, monkeypatch):
    """Dealing heavy keys into runs of their own changes no result; centres of a key's runs become one."""
    rng = np.random.default_rng(23)
    keys, nodes = rng.integers(-(1 << 62), 1 << 62, 50), rng.integers(-(1 << 62), 1 << 62, 400)
    k, n = np.repeat(keys, 8), nodes
    run = ngram_join.run_names(k, n, np.ones(ngram_join.CELLS, bool))
    assert (ngram_join.key_of(run, n) == k & ~1).all() and (run & 1 == 1).all()
    assert (ngram_join.run_names(k, n, np.zeros(ngram_join.CELLS, bool)) == k & ~1).all()
    words = [prose(random.Random(24), 60).split() for _ in range(3)]
    texts = []
    for i in range(90):
        w = list(words[i % 3])
        w[(7 * i) % 60] = f"new{i}"
        texts.append(" ".join(w))
    df = documents(spark, texts)
    want = sorted(tuple(r) for r in ngram_join.similar_classes(df, tile=8).collect())
    monkeypatch.setattr(ngram_join, "HEAVY", 0)
    monkeypatch.setattr(ngram_join, "heavy_cells", lambda *a: np.ones(ngram_join.CELLS, bool))
    assert sorted(tuple(r) for r in ngram_join.similar_classes(df, tile=8).collect()) == want and len({r[2] for r in want}) < 90
