"""Main text against composite text density written plainly, and pages whose text stands under a noise name."""

import glob
import math
import random

import pyarrow.parquet as pq
import pytest

from quiremill.llm import html_text

P = "<p>" + "Main words here that make up a longer text, again. " * 8 + "</p>"


@pytest.mark.parametrize(
    ("html", "held", "left_out"),
    [
        (f"<body><header>Site</header><nav><a href=x>Home</a></nav><div class='notice'><h1>Head</h1>{P}{P}</div><footer>foot</footer>", "Head Main words", "Home"),
        (f"<body><nav><a>Menu</a></nav><div class='main search'>{P}</div><div class='sidebar'><p>side text</p></div>", "Main words", "side"),
        (f"<body><div class='legal'>{P}{P}</div><div class='comments'><p>{'I disagree. ' * 30}</p></div>", "Main words", "disagree"),
        (f"<body><article><h1>Head</h1>{P}<section class='discussion'><h2>Discussion</h2><p>We discuss the matter.</p></section></article>", "Discussion We discuss", "<"),
        (f"<body><div id=c><p>Short article text.</p></div><div class='comments'>{P}{P}{P}</div>", "Short article text.", "Main words"),
        (f"<body><div class='content'>{P}<div class='notice'>Mind the gap</div>{P}</div><div class='cookie-banner'>{P}{P}{P}{P}</div>", "Main words", "gap"),
        (f"<body><div class='widget'><div class=ad>Buy now</div><article>{P}</article></div>", "Main words", "Buy"),
        ("<body><div class='ad'><p>All there is.</p></div>", "All there is.", "<"),
        ("<div class='ad'>x</div>" * 3000 + P, "Main words", "x x"),
    ],
)
def test_named_noise(html, held, left_out):
    text = html_text.main_text(html)
    assert held in text and left_out not in text


def plain(html):
    """The same selection by recursion over whole subtrees."""
    root = html_text.without_noise(html_text.parse(html))
    kids = lambda n: [x for x in n.items if isinstance(x, html_text.Node)]
    below = lambda n: [y for x in kids(n) for y in (x, *below(x))]
    own = lambda n: "".join("".join(x.split()) for x in n.items if isinstance(x, str))
    chars = lambda n: len(own(n)) + sum(chars(x) for x in kids(n))
    links = lambda n: chars(n) if n.tag == "a" else sum(links(x) for x in kids(n))
    body_c, body_l = max(1, chars(root)), links(root)

    def density(n):
        c, t, lc, lt = chars(n), max(1, len(below(n))), links(n), sum(x.tag == "a" for x in below(n))
        if not c:
            return 0.0
        base = math.log(c / max(1, c - lc) * lc + body_l / body_c * c + math.e)
        value = math.log(max(1.0, c / max(1, lc) * t / max(1, lt)))
        return c / t * value / math.log(base) if base > 1 + 1e-9 else c / t * value

    total = lambda n: sum(density(x) for x in kids(n))
    # The first of equals in the order of levels.
    order, level = [], [root]
    while level:
        order += level
        level = [x for n in level for x in kids(n)]
    best = max(order, key=total)
    if total(best) <= 0:
        return " ".join(html_text.text_of(root, [root]).split()) if chars(root) else ""
    path, at = [], best
    while at is not None:
        path.append(at)
        at = at.parent
    least = min(density(n) for n in path)

    def richest(n):
        found = n if total(n) > 0 or not kids(n) else None
        for x in kids(n):
            y = richest(x)
            if y is not None and (found is None or total(y) > total(found)):
                found = y
        return found

    def chosen(n):
        if n is best:
            return [n]
        if n not in path and density(n) >= least and chars(n):
            x = richest(n)
            return [x] if x is not None and chars(x) else []
        return [y for x in kids(n) for y in chosen(x)]

    return html_text.text_of(root, chosen(root))


def test_pages_against_brute_force():
    for path in glob.glob("/root/testdata/sf0.001/pages.parquet"):
        for html in pq.read_table(path).column("html").to_pylist()[:60]:
            assert html_text.main_text(html) == plain(html)


def test_made_up_pages_against_brute_force():
    rng = random.Random(22)

    def part(depth):
        if depth == 0 or rng.random() < 0.2:
            words = " ".join(rng.choice(["one", "two", "three", "sentence"]) for _ in range(rng.randrange(1, 40)))
            return rng.choice([f"<p>{words}</p>", f"<a href=x>{words}</a>", words, f"<li>{words}"])
        tag, name = rng.choice(["div", "section", "ul", "td", "span"]), rng.choice(["", "", "", " class=ad", " class=notice", " id=body"])
        return f"<{tag}{name}>" + "".join(part(depth - 1) for _ in range(rng.randrange(1, 5))) + f"</{tag}>"

    for _ in range(150):
        html = "<body>" + "".join(part(4) for _ in range(rng.randrange(1, 4)))
        assert html_text.main_text(html) == plain(html)
