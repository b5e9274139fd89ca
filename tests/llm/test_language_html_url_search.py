"""Language profiles, main text, url rules and pivot search."""

import math
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimworks.llm import html_text, language, pivot_search, url_rules

from .conftest import edge_rows, prose

FRENCH = "le la les des une dans pour avec sont mais nous vous cette être était comme plus tout bien aussi deux même après"


def labelled(llm):
    rows = [(i, prose(i, 60) if i % 2 else " ".join(FRENCH.split()[j * (i + 3) % 23] for j in range(60)),
             "en" if i % 2 else "fr") for i in range(80)]
    return llm.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language_is_learned_and_held_out(llm):
    docs = labelled(llm)
    profiles = language.learn(docs.filter(~language.held_out(F.col("doc_id"))))
    got = language.predict(docs, profiles).join(docs, "doc_id").collect()
    assert all(r.lang_pred == r.lang and 0.5 < r.score <= 1 for r in got)
    import zlib
    held = {r[0] for r in docs.filter(language.held_out(F.col("doc_id"))).select("doc_id").collect()}
    assert held == {i for i in range(80) if zlib.crc32(str(i).encode()) % 4 == 2}


def test_language_edges(llm, edge, empty):
    profiles = language.learn(labelled(llm))
    rows = language.predict(edge, profiles).collect()
    assert Counter(r.doc_id for r in rows) == Counter(d for d, *_ in edge_rows())
    unknown = Counter(r.doc_id for r in rows if r.lang_pred == "und")
    assert unknown == Counter(d for d, t, *_ in edge_rows() if not any(c.isalpha() for c in t or ""))
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert language.predict(empty, profiles).count() == 0
    assert {r.lang_pred for r in language.predict(edge, language.learn(empty)).collect()} == {"und"}


def test_trigrams_and_bundles():
    codes, counts = language.trigrams("Ab, ab! b")
    a, b = ord("a"), ord("b")
    want = {(0, a, b): 2, (a, b, 0): 2, (0, b, 0): 1}
    assert dict(zip(codes.tolist(), counts.tolist())) == {x << 42 | y << 21 | z: n for (x, y, z), n in want.items()}
    v = language.Vectors(64, 3)
    one = sum(n * np.roll(v.letter(x), 2).astype(int) * np.roll(v.letter(y), 1) * v.letter(z) for (x, y, z), n in want.items())
    assert (v.bundle(codes, counts) == one).all()
    text = prose(2, 500)
    whole, cut = language.trigrams(text), Counter()
    for piece in list(language.segments(text, 100)):
        cut.update(dict(zip(*(x.tolist() for x in language.trigrams(piece)))))
    assert dict(zip(*(x.tolist() for x in whole))) == cut


def grams_of(text):
    """Trigrams of the words of a text, with an edge on each side, one after the other."""
    words, now = [], []
    for c in (text or "").lower() + " ":
        if c.isalpha():
            now.append(ord(c))
        elif now:
            words.append([0, *now, 0])
            now = []
    return Counter(tuple(w[i:i + 3]) for w in words for i in range(len(w) - 2))


class PlainLanguages:
    """Profiles, predictions and rejections from their definitions, with vectors as plain lists."""

    def __init__(self, rows):
        self.letters = {}
        self.sums = {}
        for text, lang in rows:
            if text is not None and lang is not None:
                self.sums[lang] = self.sums.get(lang, 0) + self.bundle(grams_of(text))
        self.unit = {k: self.normed(v) for k, v in self.sums.items()}
        shared = sum(self.unit.values()) / len(self.unit) if len(self.unit) > 1 else 0
        self.centred = {k: self.normed(v - shared) for k, v in self.unit.items()}

    def letter(self, code):
        if code not in self.letters:
            self.letters[code] = np.random.default_rng([language.SEED, code]).integers(0, 2, language.DIMENSIONS, np.int8).astype(float) * 2 - 1
        return self.letters[code]

    def bundle(self, grams):
        out = np.zeros(language.DIMENSIONS)
        for (a, b, c), n in grams.items():
            x, y, z = self.letter(a), self.letter(b), self.letter(c)
            out += n * np.array([x[i - 2] * y[i - 1] * z[i] for i in range(language.DIMENSIONS)])
        return out

    @staticmethod
    def normed(v):
        size = math.sqrt(float((v * v).sum()))
        return v / size if size else v

    def predict(self, text):
        grams = grams_of(text)
        if not grams or not self.centred:
            return "und", 0.0
        v = self.normed(self.bundle(grams))
        score, name = max(((float(p @ v), k) for k, p in self.centred.items()), key=lambda x: (round(x[0], 12), [-ord(c) for c in x[1]]))
        return name, (1 + score) / 2

    def kept(self, rows, texts):
        medians = {}
        for text, lang in rows:
            grams = grams_of(text)
            if lang is not None and grams:
                medians.setdefault((lang, len(grams).bit_length()), []).append(float(self.unit[lang] @ self.normed(self.bundle(grams))))
        medians = {k: sorted(v)[-(-len(v) // 2) - 1] for k, v in medians.items() if len(v) >= language.LEAST_TEXTS}
        out = []
        for text in texts:
            grams = grams_of(text)
            v = self.normed(self.bundle(grams))
            for lang in self.unit if grams else ():
                sizes = [b for k, b in medians if k == lang and b <= len(grams).bit_length()]
                if not sizes or self.unit[lang] @ v >= language.LEAST_PART * medians[lang, max(sizes)]:
                    out.append(text)
                    break
        return out


def test_language_against_a_plain_version(llm):
    docs = labelled(llm).unionByName(llm.createDataFrame(
        [(100, None, "en"), (101, "Ünïcode ǅ ﬁ naïve", "fr"), (102, "12 34", None), (103, prose(5, 9), None), (104, "xq zzkw jjq", "en")],
        "doc_id long, text string, lang string"))
    rows = [(r.text, r.lang) for r in docs.collect()]
    plain, learned = PlainLanguages(rows), language.learn(docs)
    assert sorted(learned) == sorted(plain.centred)
    assert all(np.allclose(learned[k], plain.centred[k], atol=1e-9) for k in learned)
    for r in language.predict(docs, learned).join(docs, "doc_id").collect():
        name, score = plain.predict(r.text)
        assert r.lang_pred == name and r.score == pytest.approx(score, abs=1e-9)
    unit = language.learn_plain(docs)
    texts = [*(t for t, _ in rows), "kkkkk wwwww qqqqq " * 30, "tänä aamuna naapurin kissa oli piiloutunut puutarhan " * 9, prose(77, 200)]
    asked = llm.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    stay = language.resembling(asked, unit, language.typical(docs, unit))
    assert Counter(r.text for r in stay.collect()) == Counter(plain.kept(rows, texts))
    assert 0 < stay.count() < len(texts)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a><li><a href="/x">X</a></ul></nav>
<div class="cookie-notice">We use cookies, many of them, on every page of this site.</div>%s
<div class="sidebar"><p>Other things to read on this site.</p></div><form><label>Mail</label><input></form>
<section id="comments"><h2>Comments</h2><p>First! I liked this a lot and want to say so at length here.</p></section>
<footer>&copy; 2024 somebody</footer></body></html>"""
BODY = "<h2>Head&nbsp;line</h2><p>First <b>bold</b> text &amp; more of it,\n all on one   line.<p>Second para&#103;raph, un<i>closed<br>"


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main><article>%s</article></main>", "<div class=story>%s</div>",
                                  "<div><div id=content>%s</div></div>", "<article><div class=ad>Buy now</div>%s</article>"])
def test_main_text(wrap):
    got = html_text.main_text(PAGE % (wrap % BODY))
    assert got == "Head line First bold text & more of it, all on one line. Second paragraph, unclosed"


def test_main_text_of_parts_and_broken_pages():
    parts = "".join(f"<div class=part><p>{prose(i, 40)}</p><p>{prose(i + 50, 40)}</p></div>" for i in range(4))
    want = " ".join(f"{prose(i, 40)} {prose(i + 50, 40)}" for i in range(4))
    assert html_text.main_text(PAGE % f"<div id=content>{parts}</div>") == want
    assert html_text.main_text("plain &lt;text&gt;") == "plain <text>"
    for page in (None, "", "   ", "<", "<p", "<!-- open", "<script>x", "</p></div>", "<a href='x>"):
        assert isinstance(html_text.main_text(page), str)
    assert html_text.main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert html_text.main_text("<p>" + prose(1, 30_000) + "</p>") == prose(1, 30_000)


def test_layouts_and_comments():
    story = f"<article><h1>T</h1><p>{prose(1, 30)}</p></article>"
    want = "T " + prose(1, 30)
    assert html_text.main_text(f'<div class="page with-sidebar">{story}<div class="sidebar">{prose(2, 90)}</div></div>') == want
    talk = "".join(f'<article class="comment"><p>{prose(i, 40)}</p></article>' for i in range(5))
    assert html_text.main_text(f'{story}<section class="comments">{talk}</section>') == want
    inner = f'<article><h1>T</h1><p>{prose(1, 30)}</p><div id="comments"><article><p>{prose(3, 80)}</p></article></div></article>'
    assert html_text.main_text(inner) == want
    assert html_text.main_text(f'<div class="site-header">Name</div>{story}') == want


def test_articles_only_widen_the_core():
    cards = "".join(f'<article><h3><a href="/{i}">Card {i}</a></h3><p>{prose(i, 8)} <a href="/{i}">{prose(i + 9, 12)}</a></p></article>'
                    for i in range(3))
    real = "".join(f"<p>{prose(i + 20, 60)}</p>" for i in range(5))
    want = " ".join(prose(i + 20, 60) for i in range(5))
    assert html_text.main_text(PAGE % f"{cards}<div class=story>{real}</div>{cards}") == want
    assert html_text.main_text(PAGE % f"<main><div>{cards}</div></main><div class=story>{real}</div>") == want
    split = "".join(f"<article><p>{prose(i + 20, 60)}</p></article>" for i in range(5))
    assert html_text.main_text(PAGE % f"<div class=story>{split}</div>") == want
    uneven = f"<article><p>{prose(20, 60)}</p><p>{prose(21, 60)}</p><p>{prose(22, 60)}</p></article>" \
             f"<article><p>{prose(23, 60)}</p><p>{prose(24, 60)}</p></article>"
    assert html_text.main_text(PAGE % f"<div class=story>{uneven}</div>") == want


def test_tags_without_a_close_tag_lose_nothing():
    first, rest = prose(1, 40), prose(2, 40)
    page = "<article><p>" + first + "</p>%s<p>" + rest + "</p></article>"
    both = f"{first} {rest}"
    for odd in ('<svg width="1"/>', "<math/>", '<svg width="1"><path d="M0"/>', "<svg><g>", "<select><option>One<option>Two",
                "<math>", '<iframe src="x">', '<iframe src="x"/>', "<object data='x'>", "<object data='x'/>", "<textarea>",
                "<noscript>", "<template>", "<title>", "<svg><text>no</text></svg>", "<select><option>One</option></select>",
                "<script>var a = '<p>';</script>", "<style>p{}</style>", "<textarea><p>no</p></textarea>",
                "<iframe><p>no</p></iframe>", "<template><p>no</p></template>"):
        assert html_text.main_text(page % odd) == both, odd
        later = odd + "<p>" + prose(3, 20) + "</p><iframe>no</iframe><svg><text>no</text></svg><select><option>no</select>"
        assert html_text.main_text(page % later) == f"{first} {prose(3, 20)} {rest}", odd
    assert html_text.main_text(page % "<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p>") == f"{first} so x=1 holds {rest}"
    assert html_text.main_text(page % "<p>so <math><mi>x</mi> holds</p>") == f"{first} so x holds {rest}"
    assert html_text.main_text(page % "<object data='x'><p>instead</p></object>") == f"{first} instead {rest}"
    assert html_text.main_text(page % "<svg><foreignObject><p>no</p></foreignObject></svg>") == both


STORY = "".join(f"<p>{prose(i + 20, 60)}</p>" for i in range(3))
TOLD = " ".join(prose(i + 20, 60) for i in range(3))


@pytest.mark.parametrize("around", [
    '<div class="elementor-widget elementor-widget-text-editor">%s</div>', '<div class="widget">%s</div>', '<div class="header">%s</div>',
    '<div id="share">%s</div>', '<div class="alert">%s</div>', '<div class="toolbar main">%s</div>', '<div class="skip">%s</div>',
    '<div class="no-sidebar page">%s</div>', '<div class="sidebar">%s</div>', '<div style="overflow:hidden" data-id="comments">%s</div>',
    '<body class="header-fixed has-nav"><div>%s</div></body>', '<div class="ad"><div class="nav">%s</div></div>'])
def test_a_name_around_the_story_loses_nothing(around):
    assert html_text.main_text(PAGE % (around % STORY)) == TOLD
    assert html_text.main_text(PAGE % (around % f"<article>{STORY}</article>")) == TOLD


@pytest.mark.parametrize("part, text", [
    ('<p>costs <span class="share-price">12.40</span> now</p>', "costs 12.40 now"), ('<p class="related-work">Others did.</p>', "Others did."),
    ('<section class="discussion"><p>We discuss.</p></section>', "We discuss."), ('<div class="alert">Mind the gap.</div>', "Mind the gap."),
    ('<div class="share">A share of it.</div>', "A share of it."), ('<h2 id="search">How we search</h2>', "How we search"),
    ('<table id="notice"><tr><td>x</td></tr></table>', "x"), ('<header><h2>Inner</h2></header>', "Inner"),
    ('<div class="related"><a href="/1">One</a> <a href="/2">Two</a></div>', ""), ('<ul class="share-buttons"><li><a href="#">Post</a></ul>', ""),
    ('<div class="ad">Buy</div>', ""), ('<div class="ad-container">Buy</div>', ""), ('<div class="newsletter-signup">Mail us</div>', ""),
    ('<div id="comments"><p>First!</p></div>', ""), ('<div class="cookie-consent-banner">We use them.</div>', ""),
    ('<div hidden>no</div>', ""), ('<div aria-hidden=true>no</div>', ""), ('<div role="search">no</div>', "")])
def test_parts_of_an_article(part, text):
    want = " ".join(filter(None, [prose(20, 60), text, prose(21, 60), prose(22, 60)]))
    page = STORY.replace("</p>", "</p>" + part, 1)
    assert html_text.main_text(f"<article>{page}</article>") == want
    assert html_text.main_text(PAGE % f"<article>{page}</article>") == want


@pytest.mark.parametrize("page", [
    "<div>" * 100_000 + "deep" + "</div>" * 100_000, "<div>x<b>" * 50_000, "<div>x</b>" * 50_000, "<b>" * 50_000 + "<p>x" * 50_000,
    "<b>" * 30_000 + "<hr>x" * 30_000, "<svg><foreignObject>" + "<div>x" * 50_000, "<ul><li>x" * 30_000, "<table><tr><td>x" * 20_000,
    "<div class=nav>" * 30_000 + "<article>x</article>" * 30_000, "<ul>" + "<b>" * 30_000 + "<li>x</li>" * 30_000,
    "<!x" * 100_000, "<a" * 100_000, "<p '>x" * 50_000, "</" * 100_000, "<!--" * 50_000, "<tbody>" * 20_000 + "<tr></tr>" * 20_000,
    "<p " + "class=x " * 50_000 + ">x", "<p id" + " " * 100_000 + "x>y", "<select><option>" * 30_000, "&amp" * 100_000], ids=lambda p: p[:24])
def test_time_grows_with_the_page(page):
    start = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - start < 4


def generated(seed):
    """A tree of (tag, parts) and its page; texts are plain words."""
    x = [seed * 2654435761 % 2 ** 32]

    def roll(n):
        x[0] = (x[0] * 1103515245 + 12345) % 2 ** 31
        return x[0] // 65536 % n

    def grow(depth):
        parts = []
        for _ in range(1 + roll(4)):
            kind = roll(6 if depth < 5 else 2)
            if kind < 2:
                parts.append(prose(roll(999), 1 + roll(30)))
            elif kind == 2:
                parts.append(("a", [prose(roll(999), 1 + roll(9))]))
            else:
                parts.append((("div", "section", "blockquote", "article", "span")[roll(4 + (kind == 3))], grow(depth + 1)))
        return parts

    def page(parts):
        return " ".join(p if isinstance(p, str) else f"<{p[0]}>{page(p[1])}</{p[0]}>" for p in parts)

    tree = ("body", grow(0))
    return tree, page(tree[1])


def plainly(tree):
    """Densities, sums, threshold and choice by their definitions, each from scratch."""
    every = []

    def visit(node, path):
        every.append((node, path))
        for p in node[1]:
            if not isinstance(p, str):
                visit(p, [*path, node])

    visit(tree, [])

    def below(node):
        return [p for p in node[1] if not isinstance(p, str)]

    def chars(node):
        return sum(len(" ".join(p.split())) if isinstance(p, str) else chars(p) for p in node[1])

    def tags(node):
        return sum(1 + tags(p) for p in below(node))

    def links(node):
        if node[0] == "a":
            return chars(node), 1 + sum(links(p)[1] for p in below(node))
        return sum(links(p)[0] for p in below(node)), sum(links(p)[1] for p in below(node))

    def density(node):
        c, t, (lc, lt) = chars(node), max(1, tags(node)), links(node)
        lc, lt = max(1, lc), max(1, lt)
        if not c:
            return 0.0
        base = math.log(c * lc / max(1, c - lc) + links(tree)[0] / max(1, chars(tree)) * c + math.e)
        return max(0.0, c / t * math.log(max(1.0, c * t / (lc * lt))) / max(base, 1e-9))

    def total(node):
        return sum(len(" ".join(p.split())) for p in node[1] if isinstance(p, str)) + sum(map(density, below(node)))

    best = max(range(len(every)), key=lambda i: (total(every[i][0]), -i))
    core, path = every[best]
    threshold = min(map(density, [core, *path]))
    around = [i for i, n in enumerate([*path, core]) if n[0] == "article"]
    if around:
        core, path = [*path, core][around[0]], [*path, core][:around[0]]
    on_path = {id(n) for n in [core, *path]}
    kept = {id(core)} | {id(p) for n in path for p in below(n) if id(p) not in on_path and 0 < density(p) >= threshold
                         and 2 * links(p)[0] < chars(p) and p[0] not in ("a", "span")}

    def text(node):
        inner = " ".join(p if isinstance(p, str) else text(p) for p in node[1])
        return " ".join(inner.split())

    return " ".join(filter(None, (text(n) for n, _ in every if id(n) in kept)))


@pytest.mark.parametrize("seed", range(60))
def test_choice_against_a_plain_version(seed):
    tree, page = generated(seed)
    assert html_text.main_text(page) == plainly(tree)


def test_extract_rows(llm):
    rows = [(1, "u", None), (None, None, "<p>x y</p>"), (2, "u", ""), (2, "u", "")]
    pages = llm.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit(1), "n_chars": F.lit("q")})
    got = html_text.extract(pages).collect()
    assert Counter(map(tuple, got)) == Counter([(1, "u", "", 0), (None, None, "x y", 3), (2, "u", "", 0), (2, "u", "", 0)])
    assert html_text.extract(pages.limit(0)).count() == 0


def test_density_formula():
    root = html_text.parse("<div>abcd<a>ef</a></div>")
    nodes = {n.tag: n for n in html_text.measure(root)}
    c, t, lc, lt = 6, 1, 2, 1
    base = math.log(c * lc / (c - lc) + 2 / 6 * c + math.e)
    assert nodes["div"].density == pytest.approx(c / t * max(0, math.log(c * t / (lc * lt))) / base)


URLS = ["http://a.org/x", "HTTP://EXAMPLE.org/es/1?q=1", "https://b.example.org/en/12#f", "https://example.org", "http://x.com/fr/",
        "http://y.x.com/de/3", "http://com/de/", "no scheme", None, "", "://", "http://notexample.org/es/", "http://z.net?x=/es/",
        "http://ÄB.Org/é", "ftp://h.com:80/fr/", "http://q.com/frx", "a://b://c.org/d"]


def plain_parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    path = rest[:min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(url):
    host, path = plain_parts(url)
    fits = [(h + p, v) for h, p, v in url_rules.LISTED if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0])) if fits else (None, None)


def test_listed_rules(llm):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, URLS[0]), (0, URLS[0])]
    pages = llm.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit("h"), "token": F.lit("t")})
    labels = llm.createDataFrame([(0, True), (1, None), (None, True)], "page_id long, blocked boolean")
    got = url_rules.judge(pages, labels).collect()
    assert Counter((r.page_id, r.host, r.path, r.rule) for r in got) == Counter(
        (i, *plain_parts(u), plain_rule(u)[0]) for i, u in rows)
    assert all(r.verdict == plain_rule(dict(rows)[r.page_id])[1] for r in got if r.rule and r.page_id is not None)
    assert url_rules.judge(pages.limit(0), labels).count() == 0
    assert {r.mined for r in url_rules.judge(pages, labels.limit(0)).collect()} == {None}


def test_long_hosts_and_paths_take_no_longer_than_their_length(llm):
    long_host = ".".join("abcdefghij"[i % 10] for i in range(100_000))
    rows = [(1, f"http://{long_host}/x"), (2, "http://h.org/" + "p/" * 50_000), (3, "http://h.org/?" + "a=1&" * 50_000),
            (4, f"http://{'a.' * 120}com/fr/"), (5, f"http://{'a' * 300}.org/y")]
    pages = llm.createDataFrame(rows, "page_id long, url string")
    labels = llm.createDataFrame([(i, i < 3) for i in range(6)], "page_id long, blocked boolean")
    start = time.time()
    got = {r.page_id: r for r in url_rules.judge(pages, labels).collect()}
    assert time.time() - start < 60 and len(got) == 5
    assert [got[i].rule for i in range(1, 6)] == [None, "org/", "org/", "com/fr/", "org/"]
    have = {r.page_id: r.t for r in pages.select("page_id", url_rules.tokens(F.col("url")).alias("t")).collect()}
    assert [t for t in have[1] if t.startswith("domain:")] == [f"domain:{long_host}"]
    assert sum(t.startswith("domain:") for t in have[4]) == 121


def test_mined_rules_match_brute_force(llm):
    rows = [(i, f"http://s{i % 7}.net/{'win' if i % 5 == 0 else 'read'}/{'now' if i % 2 else 'old'}/{i}") for i in range(210)]
    pages = llm.createDataFrame(rows, "page_id long, url string")
    bad = {i for i in range(210) if i % 5 == 0 and i % 2}
    labels = llm.createDataFrame([(i, i in bad) for i in range(140)], "page_id long, blocked boolean")
    fit = {"min_support": 0.03, "min_confidence": 0.8}
    known = pages.join(labels, "page_id").select("url", "blocked")
    rules = url_rules.mine(known, **fit).collect()
    assert ["path:now", "path:win"] in [sorted(r.rule_tokens) for r in rules]
    have = {r.page_id: set(r.t) for r in pages.select("page_id", url_rules.tokens(F.col("url")).alias("t")).collect()}
    for r in rules:
        with_all = [i for i in range(140) if set(r.rule_tokens) <= have[i]]
        share = sum(i in bad for i in with_all) / len(with_all)
        assert share == pytest.approx(r.confidence) and share >= 0.8 and sum(i in bad for i in with_all) >= 0.03 * 140
    for r in url_rules.judge(pages, labels, **fit).collect():
        hit = [x for x in rules if set(x.rule_tokens) <= have[r.page_id]]
        assert r.verdict == ("block" if hit else "allow")
        assert r.confidence == (max(x.confidence for x in hit) if hit else None)


def test_rules_on_the_last_tokens_of_long_urls(llm):
    """All rules, against every token set of up to three tokens."""
    from itertools import combinations
    rows = [(i, f"http://w{i % 2}.blog.s{i % 3}.example.net/a/b{i % 4}/c/d/page{i % 5}.{'html' if i % 7 else 'php'}?id={i}"
             + ("&utm=1" if i % 6 == 0 else "") + ("&ref=2" if i % 4 < 2 else ""), i % 6 == 0 and i % 4 < 2 or i % 35 == 0)
            for i in range(240)]
    known = llm.createDataFrame(rows, "page_id long, url string, blocked boolean")
    have = {r.page_id: set(r.t) for r in known.select("page_id", url_rules.tokens(F.col("url")).alias("t")).collect()}
    bad = {r[0] for r in rows if r[2]}
    least, sure, lift = 0.02, 0.6, 1.5
    want = {}
    for n in (1, 2, 3):
        for s in combinations(sorted(set().union(*have.values())), n):
            where = {i for i in have if have[i] >= set(s)}
            hits = len(where & bad)
            if where and hits >= least * 240 and hits / len(where) >= sure and hits / len(where) / (len(bad) / 240) >= lift:
                want[s] = hits / len(where)
    want = {s: c for s, c in want.items() if not any(set(x) < set(s) and want[x] >= c for x in want)}
    got = {tuple(r.rule_tokens): r.confidence for r in url_rules.mine(known, min_support=least, min_confidence=sure,
                                                                      min_lift=lift).collect()}
    assert {s: c for s, c in got.items() if len(s) <= 3} == pytest.approx(want)
    assert any("query:utm" in s for s in got)


def brute(rows, k=5):
    usable = [(i, vid, v) for i, (vid, v) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ints = {i: [math.floor(256 * x) for x in v] for i, _, v in usable}
    out = Counter()
    for i, q, v in usable:
        if q is None or q % 50:
            continue
        scored = sorted((-sum(a * b for a, b in zip(ints[i], ints[j])), c is None, c if c is not None else 0)
                        for j, c, w in usable if j != i and len(w) == len(v))
        for rank, (s, none, c) in enumerate(scored[:k], 1):
            out[q, rank, None if none else c, -s] += 1
    return out


def test_pivot_search(llm):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(400)]
    rows += [(400 + i, rows[i % 3][1]) for i in range(30)]  # ties
    rows += [(None, rows[0][1]), (50, rows[50][1]), (50, None), (100, [1.0, None]), (150, [float("nan")] * 8), (200, [float("inf")] * 8),
             (500, [1e9] * 8), (550, [0.5] * 3), (551, [0.25] * 3), (600, []), (601, [])]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"rank": F.lit(1), "dim": F.lit(2)})
    for settings in ({}, {"block": 16, "query_block": 4, "blocks_per_task": 2, "pivots": 3, "sample": 20}):
        got = pivot_search.top_k(df.repartition(3), **settings).collect()
        assert Counter(tuple(r) for r in got) == brute(rows)
    assert pivot_search.top_k(df.limit(0)).count() == 0


def test_pivots_save_work():
    """Far clusters are never scored."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 16)) * 900
    v = np.floor(np.repeat(centres, 50, axis=0) + rng.normal(size=(1000, 16)) * 20)
    pivots = pivot_search.choose_pivots(v[::9], 24)
    d = np.stack([np.linalg.norm(v - p, axis=1) for p in pivots], axis=1)
    ids, scored = np.arange(1000), []
    exact = pivot_search._exact
    pivot_search._exact = lambda a, b: scored.append(len(a)) or exact(a, b)
    try:
        pivot_search.search_block((ids[:5] + 5000, ids[:5], v[:5], d[:5]), [(ids, ids, v, d)], 5)
    finally:
        pivot_search._exact = exact
    assert sum(scored) < 5 * 1000 / 4
