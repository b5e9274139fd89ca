"""Merkle manifest, spelling variants and benchmark passages against plain versions."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimworks.llm import decontaminate, merkle, queries, spelling

from .conftest import DOCS, edge_rows, prose

LOWER = {c: c + 32 for c in range(65, 91)}
ORDER = ("doc_id", "text", "lang", "source", "n_chars")


def plain(df):
    return [tuple(r) for r in df.select(*ORDER).collect()]


def ranked(rows):
    return sorted(map(tuple, rows), key=repr)


# -------------------------------------------------------------------------------------------- Merkle

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    doc, _, lang, source, n = row
    return sha(*map(field, (doc, source, lang, n, text)))


def grow(nodes, below, ways):
    while len(nodes) > 1:
        above, held = [], []
        for a in range(0, len(nodes), 16):
            run = nodes[a:a + 16]
            for slot, group in enumerate(below[a:a + 16]):
                for one in group:
                    ways[one].append((run, slot))
            above.append(sha(*run))
            held.append(sum(below[a:a + 16], []))
        nodes, below = above, held
    return nodes[0]


def manifest(rows):
    groups, ways, subroots, leaves = defaultdict(list), {}, {}, {}
    for row in rows:
        groups[row[3]].append(row)
    for source in sorted(groups, key=lambda s: (s is not None, (s or "").encode())):
        held = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        for i, row in enumerate(held):
            picked = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            text = row[1].translate(LOWER) if picked and row[1] is not None else row[1]
            leaves[source, i], ways[source, i] = (row[0], leaf(row, row[1]), leaf(row, text)), []
        subroots[source] = grow([leaves[source, i][1] for i in range(len(held))], [[(source, i)] for i in range(len(held))], ways)
    root = grow(list(subroots.values()), [[k for k in leaves if k[0] == s] for s in subroots], ways) if subroots else None
    out = []
    for key, (doc, own, found) in leaves.items():
        proof = sha(*(n for run, slot in ways[key] for i, n in enumerate(run) if i != slot))
        for run, slot in ways[key]:
            found = sha(*(found if i == slot else n for i, n in enumerate(run)))
        out.append((doc, own, subroots[key[0]], root, proof, found, found == root))
    return out


def proved(df):
    picked = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = F.when(picked, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    return merkle.prove(df, ORDER[:1] + ORDER[3:4] + ORDER[2:3] + ORDER[4:] + ORDER[1:2], "doc_id", "source", {"text": found})


def test_states_are_those_of_the_hash():
    rng = np.random.default_rng(3)
    children, counts = rng.integers(0, 256, (40, 16, 32)).astype(np.uint8), rng.integers(1, 17, 40)
    states, digests = merkle.midstates(children, counts)
    hexes = [[c.tobytes().hex() for c in row[:n]] for row, n in zip(children, counts)]
    assert [d.tobytes().hex() for d in digests] == [sha(*h) for h in hexes]
    slot, other = (counts * 7 // 9).astype(np.int64), rng.integers(0, 256, (40, 32)).astype(np.uint8)
    got = merkle.fold(states[np.arange(40), slot], other, slot, children, counts)
    want = [sha(*h[:s], o.tobytes().hex(), *h[s + 1:]) for h, s, o in zip(hexes, slot, other)]
    assert [g.tobytes().hex() for g in got] == want


def test_folding_reads_nothing_to_the_left():
    children, counts = np.arange(512, dtype=np.uint8).reshape(1, 16, 32), np.array([16])
    states, digest = merkle.midstates(children, counts)
    blind = children.copy()
    blind[0, :5] = 0
    assert merkle.fold(states[:, 5], children[:, 5], np.array([5]), blind, counts).tobytes() == digest.tobytes()


def test_manifest_of_edge_rows(edge):
    assert ranked(proved(edge).collect()) == ranked(manifest(edge_rows()))


@pytest.mark.parametrize("rows", [
    [(7, "One", "en", None, 3)],
    [(i, "Same", None, "hot" if i % 3 else f"s{i}", i) for i in range(900)],
    [(1, "Twice", "en", "a", 5)] * 40 + [(None, None, None, None, None)] * 20,
    [(i, f"T{i}", "en", ["é", "z", "", None, "Z", "-"][i % 6], 2) for i in range(37)],
], ids=["one row", "hot source and many of one row", "equal rows and nulls", "order of sources"])
def test_manifest(llm, rows):
    assert ranked(proved(llm.createDataFrame(rows, DOCS).repartition(4)).collect()) == ranked(manifest(rows))


def test_manifest_of_empty_table(empty):
    assert proved(empty).collect() == []


def test_levels_are_stored_with_their_states(llm):
    rows = llm.createDataFrame([(i, f"T{i}", "en", "a", 2) for i in range(300)], DOCS)
    nodes = merkle.numbered(rows.select(F.lit("a").alias("tree"), F.col("doc_id").alias("key"),
                                        merkle.leaf({"doc_id": F.col("doc_id")}).alias("digest")), ["tree"], ["key"])
    levels = merkle.build(nodes)
    assert [(x.count(), n) for x, n in levels] == [(19, 19), (2, 2), (1, 1)]
    for r in levels[0][0].collect():
        n = len(r.children) // 32
        assert len(r.states) == len(r.children)
        assert r.digest.hex() == sha(*(r.children[32 * i:32 * i + 32].hex() for i in range(n)))


# ------------------------------------------------------------------------------------------ spelling

def spelled(rows, shortest=7, least=2, every=31):
    words = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{doc}:{run}".encode())
            if doc is not None and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= shortest:
                words[run] += 1
    words = {w: n for w, n in words.items() if n >= least}
    near, cut = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            less = w[:i] + w[i + 1:]
            cut[i, less].add(w)
            if less in words:
                near[w].add(less)
                near[less].add(w)
    for same in cut.values():
        for w in same:
            near[w] |= same - {w}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 10 * n:
            form[w] = best
    out = []
    for w, n in words.items():
        end = w
        while end in form:
            end = form[end]
        out.append((w, form.get(w), end, n, len(near[w]), words.get(form.get(w))))
    return out


def variants():
    rows = []
    for i, (word, n) in enumerate([("remember", 3000), ("remembers", 250), ("rememberss", 20), ("remambers", 20), ("rememberes", 2),
                                   ("réservées", 40), ("réservèes", 4), ("reservées", 3), ("abcdefg", 2), ("abcdefgh", 20),
                                   ("abcdefgi", 20), ("bacdefg", 2), ("x" * 300, 30), ("x" * 299, 3), ("x" * 301, 2),
                                   ("tiestie", 2), ("tiestia", 20), ("tiestib", 20), ("wa×erfall", 2), ("waterfall", 25)]):
        rows += [(10 * i + k, " ".join([word] * (n // 10 + (k < n % 10))), "en", "s", 0) for k in range(10)]
    return rows


@pytest.mark.parametrize("limit", [1 << 15, 3], ids=["one shard", "deep shards"])
def test_spelling_of_variants(llm, limit):
    rows = variants()
    got = spelling.spelling_forms(llm.createDataFrame(rows, DOCS).repartition(3), limit=limit)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got, want = ranked(got.collect()), ranked(spelled(rows))
    assert got == want
    assert any(w[1] and w[2] != w[1] for w in want)  # a chain of forms


@pytest.mark.parametrize("limit", [1 << 15, 40])
def test_spelling_of_prose(llm, limit):
    rows = [(i, re.sub(r"(\w+) (\w+) ", r"\1\2 ", prose(i, 400)), "en", "s", 0) for i in range(60)]
    got = spelling.spelling_forms(llm.createDataFrame(rows, DOCS).repartition(5), limit=limit, every=7)
    want = spelled(rows, every=7)
    assert ranked(got.collect()) == ranked(want) and sum(w[4] for w in want) > 100


def test_spelling_of_edge_rows(edge, empty):
    assert ranked(spelling.spelling_forms(edge).collect()) == ranked(spelled(edge_rows()))
    assert spelling.spelling_forms(empty).collect() == []


def test_large_leaves_meet_on_halves():
    letters = "etaoinsh"
    words = sorted({"".join(letters[(i * 7 + j * (i % 5 + 1)) % 8] for j in range(9)) for i in range(60)}
                   | {"".join(p) for i in range(700) for p in [sorted(letters, key=lambda c: zlib.crc32(f"{c}{i}".encode()))]})
    got = {frozenset(p) for p in spelling.near_pairs(words, len(words))}
    want = {frozenset((i, j)) for i in range(len(words)) for j in range(i) if spelling.one_edit(words[i], words[j])}
    assert got == want


def test_one_edit():
    near = [("abc", "abd"), ("abc", "abcd"), ("abc", "xabc"), ("aab", "ab"), ("a", "b"), ("", "a")]
    far = [("abc", "abc"), ("abc", "acb"), ("abc", "abcde"), ("abcd", "abxy"), ("", "")]
    assert all(spelling.one_edit(*p) and spelling.one_edit(*p[::-1]) for p in near)
    assert not any(spelling.one_edit(*p) for p in far)


# ----------------------------------------------------------------------------------------- winnowing

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def found_in(rows, items, window=10):
    windows = defaultdict(set)
    for item, text in items:
        words = WORD.findall((text or "").translate(LOWER))
        m = min(window, len(words))
        for a in range(len(words) - m + 1 if m else 0):
            windows[tuple(words[a:a + m])].add(item)
    out = []
    for doc, text, *_ in rows:
        words, hit, held = WORD.findall((text or "").translate(LOWER)), set(), set()
        for m in {len(w) for w in windows}:
            for a in range(len(words) - m + 1):
                if tuple(words[a:a + m]) in windows:
                    hit.update(range(a, a + m))
                    held |= windows[tuple(words[a:a + m])]
        held = sorted(str(i) for i in held if i is not None)
        out.append((doc, len(words), len(hit), len(held), hashlib.sha256(",".join(held).encode()).hexdigest(), bool(hit)))
    return out


ITEMS = "item_id long, text string"


def benchmark():
    long = prose(77, 60)
    return [(1, long), (2, long + " and more"), (10, prose(5, 40)), (3, "Only, three WORDS"), (4, "naïve"), (5, None), (6, " .. "),
            (7, "a a a a a a a a a a a a a a"), (8, prose(78, 10)), (9, " ".join(prose(79, 7).split())), (None, prose(80, 30))]


def sample_texts():
    passage = prose(77, 60).split()
    return [*edge_rows(),
            (100, "Before it. " + " ".join(passage) + " and after", "en", "s", 0),
            (101, " ".join(passage[20:30]), "en", "s", 0),           # just one window
            (102, " ".join(passage[20:29]) + " not", "en", "s", 0),  # one word short
            (103, ("-- ".join(passage[5:33]) + "! ").upper(), "en", "s", 0),
            (104, " ".join(passage[:25] + ["other"] + passage[25:]), "en", "s", 0),
            (105, "only three words; only three words", "en", "s", 0),
            (106, "a " * 40 + prose(80, 30), "en", "s", 0),
            (107, prose(78, 10) + " " + prose(79, 7) + " naïve", "en", "s", 0),
            *[(200 + i, f"{i} " + " ".join(passage), "en", "hot", 0) for i in range(30)]]


def test_passages(llm):
    rows, items = sample_texts(), benchmark()
    docs = llm.createDataFrame(rows, DOCS).repartition(3).withColumns({c: F.lit("x") for c in ("row_id", "print", "words", "item_id")})
    bench = llm.createDataFrame(items, ITEMS).withColumn("doc_id", F.lit("x"))
    got = decontaminate.decontaminate(docs, bench)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert ranked(got.collect()) == ranked(found_in(rows, items))


@pytest.mark.parametrize("window", [1, 3, 5, 6, 10, 25])
def test_passages_of_each_window(llm, window):
    rows, items = sample_texts(), benchmark()
    got = decontaminate.decontaminate(llm.createDataFrame(rows, DOCS), llm.createDataFrame(items, ITEMS), window=window)
    assert ranked(got.collect()) == ranked(found_in(rows, items, window))


def test_passages_across_the_parts_of_a_long_text(llm, monkeypatch):
    monkeypatch.setattr(decontaminate, "_CUT", 200)
    words = prose(77, 300)
    for overlap in (20, 30):
        parts = list(decontaminate._pieces(words, overlap))
        assert len(parts) > 4 and all(p == decontaminate.words_of(words)[a:a + len(p)] for a, p in parts)
        for at in range(len(decontaminate.words_of(words)) - 10):
            assert any(a <= at and at + 10 <= a + len(p) for a, p in parts)


def test_shared_windows_share_a_fingerprint():
    words = decontaminate.words_of(prose(3, 500))
    at, prints = decontaminate.fingerprints(words, 10)
    for start in range(0, len(words) - 9):
        own, part = decontaminate.fingerprints(words[start:start + 10], 10)
        assert len(own) == 1 and int(part[0]) in {int(p) for a, p in zip(at, prints) if start <= a <= start + 5}


def test_no_documents_and_no_items(llm, empty, edge):
    items = llm.createDataFrame(benchmark(), ITEMS)
    assert decontaminate.decontaminate(empty, items).collect() == []
    none = decontaminate.decontaminate(edge, items.filter("false"))
    assert ranked(none.collect()) == ranked(found_in(edge_rows(), []))


@pytest.mark.parametrize("name", ["op11_merkle", "op12_spelling", "op13_winnowing"])
def test_queries_equal_the_plain_versions(llm, name):
    sf = "/root/testdata/sf0.001"
    rows = plain(llm.read.parquet(f"{sf}/documents.parquet"))
    items = [tuple(r) for r in llm.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    want = {"op11_merkle": lambda: manifest(rows), "op12_spelling": lambda: spelled(rows),
            "op13_winnowing": lambda: found_in(rows, items)}[name]()
    assert ranked(queries.QUERIES[name](llm, sf).collect()) == ranked(want)
