"""Exact dedup, n-gram join, components and sharding against plain versions."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimworks.llm import exact_dedup, ngram_join, sharding
from claimworks.llm.components import components

from .conftest import edge_rows, prose


def union(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("history", ["key IS NOT NULL", "key < 5", "false", "true"])
def test_exact_dedup(edge, history):
    rows = exact_dedup.exact_dedup(edge, is_history=F.coalesce(F.expr(history), F.lit(False))).collect()
    groups = defaultdict(list)
    for d, t, *_ in edge_rows():
        groups[hashlib.sha256((t or "").encode()).hexdigest()].append(d)
    best = {h: max((d for d in ds if d is not None), default=None) for h, ds in groups.items()}
    assert Counter((r.doc_id, r.text_sha256) for r in rows) == Counter((d, h) for h, ds in groups.items() for d in ds)
    for r in rows:
        assert (r.keep_id, r.group_size) == (best[r.text_sha256], len(groups[r.text_sha256]))
    kept = [r for r in rows if r.kept]
    assert Counter(r.text_sha256 for r in kept) == Counter(dict.fromkeys(groups, 1))
    assert all(r.doc_id == r.keep_id for r in kept)
    assert {r.origin for r in rows} <= {"history", "repeat", "fresh"}


def test_without_repeats(edge, empty):
    out = exact_dedup.without_repeats(edge)
    assert out.columns == edge.columns
    assert Counter(r.text or "" for r in out.collect()) == Counter({t or "" for _, t, *_ in edge_rows()})
    assert exact_dedup.without_repeats(empty).count() == 0
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_the_hash_is_minimal_and_perfect():
    digest = np.frombuffer(b"".join(hashlib.sha256(bytes([i % 256, i // 256])).digest() for i in range(3000)), np.uint8)
    words = exact_dedup._words(digest.reshape(-1, 32))
    sizes, bits, order = exact_dedup._minimal_hash(words)
    assert sorted(order) == list(range(3000))
    assert (exact_dedup._slots(sizes, bits, words[order]) == np.arange(3000)).all()
    same = np.array([7, 7, 7], np.uint64)  # cannot be told apart: left to the last slots
    sizes, bits, order = exact_dedup._minimal_hash(same)
    assert len(order) == 3 and (exact_dedup._slots(sizes, bits, same) == -1).all()


def grams(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def expected(rows):
    """Per row: set size, smallest id of the component, number of links."""
    sets = [grams(r[1]) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i)
             if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    root = union(links, range(len(rows)))
    least = defaultdict(list)
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root[i]].append(r[0])
    n = Counter(x for link in links for x in link)
    return Counter((r[0], len(sets[i]), min(least[root[i]], default=None), n[i]) for i, r in enumerate(rows))


def near_rows():
    """Chains of near copies, a passage many share, a common line, and exact copies."""
    rows, passage = [], prose(77, 60)
    for g in range(12):
        words = prose(100 + g, 90).split()
        for k in range(9):
            words = words[:]
            words[(k * 13) % 90] = f"edit{g}x{k}"
            rows.append((len(rows) * 3, " ".join(words)))
    rows += [(1000 + i, prose(300 + i, 40) + " " + passage) for i in range(60)]
    rows += [(2000 + i, passage + f" w{i}") for i in range(40)]
    return rows + [(3000 + i, prose(1, 50)) for i in range(70)] + [(4000, "a b c"), (4001, "A b  c"), (4002, "a b")]


@pytest.mark.parametrize("settings", [{}, {"block_grams": 300}, {"block": 4, "hot": 3, "flush": 500, "bucket_grams": 64, "fragments": 3},
                                      {"fragments": 1, "hot": 2}])
@pytest.mark.parametrize("which", ["edge", "near"])
def test_ngram_join(llm, edge, which, settings):
    rows = edge_rows() if which == "edge" else near_rows()
    docs = edge if which == "edge" else llm.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = ngram_join.ngram_join(docs, **settings).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got) == expected(rows)


def test_ngram_join_of_nothing(empty):
    assert ngram_join.ngram_join(empty).count() == 0


def test_words_are_the_same_in_pieces():
    raw = prose(8, 2000).encode()
    whole, _ = ngram_join.word_hashes(raw)
    cut = [ngram_join.word_hashes(p)[0] for p in ngram_join._pieces(raw, 100)]
    assert np.array_equal(whole, np.concatenate(cut))


def test_components(llm):
    links = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (200, 201), (200, 202), (7, 7)]
    got = {r.vertex: r.component for r in components(llm.createDataFrame(links, "a long, b long")).collect()}
    assert got == union(links, {x for link in links for x in link if link[0] != link[1]})
    assert components(llm.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("limit, step", [(1000, 20), (1000, 3), (50_000, 20), (10 ** 9, 20), (1, 20)])
def test_sharding(edge, limit, step):
    rows = sharding.assign(edge, "doc_id", ["text"], limit, step).collect()
    assert Counter((r.doc_id, r.n_bytes) for r in rows) == Counter((d, len((t or "").encode())) for d, t, *_ in edge_rows())
    shards = defaultdict(list)
    for r in rows:
        shards[r.shard].append(r)
    names = sorted(shards)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    for name, members in shards.items():
        total = sum(r.n_bytes for r in members)
        assert {(r.depth, r.shard_bytes, r.fits) for r in members} == {(len(name), total, total <= limit)}
        assert total <= limit or sum(r.n_bytes > 0 for r in members) <= 1
        if name:  # it was split because what it came from was too large
            assert sum(r.n_bytes for r in rows if r.shard.startswith(name[:-1])) > limit


def test_sharding_of_nothing(empty):
    assert sharding.assign(empty, "doc_id", ["text"], 10).count() == 0


def test_shards_are_written_with_their_rows(edge, tmp_path):
    keep = ["doc_id", "text", "lang", "depth_"]
    rows = edge.withColumn("depth_", F.lit(9)).withColumn("row id", F.col("source"))
    placed = sharding.assign(rows, "doc_id", ["text"], 3000, keep=["text", "lang", "depth_", "row id"])
    assert Counter((r.doc_id, r.text, r.lang) for r in placed.collect()) == Counter((r[0], r[1], r[2]) for r in edge_rows())
    path = str(tmp_path / "shards")
    sharding.write_shards(placed, path)
    back = edge.sparkSession.read.schema(placed.schema).parquet(path)
    sizes = Counter()
    for r in back.collect():
        sizes[r.shard] += len((r.text or "").encode())
    assert sum(sizes.values()) == sum(len((t or "").encode()) for _, t, *_ in edge_rows())
    singles = Counter(r.shard for r in back.collect())
    assert all(n <= 3000 or singles[s] == 1 for s, n in sizes.items()) and keep
