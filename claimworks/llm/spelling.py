"""Spelling variants: words one edit apart, found in a frequency-vector trie.

A word's vector counts its letters by group: one group per letter of the alphabet, in the order of
``LETTERS``, and other letters by code point. One edit adds at most one to one count (a surplus) and
takes at most one from another (a deficit). The trie's levels are the groups; a node's children are
the counts of the next group. The search goes depth first with all words that may still be near,
each with its budget of one surplus and one deficit, and words in the leaves it reaches are verified.

The first levels of the trie are Spark's: all words whose vectors start alike make a shard, and the
least depth is taken at which no shard is larger than ``SHARD_WORDS``. A word is looked up in its own
shard and in each one that a surplus, or a surplus and then a deficit, in the first counts leads to;
pairs whose first difference is a deficit are found from the other word. Below, a shard's trie is its
sorted vectors, and a node a range of them. Small nodes are compared by hashes of half words: an edit
leaves the first or the second half as it is. Large leaves meet on the same hashes, sorted, so
anagrams in any number are not compared pair by pair.

Defined results: a null or empty text has no words; a null key deletes nothing; rows that share a key
are counted each; without words the result is empty. Of near words with equal counts the smallest in
code-point order is the form. Only key and text are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.llm.common import segments, written

#: Fixed: the groups of letters in the order of the trie's levels.
LETTERS = "etaoinshrdlucmfwypvbgkjqxz"
LEVELS = len(LETTERS)
#: Words of a shard at most, unless the whole vector is the same, and pairs compared at once.
SHARD_WORDS = 1 << 15
BLOCK = 1 << 15
_FLUSH = 1 << 18
_RUNS = "[A-Za-zÀ-ÿ]"
_LOWER = {c: c + 32 for c in range(65, 91)}
_GROUP = np.arange(0x110000, dtype=np.int64) % LEVELS
_GROUP[[ord(c) for c in LETTERS]] = range(LEVELS)
_WORD = "word string, n long"
_PROBE = "shard binary, word string, n long, own boolean"
_NEAR = "word string, n_near long, form string, form_n long"


def noisy(run: str, prefix_crc: int | None, every: int) -> str:
    """The run with one code point deleted, where the key and the run say so."""
    low = run.lower() if run.isascii() else run.translate(_LOWER)
    if prefix_crc is not None:
        h = zlib.crc32(low.encode(), prefix_crc)
        if h % every == 0:
            at = h % len(low)
            return low[:at] + low[at + 1:]
    return low


def count_words(docs: DataFrame, key: str, text: str, shortest: int, every: int) -> DataFrame:
    """Words of at least ``shortest`` code points with their number of occurrences."""
    pattern = re.compile(f"{_RUNS}{{{shortest},}}")

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                          names=["word", "n"])

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                start = None if doc is None else zlib.crc32(f"{doc}:".encode())
                for part in segments(body.as_py() or ""):
                    for found, n in Counter(pattern.findall(part)).items():
                        counts[noisy(found, start, every)] += n
                if len(counts) >= _FLUSH:
                    yield batch_of(counts)
                    counts = Counter()
        yield batch_of(counts)

    found = docs.select(F.col(key).cast("string"), F.col(text)).mapInArrow(run, _WORD)
    return found.filter(F.char_length("word") >= shortest).groupBy("word").agg(F.sum("n").alias("n"))


def vectors(words: list[str]) -> np.ndarray:
    """Counts per letter group, at most 255: a count cut off can only hide a difference."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    cell = np.repeat(np.arange(len(words)), lengths) * LEVELS + _GROUP[letters]
    return np.minimum(np.bincount(cell, minlength=len(words) * LEVELS), 255).astype(np.uint8).reshape(-1, LEVELS)


def _with_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = vectors(batch.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([r.tobytes() for r in rows], pa.binary())],
                                         names=["word", "n", "vector"])


def _depth(words: DataFrame, limit: int) -> int:
    """The least number of first levels that keep shards within the limit."""
    for depth in range(2, LEVELS, 2):
        largest = words.groupBy(F.col("vector").substr(1, depth)).count().agg(F.max("count")).first()[0] or 0
        if largest <= limit:
            return depth
    return LEVELS


def _probes(depth: int):
    """Words -> their own shard, and the shards that lie a surplus, and perhaps then a deficit, away."""
    steps = [(None, None)] + [(i, j) for i in range(depth) for j in (None, *range(i + 1, depth))]

    def run(batches):
        for batch in batches:
            first = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, LEVELS)[:, :depth]
            for up, down in steps:
                on = np.ones(len(first), bool)
                shard = first.copy()
                if up is not None:
                    on &= first[:, up] < 255
                    shard[:, up] += 1
                if down is not None:
                    on &= first[:, down] > 0
                    shard[:, down] -= 1
                at = pa.array(np.flatnonzero(on))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s.tobytes() for s in shard[on]], pa.binary()), batch.column(0).take(at), batch.column(1).take(at),
                     pa.array(np.full(len(at), up is None))], names=["shard", "word", "n", "own"])

    return run


def walk(tree: np.ndarray, asked: np.ndarray) -> Iterator[tuple[np.ndarray, int, int]]:
    """Depth first through the trie of sorted vectors: the words asked for that still have budget, with
    each range of the trie that is small or a leaf."""
    spent = np.zeros(len(asked), bool)
    stack = [(0, 0, len(tree), np.arange(len(asked)), spent, spent)]
    while stack:
        level, low, high, live, up, down = stack.pop()
        if not len(live):
            continue
        if level == tree.shape[1] or len(live) * (high - low) <= BLOCK:
            yield live, low, high
            continue
        column, mine = tree[low:high, level].astype(np.int16), asked[live, level].astype(np.int16)
        cuts = [0, *(np.flatnonzero(np.diff(column)) + 1), high - low]
        for a, b in zip(cuts, cuts[1:]):
            more = column[a] - mine
            on = (more == 0) | ((more == 1) & ~up) | ((more == -1) & ~down)
            stack.append((level + 1, low + a, low + b, live[on], (up | (more == 1))[on], (down | (more == -1))[on]))


def _halves(words: list[str]) -> np.ndarray:
    """Hashes of both halves of each word, taken for itself and as the longer of two words."""
    out = np.empty((4, len(words)), np.int64)
    for i, w in enumerate(words):
        own, less = len(w) // 2, (len(w) - 1) // 2
        out[:, i] = hash(w[:own]), hash(w[own:]), hash(w[:less]), hash(w[less + 1:])
    return out


def _meeting(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of equal values in two arrays."""
    if len(a) * len(b) <= BLOCK:
        return np.nonzero(a[:, None] == b[None, :])
    order = np.argsort(b, kind="stable")
    low, high = np.searchsorted(b[order], a, "left"), np.searchsorted(b[order], a, "right")
    n = high - low
    first = np.repeat(low - np.cumsum(n) + n, n)
    return np.repeat(np.arange(len(a)), n), order[first + np.arange(n.sum())]


def one_edit(a: str, b: str) -> bool:
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = 0
    while at < len(a) and a[at] == b[at]:
        at += 1
    return a[at + 1:] == b[at + 1:] if len(a) == len(b) else a[at:] == b[at + 1:]


def near_pairs(words: list[str], own: int) -> list[tuple[int, int]]:
    """Near pairs of a shard's ``own`` first words among themselves, and with the others asked for."""
    asked = vectors(words)
    order = np.lexsort(asked[:own].T[::-1])
    halves, lengths = _halves(words), np.fromiter(map(len, words), np.int64, len(words))
    found = set()
    for live, low, high in walk(asked[order], asked):
        held = order[low:high]
        for longer in (-1, 0, 1):  # how much longer the held word is
            for size in np.unique(lengths[held]):
                b, a = held[lengths[held] == size], live[lengths[live] == size - longer]
                if not len(a):
                    continue
                mine, theirs = (0 if longer >= 0 else 2), (0 if longer <= 0 else 2)
                for half in (0, 1):
                    x, y = _meeting(halves[mine + half, a], halves[theirs + half, b])
                    found.update((i, j) for i, j in zip(a[x].tolist(), b[y].tolist()) if i >= own or i < j)
    return [(i, j) for i, j in found if one_edit(words[i], words[j])]


def _shard(table: pa.Table) -> pa.Table:
    """Number of near words and the most frequent one, of each word that has some in this shard."""
    table = table.sort_by([("own", "descending")])
    words, n = table["word"].to_pylist(), table["n"].to_numpy()
    both = np.array(near_pairs(words, sum(table["own"].to_pylist())), np.int64).reshape(-1, 2)
    word, other = np.concatenate([both[:, 0], both[:, 1]]), np.concatenate([both[:, 1], both[:, 0]])
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[other], -n[other], word))
    word, first, count = np.unique(word[order], return_index=True, return_counts=True)
    form = other[order][first]
    return pa.table([[words[i] for i in word], count, [words[i] for i in form], n[form]],
                    schema=pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form", pa.string()), ("form_n", pa.int64())]))


def near_words(words: DataFrame, limit: int = SHARD_WORDS) -> DataFrame:
    """``word, n_near, form, form_n`` of words (``word, n``) that have a near one; the form is the
    most frequent near word."""
    words = written(words.mapInArrow(_with_vectors, _WORD + ", vector binary"), "vectors")
    depth = _depth(words, limit)
    shards = words.select(F.col("vector").substr(1, depth).alias("shard")).distinct()
    probes = words.mapInArrow(_probes(depth), _PROBE).join(shards, "shard", "left_semi")
    found = probes.groupBy("shard").applyInArrow(_shard, _NEAR)
    best = F.min(F.struct((-F.col("form_n")).alias("n"), "form")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", "best.form", (-F.col("best.n")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` along ``word, form``. Each step doubles the way; counts rise along it, so it ends."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = written(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                              F.col("next").isNotNull().alias("moved")), "roots")
        now = further.drop("moved")
        if further.filter("moved").isEmpty():
            return now


def spelling_forms(docs: DataFrame, key: str = "doc_id", text: str = "text", *, shortest: int = 7, least: int = 2,
                   every: int = 31, times: int = 10, limit: int = SHARD_WORDS) -> DataFrame:
    """Each word with its form: the near word that is most frequent, if it is ``times`` as frequent.

    ``every`` is the share of runs that lose a code point by their checksum, as typing errors do.
    """
    words = written(count_words(docs, key, text, shortest, every).filter(F.col("n") >= least), "words")
    found = near_words(words, limit)
    held = F.col("form_n") >= times * F.col("n")
    found = written(words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(held, F.col("form")).alias("form"), F.when(held, F.col("form_n")).alias("form_n")), "forms")
    ends = roots(found.filter("form IS NOT NULL"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
