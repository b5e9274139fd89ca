"""Exact similarity join of documents on word n-grams, with vertical partitioning.

1. *Sets.* A text becomes the set of hashes of its n-grams. Each batch of documents deals its hashes
   to buckets by their first bits, packed. A bucket keeps the hashes that two sets share and how
   many do: only these can add to an overlap. A hash that many documents of one batch hold is
   dealt to further buckets of its own, so that a passage in every text fills no single task.
2. *Order.* Shared hashes are ordered by how many sets hold them, rare ones first. Two sets of
   similarity s or more share a hash among the first (1 - s) n + 1 of each, so a set with fewer
   shared hashes than s n has no partner.
3. *Blocks.* Sets are put into blocks of bounded size (in sets, and in hashes) by the most held of
   these first hashes and by size. Two blocks are compared when some first hash occurs in both and sizes can match. Thousands
   of near copies thus meet as a few block pairs and not as millions of rows.
4. *Fragments.* The order is cut into fragments of equal weight. Each fragment counts the overlaps
   of a block pair by itself, and the counts are summed per pair and tested.
5. Linked sets are joined to components; copies of a set share its row until the end.

Hashes have 40 bits besides the bucket, and buckets hold about 2^18 hashes; there are 2^20 of them at
most, so from some 1.6 TB of text on they grow with it (to about 250 MB at 100 TB). Defined results: a null or blank text has no n-grams and no link; a text of fewer words is
one n-gram; null keys never name a component (unless it has no other); rows that share a key are
separate documents; an empty table gives an empty result. Only key and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.llm.common import mix64, written
from claimworks.llm.components import components
from claimworks.session import session_conf

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BYTE = mix64(np.arange(256, dtype=np.uint64), 11)
_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
_HASH_BITS = 40
_HOT = 1 << 15
_SETS = ("kind int, bucket long, batch long, hashes binary, owners binary, key long, digest binary, n long")
_SHARED = "key long, owner long, digest binary, n long, held int, gram long, kind int"


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word, A-Z folded; words end at ASCII white space."""
    a = _FOLD[np.frombuffer(raw, np.uint8)]
    at = np.flatnonzero((a != 32) & ((a < 9) | (a > 13)))
    if not len(at):
        return np.empty(0, np.uint64), at
    first = np.flatnonzero(np.concatenate(([True], np.diff(at) != 1)))
    length = np.diff(np.append(first, len(at)))
    power = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(length.max() - 1, _STEP))))
    place = np.arange(len(at)) - np.repeat(first, length)
    sums = np.add.reduceat(_BYTE[a[at]] * power[place], first)
    return mix64(sums ^ length.astype(np.uint64)), at[first]


def _pieces(raw: bytes, size: int = 1 << 22):
    start = 0
    while len(raw) - start > size:
        cut = start + size
        while cut < len(raw) and raw[cut] not in b" \t\n\r\f\v":
            cut += 1
        yield raw[start:cut]
        start = cut
    yield raw[start:]


def _combine(words: np.ndarray, n: int, seed: int) -> np.ndarray:
    total = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for k in range(n):
        total += mix64(words[k:k + len(total)], 100 + k)
    return mix64(total, seed)


def gram_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    words, counts = [], []
    group: list[bytes] = []

    def run():
        if not group:
            return
        h, at = word_hashes(b"\n".join(group))
        ends = np.cumsum([len(t) + 1 for t in group])
        words.append(h)
        counts.extend(np.diff(np.searchsorted(at, ends), prepend=0).tolist())
        group.clear()

    size = 0
    for t in texts:
        if len(t) > 1 << 22:
            run()
            own = [word_hashes(p)[0] for p in _pieces(t)]
            words.extend(own)
            counts.append(sum(map(len, own)))
            continue
        group.append(t)
        size += len(t)
        if size > 1 << 21:
            run()
            size = 0
    run()
    every = np.concatenate(words) if words else np.empty(0, np.uint64)
    grams = _combine(every, n, n)
    out, start = [], 0
    for c in counts:
        if c >= n:
            out.append(np.unique(grams[start:start + c - n + 1]))
        else:
            out.append(_combine(every[start:start + c], c, c) if c else np.empty(0, np.uint64))
        start += c
    return out


def _pack_hashes(h: np.ndarray) -> bytes:
    """Five byte planes, highest first; sorted hashes make the first one compress well."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 4::-1].T).tobytes()


def _open_hashes(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(5, -1).astype(np.int64)
    return (planes[0] << 32) | (planes[1] << 24) | (planes[2] << 16) | (planes[3] << 8) | planes[4]


def _batch(names: str, **columns) -> pa.RecordBatch:
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [c.split() for c in names.split(", ")]
    size = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([
        pa.array(columns[n], types[t]) if n in columns else pa.nulls(size, types[t]) for n, t in fields],
        names=[n for n, _ in fields])


def _deal(n: int, bits: int, flush: int, hot: int):
    """Documents -> one row each, and rows of packed hashes per bucket and batch."""
    def run(batches):
        part, count = TaskContext.get().partitionId(), 0
        grams: list[np.ndarray] = []
        seen: dict[bytes, int] = {}
        docs: list[tuple] = []
        held = 0

        def flushed():
            nonlocal count, held
            batch = (part << 20) + count
            count += 1
            owner = [(batch << 16) + i for _, i, _, _ in docs]
            yield _batch(_SETS, kind=[0] * len(docs), bucket=[o % (1 << bits) for o in owner], batch=owner,
                         key=[d[0] for d in docs], digest=[d[2] for d in docs], n=[d[3] for d in docs])
            h = np.concatenate(grams) if grams else np.empty(0, np.uint64)
            who = np.repeat(np.arange(len(grams)), list(map(len, grams))).astype("<u2")
            order = np.argsort(h, kind="stable")
            h, who = h[order], who[order]
            bucket = (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
            low = h & np.uint64((1 << _HASH_BITS) - 1)
            new = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.empty(0, int)
            times = np.diff(np.append(new, len(h)))
            is_hot = np.repeat(times >= hot, times)
            for kind, some in ((1, ~is_hot), (2, is_hot)):
                yield from rows(kind, bucket[some], low[some], who[some], batch)
            first = new[times >= hot]
            yield from rows(3, bucket[first], low[first], np.zeros(len(first), "<u2"), batch)
            grams.clear()
            seen.clear()
            docs.clear()
            held = 0

        def rows(kind, bucket, low, who, batch):
            if not len(bucket):
                return
            cut = np.flatnonzero(np.diff(bucket)) + 1
            starts, ends = np.concatenate(([0], cut)), np.append(cut, len(bucket))
            order = [np.argsort(low[a:b], kind="stable") for a, b in zip(starts, ends)]
            to = [int(bucket[a]) if kind != 2 else (1 << bits) + (int(bucket[a]) << 10) + batch % 1024 for a in starts]
            for i in range(0, len(starts), 256):
                s = slice(i, i + 256)
                yield _batch(_SETS, kind=[kind] * len(starts[s]), bucket=to[s], batch=[batch] * len(starts[s]),
                             hashes=[_pack_hashes(low[a:b][o]) for a, b, o in zip(starts[s], ends[s], order[s])],
                             owners=[who[a:b][o].tobytes() for a, b, o in zip(starts[s], ends[s], order[s])])

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for i in range(0, len(keys), 512):
                texts = [(t.as_py() or "").encode("utf-8", "replace") for t in batch.column(1)[i:i + 512]]
                for key, g in zip(keys[i:i + 512], gram_sets(texts, n)):
                    digest = hashlib.blake2b(g.tobytes(), digest_size=16).digest()
                    at = seen.get(digest)
                    if at is None:
                        at = seen[digest] = len(grams)
                        grams.append(g)
                        held += len(g)
                    docs.append((key, at, digest, len(g)))
                    if held >= flush or len(grams) >= 65_000 or len(docs) >= 200_000:
                        yield from flushed()
        if docs:
            yield from flushed()

    return run


def _shared(bits: int):
    """A bucket's hashes that more than one set holds. Rows of documents pass through."""
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        kinds = group.column("kind").to_numpy()
        docs = group.filter(pa.array(kinds == 0))
        out = [_batch(_SHARED, key=docs.column("key").to_pylist(), owner=docs.column("batch").to_pylist(),
                      digest=docs.column("digest").to_pylist(), n=docs.column("n").to_pylist(), kind=[0] * len(docs))]
        packed = group.filter(pa.array(kinds != 0))
        if len(packed):
            kind, batch = packed.column("kind").to_numpy(), packed.column("batch").to_numpy()
            hashes = [_open_hashes(x) for x in packed.column("hashes").to_pylist()]
            sizes = [len(x) for x in hashes]
            h = np.concatenate(hashes)
            owner = np.concatenate([np.frombuffer(x, "<u2") for x in packed.column("owners").to_pylist()])
            owner = (np.repeat(batch, sizes) << 16) + owner
            real, hot = np.repeat(kind != 3, sizes), np.repeat(kind != 1, sizes)
            bucket = group.column("bucket")[0].as_py()
            if bucket >= 1 << bits:
                bucket = (bucket - (1 << bits)) >> 10
            order = np.argsort(h, kind="stable")
            h, owner, real, hot = h[order], owner[order], real[order], hot[order]
            new = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            size = np.diff(np.append(new, len(h)))
            count = np.add.reduceat(real.astype(np.int64), new)
            is_hot = np.logical_or.reduceat(hot, new)
            held = np.where(is_hot, _HOT, np.minimum(count, _HOT - 1))
            keep = np.repeat((count > 1) | is_hot, size) & real
            out.append(pa.RecordBatch.from_arrays(
                [pa.nulls(keep.sum(), pa.int64()), pa.array(owner[keep]), pa.nulls(keep.sum(), pa.binary()),
                 pa.nulls(keep.sum(), pa.int64()), pa.array(np.repeat(held, size)[keep].astype(np.int32)),
                 pa.array((bucket << _HASH_BITS) | h[keep]), pa.array(np.ones(keep.sum(), np.int32))],
                names=out[0].schema.names))
        return pa.Table.from_batches(out)

    return run


def cut_points(grams: DataFrame, fragments: int, bits: int) -> list[tuple[int, int]]:
    """Where the order (held, gram) is cut so that fragments weigh about the same. Grams are hashes,
    so a part of a class of equal counts is a part of the range of hashes."""
    classes = sorted(grams.groupBy("held").count().collect())
    total, out, before = sum(n for _, n in classes), [], 0
    for held, n in classes:
        while len(out) < fragments - 1 and before + n > total * (len(out) + 1) / fragments:
            share = (total * (len(out) + 1) / fragments - before) / n
            out.append((held, int(share * 2.0 ** (bits + _HASH_BITS))))
        before += n
    return out


_BLOCK = "block long, fragment int, sets binary, sizes binary, copies binary, ends binary, grams binary"


def _fragments(cuts: list[tuple[int, int]]):
    """The sets of one block -> one row per fragment with each set's part of the order."""
    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        sets, sizes, copies = (np.array([r[c] for r in rows], np.int64).tobytes() for c in ("owner", "n", "copies"))
        parts: list[list[np.ndarray]] = [[] for _ in range(len(cuts) + 1)]
        for r in rows:
            held, grams = np.array(r["held"]), np.array(r["grams"], np.int64)
            at = [int(np.count_nonzero((held < d) | ((held == d) & (grams < g)))) for d, g in cuts]
            for k, part in enumerate(np.split(grams, at)):
                parts[k].append(part)
        block = rows[0]["block"]
        out = [(block, k, sets, sizes, copies, np.cumsum([len(x) for x in p]).tobytes(), np.concatenate(p).tobytes())
               for k, p in enumerate(parts)]
        return pa.Table.from_batches([_batch(_BLOCK, **dict(zip([c.split()[0] for c in _BLOCK.split(", ")], zip(*out))))])

    return run


_PARTIAL = ("a long, b long, rows binary, columns binary, counts binary, sets_a binary, sizes_a binary, "
            "copies_a binary, sets_b binary, sizes_b binary, copies_b binary")


def overlaps(ends_a: np.ndarray, grams_a: np.ndarray, ends_b: np.ndarray, grams_b: np.ndarray) -> np.ndarray:
    """How many grams each set of one block shares with each set of the other."""
    total = np.zeros((len(ends_a), len(ends_b)), np.float32)
    common = np.intersect1d(grams_a, grams_b)
    if not len(common):
        return total.astype(np.int32)

    def places(ends, grams):
        at = np.minimum(np.searchsorted(common, grams), len(common) - 1)
        hit = common[at] == grams
        return np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[hit], at[hit]

    (ia, ca), (ib, cb) = places(ends_a, grams_a), places(ends_b, grams_b)
    for low in range(0, len(common), 4096):
        width = min(4096, len(common) - low)
        held = []
        for i, c, n in ((ia, ca, len(ends_a)), (ib, cb, len(ends_b))):
            m = np.zeros((n, width), np.float32)
            some = (c >= low) & (c < low + width)
            m[i[some], c[some] - low] = 1
            held.append(m)
        total += held[0] @ held[1].T
    return total.astype(np.int32)


def _count(batches):
    """Block pairs of one fragment -> the overlaps above zero, packed."""
    for batch in batches:
        for r in batch.to_pylist():
            shared = overlaps(*(np.frombuffer(r[c], np.int64) for c in ("ends_a", "grams_a", "ends_b", "grams_b")))
            i, j = np.nonzero(shared)
            yield _batch(_PARTIAL, a=[r["a"]], b=[r["b"]], rows=[i.astype("<u4").tobytes()],
                         columns=[j.astype("<u4").tobytes()], counts=[shared[i, j].astype("<u4").tobytes()],
                         **{c: [r[c]] for c in ("sets_a", "sizes_a", "copies_a", "sets_b", "sizes_b", "copies_b")})


_LINKS = "owner long, root long, links long"


def _summed(percent: int):
    """Partial counts of a block pair -> its linked sets, each with a root it is connected to."""
    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        one = rows[0]
        sets_a, size_a, copies_a, sets_b, size_b, copies_b = (np.frombuffer(one[c], np.int64) for c in (
            "sets_a", "sizes_a", "copies_a", "sets_b", "sizes_b", "copies_b"))
        total = np.zeros((len(sets_a), len(sets_b)), np.int64)
        for r in rows:
            i, j, n = (np.frombuffer(r[c], "<u4") for c in ("rows", "columns", "counts"))
            total[i, j] += n
        linked = 100 * total >= percent * (size_a[:, None] + size_b[None, :] - total)
        if one["a"] == one["b"]:
            np.fill_diagonal(linked, False)
        i, j = np.nonzero(linked)
        ids, at = np.unique(np.concatenate([sets_a[i], sets_b[j]]), return_inverse=True)
        u, v = at[:len(i)], at[len(i):]
        root = np.arange(len(ids))
        while len(u):  # smallest label among neighbours, until nothing changes
            before = root.copy()
            np.minimum.at(root, u, root[v])
            np.minimum.at(root, v, root[u])
            root = root[root]
            if (before == root).all():
                break
        links = np.zeros(len(ids), np.int64)
        np.add.at(links, u, copies_b[j])
        if one["a"] != one["b"]:
            np.add.at(links, v, copies_a[i])
        return pa.Table.from_batches([_batch(_LINKS, owner=ids, root=ids[root], links=links)])

    return run


def similar_sets(sets: DataFrame, bits: int, percent: int, fragments: int, block: int, block_grams: int) -> DataFrame:
    """``owner, root, links`` for the linked ones of ``sets``: owner, n, copies, held, grams, first."""
    postings = sets.select("owner", F.explode(F.slice("grams", 1, F.col("first"))).alias("gram"))
    lists = written(postings.groupBy("gram").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "lists")
    held = written(postings.join(lists, "gram"), "postings")
    hubs = held.groupBy("owner").agg(F.max(F.struct("size", "gram")).alias("hub"))
    classes = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(10000.0 / percent / 100 + 0.005))).cast("int")
    # Sets of a block: fewer when they are large, so that a block holds a bounded number of hashes.
    together = F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.lit(block_grams) / F.col("n"))))
    salt = F.pmod(F.xxhash64("owner"), F.ceil(F.col("hub.size") / together))
    members = written(
        sets.join(hubs, "owner").withColumn("class", classes)
        .withColumn("block", F.xxhash64("hub.gram", "class", salt))
        .select("owner", "n", "copies", "held", "grams", "block", "class"), "members")
    where = held.select("owner", "gram").join(members.select("owner", "block", "class"), "owner") \
        .select("gram", "block", "class").distinct()
    pairs = (where.alias("x").join(where.alias("y"), "gram")
             .filter("x.block <= y.block AND abs(x.class - y.class) <= 1")
             .select(F.col("x.block").alias("a"), F.col("y.block").alias("b")).distinct())
    sized = members.groupBy("block").agg(F.count(F.lit(1)).alias("size"))
    pairs = written(pairs.join(sized, pairs.a == sized.block)
                    .filter("a != b OR size > 1").select("a", "b"), "pairs")
    cuts = cut_points(members.select(F.explode("held").alias("held")), fragments, bits)
    packed = written(members.groupBy("block").applyInArrow(_fragments(cuts), _BLOCK), "fragments")

    def side(name):
        return packed.select(F.col("block").alias(name), "fragment", *(
            F.col(c).alias(f"{c}_{name}") for c in ("sets", "sizes", "copies", "ends", "grams")))

    met = pairs.join(side("a"), "a").join(side("b"), ["b", "fragment"])
    partial = met.select("a", "b", *(f"{c}_{s}" for s in "ab" for c in ("sets", "sizes", "copies", "ends", "grams"))) \
        .mapInArrow(_count, _PARTIAL)
    return partial.groupBy("a", "b").applyInArrow(_summed(percent), _LINKS)


def ngram_join(docs: DataFrame, key: str = "doc_id", text: str = "text", *, n: int = 5, percent: int = 80,
               fragments: int = 4, block: int = 256, block_grams: int = 1 << 19, bucket_grams: int = 1 << 18,
               flush: int = 1 << 20, hot: int = 64) -> DataFrame:
    """``key, n_shingles, component_id, n_links`` for each row of ``docs``."""
    plain = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    words = (plain.agg(F.sum(F.length("text"))).first()[0] or 0) // 6
    bits = min(20, max(0, (words // bucket_grams).bit_length()))
    dealt = plain.mapInArrow(_deal(n, bits, flush, hot), _SETS)
    found = written(dealt.groupBy("bucket").applyInArrow(_shared(bits), _SHARED), "sets", "kind")
    rows = found.filter("kind = 0").select("key", "owner", "digest", "n")
    distinct = written(rows.groupBy("digest").agg(
        F.min("owner").alias("owner"), F.first("n").alias("n"), F.count(F.lit(1)).alias("copies"),
        F.min("key").alias("least")), "distinct")
    need = F.floor((F.col("n") * percent + 99) / 100)
    sets = (found.filter("kind = 1").select("owner", "held", "gram")
            .join(distinct.select("owner", "n", "copies"), "owner")
            .groupBy("owner", "n", "copies").agg(F.array_sort(F.collect_list(F.struct("held", "gram"))).alias("s"))
            .withColumn("first", (F.size("s") - need + 1).cast("int")).filter("first > 0")
            .select("owner", "n", "copies", F.col("s.held").alias("held"), F.col("s.gram").alias("grams"), "first"))
    similar = similar_sets(written(sets, "prefixes"), bits, percent, fragments, block, block_grams)
    with session_conf(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch="16"):
        links = written(similar, "roots")  # a row holds the sets of two blocks
    groups = components(links, "owner", "root").withColumnRenamed("vertex", "owner")
    counts = links.groupBy("owner").agg(F.sum("links").alias("links"))
    named = distinct.select("owner", "least").join(groups, "owner")
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    resolved = distinct.join(groups.join(smallest, "component").select("owner", "component_id"), "owner", "left") \
        .join(counts, "owner", "left").select(
            "digest", F.coalesce("component_id", "least").alias("component_id"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    empty = F.col("n") == 0
    return rows.join(resolved, "digest").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"),
        F.when(empty, F.col("key")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(empty, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"))
