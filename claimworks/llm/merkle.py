"""Merkle manifest of a dataset whose parents keep SHA-256 midstates.

A row's leaf is the hash of its fields. The leaves of a group, in key order, are the bottom of the
group's tree; every ``FAN`` nodes in a row make a parent until one, the subroot, is left. The
subroots in group order are the bottom of one more tree, whose top is the root.

Digests enter a parent as hex text, which is 64 bytes and so just one block of SHA-256. The state
before a child's slot is therefore eight words; each parent stores its children and these states.
A changed child is folded in by taking up the state of its slot, hashing the new digest and the
siblings to its right; nothing to its left is read again. Hash objects of the standard library
cannot be stored, so the states are computed here, for all parents of a batch at once.

Places in a group come from a range sort with per-partition offsets and a run of at most ``FAN``
nodes is the largest group there is, so a group that holds a third of all rows fills no one task.
Paths are joined top down, one row per parent.

Defined results: a null field is written ``-``; a null group comes first, as does a null key; rows
that share group and key are ordered by leaf; equal rows are leaves of their own; a group of one row
has its leaf as subroot; without siblings the proof is the hash of the empty text; an empty table
gives an empty result. Only the named fields, the key and the group are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimworks.llm.common import extended, written

#: Children of a parent.
FAN = 16
_FILE_ROWS = 1 << 15
_STEPS = "array<struct<slot: int, state: binary, children: binary>>"
_PLACE_BITS = 33  # of monotonically_increasing_id that count within a partition
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)
_RESULT = "key long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _primes(n: int) -> list[int]:
    found: list[int] = []
    while len(found) < n:
        c = found[-1] + 1 if found else 2
        while any(c % p == 0 for p in found):
            c += 1
        found.append(c)
    return found


def _cube_root(x: int) -> int:
    low, high = 0, 1 << (x.bit_length() // 3 + 1)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if middle ** 3 <= x else (low, middle - 1)
    return low


# The hash's constants: fractions of square and cube roots of primes.
_START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], np.uint32)
_ROUNDS = [np.uint32(_cube_root(p << 96) & 0xFFFFFFFF) for p in _primes(64)]


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """One step of SHA-256 in many lanes: states (8, n) and blocks (16, n) of big-endian words."""
    w = np.empty((64, block.shape[1]), np.uint32)
    w[:16] = block
    for t in range(16, 64):
        x, y = w[t - 15], w[t - 2]
        w[t] = (w[t - 16] + w[t - 7] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3)))
                + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))))
    a, b, c, d, e, f, g, h = state
    for t in range(64):
        x = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + _ROUNDS[t] + w[t]
        y = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = x + y, a, b, c, d + x, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


def _hex_block(digests: np.ndarray) -> np.ndarray:
    """Digests (n, 32) as the block their hex text makes."""
    text = np.empty((len(digests), 64), np.uint8)
    text[:, 0::2], text[:, 1::2] = _HEX[digests >> 4], _HEX[digests & 15]
    return text.view(">u4").astype(np.uint32).T


def _bytes(state: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(state.T).astype(">u4").view(np.uint8).reshape(-1, 32)


def _words(states: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(states).view(">u4").astype(np.uint32).T


def _ended(state: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Digests (n, 32) of messages that end after ``counts`` whole blocks."""
    block = np.zeros((16, len(counts)), np.uint32)
    block[0], block[15] = 0x80000000, counts * 512
    return _bytes(compress(state, block))


def midstates(children: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of parents with children (n, FAN, 32): the state before each slot, and the digests."""
    state = np.repeat(_START[:, None], len(counts), 1)
    kept = np.zeros((len(counts), FAN, 32), np.uint8)
    for slot in range(FAN):
        on = np.flatnonzero(counts > slot)
        kept[on, slot] = _bytes(state[:, on])
        state[:, on] = compress(state[:, on], _hex_block(children[on, slot]))
    return kept, _ended(state, counts)


def fold(state: np.ndarray, digest: np.ndarray, slot: np.ndarray, children: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Parents' digests with ``digest`` in ``slot``: resumes its state, then only what is right of it."""
    now = compress(_words(state), _hex_block(digest))
    for step in range(1, FAN):
        on = np.flatnonzero(slot + step < counts)
        if len(on):
            now[:, on] = compress(now[:, on], _hex_block(children[on, slot[on] + step]))
    return _ended(now, counts)


def _digests(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def _runs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Joined digests, at most FAN of them a row, as (n, FAN, 32) and their counts; null has none."""
    values = [v or b"" for v in column.to_pylist()]
    out = np.frombuffer(b"".join(v.ljust(FAN * 32, b"\0") for v in values), np.uint8).reshape(-1, FAN, 32)
    return out, np.array([len(v) // 32 for v in values], np.int64)


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        children, counts = _runs(batch.column(batch.schema.get_field_index("children")))
        states, digests = midstates(children, counts)
        kept = pa.array([s[:n].tobytes() for s, n in zip(states, counts)], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns, kept, _binary(digests)],
                                         names=[*batch.schema.names, "states", "digest"])


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[str], unique: bool = False) -> DataFrame:
    """``pos`` of each row in its group (never null) and the group's size ``width``, without a task per
    group: ranges are sorted, counted per group, and the counts before each range are added up.
    Equal rows are spread over ranges too, unless the order is ``unique``."""
    keys = [*group, *order]
    if not unique:
        rows = written(rows.withColumn("salt", F.monotonically_increasing_id()), "unordered")
        keys.append("salt")
    placed = written(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                     .withColumn("place", F.monotonically_increasing_id()), "ordered")
    placed = placed.withColumn("part", F.shiftright("place", _PLACE_BITS))
    parts = placed.groupBy(*group, "part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    held = [F.col(g) for g in group] or [F.lit(0)]
    before = F.sum("n").over(Window.partitionBy(*held).orderBy("part")) - F.col("n")
    parts = parts.select(*[F.col(g).alias(f"_{g}") for g in group], F.col("part").alias("_part"),
                         (before - F.col("first")).alias("shift"), F.sum("n").over(Window.partitionBy(*held)).alias("width"))
    same = F.col("part") == F.col("_part")
    for g in group:
        same &= F.col(g) == F.col(f"_{g}")
    return (placed.join(parts, same).withColumn("pos", F.col("place") + F.col("shift"))
            .drop("salt", "place", "part", "_part", "shift", *[f"_{g}" for g in group]))


def _parents(nodes: DataFrame, carried: Sequence[str]) -> DataFrame:
    members = F.sort_array(F.collect_list(F.struct("pos", "digest", *carried)))
    runs = nodes.groupBy("tree", "width", F.expr(f"pos DIV {FAN}").alias("parent")).agg(members.alias("members"))
    joined = F.unhex(F.array_join(F.transform("members", lambda m: F.hex(m["digest"])), ""))
    runs = runs.select("tree", F.col("parent").alias("pos"), F.ceil(F.col("width") / FAN).alias("width"),
                       joined.alias("children"), *(["members"] if carried else []))
    return runs.mapInArrow(_hashed, extended(runs.schema, states="binary", digest="binary"))


def _few(rows: DataFrame, count: int | None) -> DataFrame:
    """A table of known size in as many files as it needs."""
    return rows if count is None else rows.coalesce(max(1, -(-count // _FILE_ROWS)))


def build(nodes: DataFrame, carried: Sequence[str] = ()) -> list[tuple[DataFrame, int]]:
    """The levels of parents over ``tree, pos, width, digest``, lowest first, each a stored table
    ``tree, pos, width, children, states, digest`` with its number of rows; the lowest has its
    members' ``carried`` columns."""
    levels: list[tuple[DataFrame, int]] = []
    most, count = nodes.agg(F.max("width")).first()[0] or 0, None
    while most > 1:
        level = written(_few(_parents(nodes.filter("width > 1"), carried if not levels else ()), count), "merkle")
        count = level.count()
        levels.append((level, count))
        nodes, most = level, -(-most // FAN)
    return levels


def tops(nodes: DataFrame, levels: Sequence[tuple[DataFrame, int]]) -> DataFrame:
    """The one node that is left of each tree."""
    out = nodes.filter("width = 1").select("tree", "digest")
    for level, _ in levels:
        out = out.unionByName(level.filter("width = 1").select("tree", "digest"))
    return out


def _step(pos: Column) -> Column:
    slot = (pos % FAN).cast("int")
    return F.struct(slot.alias("slot"), F.col("above.states").substr(slot * 32 + 1, F.lit(32)).alias("state"),
                    F.col("above.children").alias("children"))


def _hung(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """Nodes with the path over their parents in ``above``."""
    columns = [F.col(f"mine.{c}") for c in nodes.columns]
    on = (F.col("mine.tree") == F.col("above.tree")) & (F.expr(f"mine.pos DIV {FAN}") == F.col("above.pos"))
    return nodes.alias("mine").join(above.alias("above"), on).select(
        *columns, F.concat(F.array(_step(F.col("mine.pos"))), "above.path").alias("path"), "above.crown")


def with_paths(levels: Sequence[tuple[DataFrame, int]], crowns: DataFrame) -> DataFrame | None:
    """The lowest level with each parent's ``path``: per level above it the slot, its state and all
    children. ``crowns`` (tree, path, crown) is what lies over each tree's top."""
    above = None
    for i, (level, count) in reversed(list(enumerate(levels))):
        now = level.filter("width = 1").join(crowns, "tree").select(*level.columns, "path", "crown")
        if above is not None:
            now = now.unionByName(_hung(level.filter("width > 1"), above))
        above = written(_few(now, count), "paths") if i else now
    return above


def _proved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Folds the members of each run up its path. Members whose parents agree go on as one."""
    for batch in batches:
        col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        of = np.repeat(np.arange(batch.num_rows), col["members"].value_lengths().to_numpy())
        flat = col["members"].flatten()
        leaf, now = _digests(flat.field("digest")), _digests(flat.field("found"))
        slot = np.asarray(flat.field("pos").to_numpy() % FAN, np.int64)
        children, counts = _runs(col["children"])
        states, _ = _runs(col["states"])
        on = np.flatnonzero(counts[of] > 0)
        now = now.copy()
        now[on] = fold(states[of[on], slot[on]], now[on], slot[on], children[of[on]], counts[of[on]])
        same = np.concatenate([of[:, None].astype(">u8").view(np.uint8), now], 1)
        _, first, lane = np.unique(np.ascontiguousarray(same).view("V40").ravel(), return_index=True, return_inverse=True)
        paths = col["path"].to_pylist()
        top = _climbed(now[first], of[first], paths)[lane.ravel()]
        hexes = [(c or b"").hex() for c in col["children"].to_pylist()]
        upper = ["".join(_others(s["children"].hex(), s["slot"]) for s in p) for p in paths]
        proofs = [hashlib.sha256((_others(hexes[r], s) + upper[r]).encode()).hexdigest() for r, s in zip(of, slot)]
        subroot, root = (col[n].to_pylist() for n in ("subroot", "root"))
        yield pa.RecordBatch.from_arrays([
            flat.field("key"), pa.array([d.tobytes().hex() for d in leaf], pa.string()),
            pa.array([subroot[r].hex() for r in of], pa.string()), pa.array([root[r].hex() for r in of], pa.string()),
            pa.array(proofs, pa.string()), pa.array([d.tobytes().hex() for d in top], pa.string()),
            pa.array([d.tobytes() == root[r] for d, r in zip(top, of)], pa.bool_())],
            names=[c.split()[0] for c in _RESULT.split(", ")])


def _others(children: str, slot: int) -> str:
    return children[:64 * slot] + children[64 * (slot + 1):]


def _climbed(digest: np.ndarray, of: np.ndarray, paths: list) -> np.ndarray:
    digest = digest.copy()
    for height in range(max(map(len, paths), default=0)):
        steps = {r: paths[r][height] for r in set(of.tolist()) if len(paths[r]) > height}
        rows = sorted(steps)
        at = np.searchsorted(rows, of)
        on = np.flatnonzero(np.isin(of, rows))
        at = at[on]
        slot = np.array([steps[r]["slot"] for r in rows], np.int64)
        state = np.frombuffer(b"".join(steps[r]["state"] for r in rows), np.uint8).reshape(-1, 32)
        children, counts = _runs(pa.array([steps[r]["children"] for r in rows], pa.binary()))
        digest[on] = fold(state[at], digest[on], slot[at], children[at], counts[at])
    return digest


def leaf(fields: Mapping[str, Column]) -> Column:
    """Hash of the fields: ``-`` for null, else bytes, colon and value."""
    def entry(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(entry, fields.values())), 256))


def prove(rows: DataFrame, fields: Sequence[str], key: str, group: str, altered: Mapping[str, Column] | None = None) -> DataFrame:
    """Per row its leaf, subroot, root, proof, and the root that comes out when the row is found
    with the fields ``altered`` says."""
    now = {f: F.col(f) for f in fields}
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))  # sorts as groups do, null first
    nodes = written(numbered(rows.select(tree.alias("tree"), F.col(key).cast("long").alias("key"),
                                         leaf(now).alias("digest"), leaf({**now, **(altered or {})}).alias("found")),
                             ["tree"], ["key", "digest"]), "leaves")
    levels = build(nodes, ("key", "found"))
    crowns = _crowns(tops(nodes, levels))
    runs = nodes.filter("width = 1").join(crowns, "tree").select(
        F.lit(None).cast("binary").alias("children"), F.lit(None).cast("binary").alias("states"),
        F.array(F.struct("pos", "digest", "key", "found")).alias("members"), "path", "crown")
    if levels:
        runs = runs.unionByName(with_paths(levels, crowns).select(*runs.columns))
    runs = runs.select("children", "states", "members", "path", "crown.subroot", "crown.root")
    return runs.mapInArrow(_proved, _RESULT).withColumnRenamed("key", key)


def _crowns(subroots: DataFrame) -> DataFrame:
    """What lies over each group's tree: its subroot, the root and the path between them."""
    heads = numbered(subroots, [], ["tree"], unique=True)
    heads = written(heads.select(F.lit("").alias("tree"), "pos", "width", "digest", F.col("tree").alias("of")), "heads")
    count, levels = heads.count(), build(heads)
    root = tops(heads, levels).select("tree", F.array().cast(_STEPS).alias("path"),
                                      F.struct(F.col("digest").alias("root")).alias("crown"))
    if levels:
        heads = _hung(heads, with_paths(levels, root))
    else:
        heads = heads.join(root, "tree")
    heads = heads.select(F.col("of").alias("tree"), F.col("path").cast(_STEPS).alias("path"),
                         F.struct(F.col("digest").alias("subroot"), F.col("crown.root").alias("root")).alias("crown"))
    return written(_few(heads, count), "crowns")
