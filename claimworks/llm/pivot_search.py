"""Exact top-k inner products by pivot-table elimination.

Vectors become whole numbers, floor(256 x). Blocks of vectors are stored with their distances to a
few pivots. For a query q, a vector c and any pivot p, |d(q,p) - d(c,p)| is at most d(q,c), so the
largest of these over all pivots bounds the distance from below and the inner product,
(|q|^2 + |c|^2 - d^2) / 2, from above. Each query visits the vectors of a block in the order of
that bound and stops when the bound falls below its k-th best score. Results are exact.

Queries and stored blocks meet by group: a task holds one block of queries and ``blocks_per_task``
blocks of vectors, of bounded size. The driver sees the pivots and a few counts.

Defined results: vectors that are null, hold null or non-finite components, or overflow a double
when scaled take no part. Inner products are between vectors of the same length. A query is left
out of its own candidates by row, so another row with the same id is a candidate. Ties go to the
smaller id, null ids last. Scores past a long are set to the nearest long. An empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimworks.llm.common import written

SCALE = 256
_NO_ID = np.iinfo(np.int64).max
_BLOCK = "dim int, block long, uids binary, ids binary, vectors binary, distances binary"
_HITS = "query_uid long, query_id long, vec_id long, vec_uid long, score long"


def scaled(vector) -> np.ndarray | None:
    """floor(256 x) as doubles, which hold these whole numbers exactly."""
    if vector is None or None in vector:
        return None
    with np.errstate(over="ignore", invalid="ignore"):
        out = np.floor(SCALE * np.array(vector, np.float64))
    return out if np.isfinite(out).all() else None


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Far-apart vectors: each next pivot is the one farthest from those chosen."""
    chosen = [0]
    near = np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < min(n, len(sample)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


def sample_pivots(vectors: DataFrame, key: str, embedding: str, n: int, size: int) -> dict[int, np.ndarray]:
    """Pivots per vector length from ``size`` rows with the least hashes. The result of a search
    does not depend on them, only its speed."""
    rows = (vectors.select(F.col(embedding).alias("e"), F.xxhash64(key).alias("h")).filter("e IS NOT NULL")
            .orderBy("h").limit(size).collect())
    by_length: dict[int, list] = {}
    for r in rows:
        v = scaled(r[0])
        if v is not None:
            by_length.setdefault(len(v), []).append(v)
    return {d: choose_pivots(np.array(v), n) for d, v in by_length.items()}


def index(vectors: DataFrame, pivots: dict[int, np.ndarray], key: str = "vec_id", embedding: str = "embedding",
          block: int = 1024) -> DataFrame:
    """Blocks of scaled vectors with their pivot distances."""
    def build(batches):
        part, seen, blocks = TaskContext.get().partitionId(), 0, 0
        held: dict[int, list] = {}

        def row(dim):
            nonlocal blocks
            uids, ids, vs = zip(*held.pop(dim))
            v = np.array(vs).reshape(len(vs), dim)
            blocks += 1
            table = np.stack([np.linalg.norm(v - p, axis=1) for p in pivots.get(dim, np.zeros((1, dim)))], axis=1)
            return (dim, (part << 33) + blocks, np.array(uids).tobytes(), np.array(ids).tobytes(), v.tobytes(),
                    table.tobytes())

        def out(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), *[pa.binary()] * 4))],
                names=[c.split()[0] for c in _BLOCK.split(", ")])

        for batch in batches:
            for vid, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                v = scaled(v)
                if v is None:
                    continue
                rows = held.setdefault(len(v), [])
                rows.append(((part << 33) + seen, _NO_ID if vid is None else vid, v))
                seen += 1
                if len(rows) == block:
                    yield out([row(len(v))])
        for dim in list(held):
            yield out([row(dim)])

    return vectors.select(F.col(key).cast("long"), F.col(embedding).cast("array<double>")).mapInArrow(build, _BLOCK)


def _open(row) -> tuple[np.ndarray, ...]:
    uids, ids = np.frombuffer(row["uids"], np.int64), np.frombuffer(row["ids"], np.int64)
    return (uids, ids, np.frombuffer(row["vectors"]).reshape(len(uids), row["dim"]),
            np.frombuffer(row["distances"]).reshape(len(uids), -1))


def _queries(every: int):
    """The rows of the index whose id is divisible by ``every``, in small blocks of their own."""
    def take(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                uids, ids, v, table = _open(r)
                is_query = (ids % every == 0) & (ids != _NO_ID)
                if is_query.any():
                    rows.append((r["dim"], r["block"], *(x[is_query].tobytes() for x in (uids, ids, v, table))))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t.type) for c, t in zip(zip(*rows), batch.schema)], schema=batch.schema)
    return take


def _exact(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers."""
    top = (np.abs(v).max() if v.size else 0.0) * (np.abs(q).max() if q.size else 0.0) * max(1, len(q))
    if top < 2.0 ** 53:
        return (v @ q).astype(np.int64)
    ints, limit = [int(x) for x in q], np.iinfo(np.int64)
    return np.array([min(limit.max, max(limit.min, sum(int(a) * b for a, b in zip(row, ints)))) for row in v], np.int64)


def _best(score, ids, uids, k: int) -> tuple[np.ndarray, ...]:
    order = np.lexsort((uids, ids, -score.astype(object) if score.size and score.min() == np.iinfo(np.int64).min
                        else -score))[:k]
    return score[order], ids[order], uids[order]


def search_block(queries: tuple, blocks: list[tuple], k: int, step: int = 64) -> list[tuple]:
    """For each query its best k over the blocks: arrays of score, id, row."""
    quids, _, qv, qd = queries
    empty = np.empty(0, np.int64)
    best = [(empty, empty, empty)] * len(quids)
    qn = (qv * qv).sum(axis=1)
    for uids, ids, v, d in blocks:
        cn = (v * v).sum(axis=1)
        low = np.zeros((len(quids), len(uids)))
        for p in range(d.shape[1]):
            np.maximum(low, np.abs(qd[:, p, None] - d[None, :, p]), out=low)
        most = (qn[:, None] + cn[None, :] - low * low) / 2
        most += 1e-9 * (qn[:, None] + cn[None, :]) + 1e-6  # rounding of distances
        for i, q in enumerate(qv):
            score, sid, suid = best[i]
            least = score[-1] if len(score) == k else -np.inf
            todo = np.flatnonzero((most[i] >= least) & (uids != quids[i]))
            todo = todo[np.argsort(-most[i][todo], kind="stable")]
            for at in range(0, len(todo), step):
                if len(score) == k and most[i][todo[at]] < score[-1]:
                    break
                now = todo[at:at + step]
                score, sid, suid = _best(np.concatenate([score, _exact(v[now], q)]),
                                         np.concatenate([sid, ids[now]]), np.concatenate([suid, uids[now]]), k)
            best[i] = score, sid, suid
    return best


def top_k(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", *, every: int = 50, k: int = 5,
          pivots: int = 32, sample: int = 1024, block: int = 1024, query_block: int = 2048,
          blocks_per_task: int = 8) -> DataFrame:
    """``query_id, rank, vec_id, score`` for every row whose id is divisible by ``every``."""
    chosen = sample_pivots(vectors, key, embedding, pivots, sample)
    blocks = written(index(vectors, chosen, key, embedding, block), "blocks")
    queries = written(blocks.mapInArrow(_queries(every), _BLOCK), "queries")
    sizes = (blocks.groupBy("dim").agg(F.count(F.lit(1)).alias("blocks"))
             .join(queries.groupBy("dim").agg((F.sum(F.octet_length("ids")) / 8).cast("long").alias("queries")), "dim")
             .select("dim", F.ceil(F.col("blocks") / blocks_per_task).cast("int").alias("groups"),
                     F.ceil(F.col("queries") / query_block).cast("int").alias("parts")))
    hashed = F.xxhash64("block")
    stored = (blocks.join(sizes, "dim").withColumn("grp", F.pmod(hashed, F.col("groups")).cast("int"))
              .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("groups", "parts"))
    asked = (queries.join(sizes, "dim").withColumn("part", F.pmod(hashed, F.col("parts")).cast("int"))
             .withColumn("grp", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).drop("groups", "parts"))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            many = [_open(r) for r in left.to_dict("records")]
            q = tuple(np.concatenate(x) for x in zip(*(_open(r) for r in right.to_dict("records"))))
            for uid, qid, (score, ids, uids) in zip(q[0], q[1], search_block(q, many, k)):
                out += [(uid, qid, i, u, s) for s, i, u in zip(score, ids, uids)]
        return pd.DataFrame(out, columns=[c.split()[0] for c in _HITS.split(", ")])

    keys = ["dim", "part", "grp"]
    hits = stored.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(meet, _HITS)
    order = Window.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id", "vec_uid")
    return (hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.when(F.col("vec_id") != _NO_ID, F.col("vec_id")).alias("vec_id"), "score"))
