"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn from a seed and its code point. A trigram is
the product of its letters' vectors, rotated by their place. A document is the sum of its
trigrams' vectors, a language the sum of its documents, and a document gets the language whose
profile has the largest cosine with it. Profiles are centred: what all languages share is taken
off, so that the cosine tells languages apart.

Learning reads every training row; each task sends one vector per language, added up by Spark. The
driver holds the profiles only: languages x dimensions. Defined results: a null text, or one
without letters, is ``und`` with score 0; ties go to the smaller name; without training rows every
text is ``und``; an empty table gives an empty result. Other columns are not read.

``resembling`` judges whether a text is in any of the languages. Centred profiles cannot tell: they
sum to zero, so some cosine is never negative. Plain profiles can, but short texts have few of a
language's trigrams and a small cosine, so it is held against the median of labelled texts of that
language with about as many distinct trigrams.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.llm.common import extended, segments

DIMENSIONS = 1024
SEED = 20240
UNKNOWN = "und"
#: Part of a language's median cosine that a text needs, and labelled texts that make a median.
LEAST_PART, LEAST_TEXTS = 0.5, 8
#: Trigram vectors a worker keeps.
_KEPT = 40_000
_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams inside the words of a text, with their counts. A word's start and end
    count as a letter of their own, code 0."""
    parts = []
    for piece in segments(text):
        a = np.frombuffer(piece.lower().encode("utf-32-le", "replace"), np.uint32)
        a = np.concatenate(([0], np.where(_is_letter()[a], a, 0), [0])).astype(np.int64)
        a = a[np.concatenate(([True], (a[1:] != 0) | (a[:-1] != 0)))]
        codes = (a[:-2] << 42) | (a[1:-1] << 21) | a[2:]
        parts.append(codes[a[1:-1] != 0])
    return np.unique(np.concatenate(parts), return_counts=True)


class Vectors:
    """Vectors of trigrams, kept while a worker lives."""

    def __init__(self, dimensions: int, seed: int):
        self.d, self.seed = dimensions, seed
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.table = np.empty((1024, dimensions), np.int8)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            if len(self.letters) > 20_000:
                self.letters.clear()
            self.letters[code] = np.random.default_rng([self.seed, code]).integers(0, 2, self.d, np.int8) * 2 - 1
        return self.letters[code]

    def of(self, codes: np.ndarray) -> np.ndarray:
        """One row per trigram."""
        if len(codes) > _KEPT:
            return np.concatenate([self.of(codes[i:i + _KEPT]) for i in range(0, len(codes), _KEPT)])
        new = [c for c in codes.tolist() if c not in self.rows]
        if len(self.rows) + len(new) > _KEPT:
            self.rows.clear()
            new = codes.tolist()
        for c in new:
            i = self.rows[c] = len(self.rows)
            if i >= len(self.table):
                self.table = np.concatenate([self.table, np.empty_like(self.table)])
            self.table[i] = (np.roll(self.letter(c >> 42), 2) * np.roll(self.letter(c >> 21 & 0x1FFFFF), 1)
                             * self.letter(c & 0x1FFFFF))
        return self.table[[self.rows[c] for c in codes.tolist()]]

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        total = np.zeros(self.d, np.float64)
        for i in range(0, len(codes), 4096):
            total += counts[i:i + 4096].astype(np.float32) @ self.of(codes[i:i + 4096]).astype(np.float32)
        return total


_vectors: dict[tuple, Vectors] = {}


def vectors(dimensions: int, seed: int) -> Vectors:
    if (dimensions, seed) not in _vectors:
        _vectors[dimensions, seed] = Vectors(dimensions, seed)
    return _vectors[dimensions, seed]


def learn_plain(labelled: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS,
                seed: int = SEED) -> dict[str, np.ndarray]:
    """Profiles of length 1, not centred, of all languages from every labelled row with a text."""
    def bundles(batches):
        grams: dict[str, dict[int, int]] = {}
        out: dict[str, np.ndarray] = {}
        space = vectors(dimensions, seed)

        def flush(name):
            counts = grams.pop(name)
            codes = np.fromiter(counts.keys(), np.int64, len(counts))
            sums = space.bundle(codes, np.fromiter(counts.values(), np.int64, len(counts)))
            out[name] = out.get(name, 0) + sums

        for batch in batches:
            for body, name in zip(batch.column(0), batch.column(1).to_pylist()):
                codes, counts = trigrams(body.as_py())
                mine = grams.setdefault(name, {})
                for c, n in zip(codes.tolist(), counts.tolist()):
                    mine[c] = mine.get(c, 0) + n
                if len(mine) > 50_000:
                    flush(name)
        for name in list(grams):
            flush(name)
        for name, sums in out.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([name] * dimensions), pa.array(range(dimensions), pa.int32()),
                pa.array(np.rint(sums).astype(np.int64))], names=["lang", "i", "v"])

    rows = (labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).dropna()
            .mapInArrow(bundles, "lang string, i int, v long"))
    total = rows.groupBy("lang", "i").agg(F.sum("v").alias("v"))
    per_lang = total.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("a"))
    sums = {r[0]: np.array([x[1] for x in r[1]], float) for r in per_lang.orderBy("lang").collect()}
    return {k: v / (np.linalg.norm(v) or 1.0) for k, v in sums.items()}


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS,
          seed: int = SEED) -> dict[str, np.ndarray]:
    """Centred profiles of all languages."""
    units = learn_plain(labelled, text, lang, dimensions, seed)
    shared = np.mean(list(units.values()), axis=0) if len(units) > 1 else 0.0
    centred = {k: v - shared for k, v in units.items()}
    return {k: v / (np.linalg.norm(v) or 1.0) for k, v in centred.items()}


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], key: str = "doc_id", text: str = "text",
            dimensions: int = DIMENSIONS, seed: int = SEED, keep: bool = False) -> DataFrame:
    """``key, lang_pred, score`` per row; with ``keep`` the columns of ``docs`` and these two, named
    ``__lang`` and ``__score``. The score is (1 + cosine) / 2."""
    names = sorted(profiles)
    matrix = np.array([profiles[n] for n in names]) if names else np.zeros((0, dimensions))

    def decide(body: str | None) -> tuple[str, float]:
        codes, counts = trigrams(body or "")
        if not len(codes) or not names:
            return UNKNOWN, 0.0
        v = vectors(dimensions, seed).bundle(codes, counts)
        cosine = matrix @ (v / (np.linalg.norm(v) or 1.0))
        best = int(np.argmax(cosine))
        return names[best], float(min(1.0, max(0.0, (1 + cosine[best]) / 2)))

    def judge(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text) if keep else 1
            said = [decide(body.as_py()) for body in batch.column(at)]
            extra = [pa.array([s[0] for s in said], pa.string()), pa.array([s[1] for s in said], pa.float64())]
            mine = batch.columns if keep else [batch.column(0)]
            heads = batch.schema.names if keep else [key]
            yield pa.RecordBatch.from_arrays([*mine, *extra], names=[*heads, "__lang", "__score"])

    base = docs if keep else docs.select(key, F.col(text).alias("__text"))
    schema = base.schema if keep else base.select(key).schema
    out = base.mapInArrow(judge, extended(schema, __lang="string", __score="double"))
    return out if keep else out.withColumnsRenamed({"__lang": "lang_pred", "__score": "score"})


def _cosines(body: str | None, matrix: np.ndarray, dimensions: int, seed: int) -> tuple[int, np.ndarray] | None:
    """Bits of the number of distinct trigrams, and the cosine with each profile. None without letters."""
    codes, counts = trigrams(body or "")
    if not len(codes):
        return None
    v = vectors(dimensions, seed).bundle(codes, counts)
    return len(codes).bit_length(), matrix @ (v / (np.linalg.norm(v) or 1.0))


def typical(labelled: DataFrame, plain: dict[str, np.ndarray], text: str = "text", lang: str = "lang",
            dimensions: int = DIMENSIONS, seed: int = SEED) -> dict[str, dict[int, float]]:
    """Per language and bits of the number of distinct trigrams, the median cosine of its labelled rows
    with its plain profile. A median of fewer than ``LEAST_TEXTS`` rows is left out."""
    def measure(batches):
        for batch in batches:
            out = []
            for body, name in zip(batch.column(0), batch.column(1).to_pylist()):
                found = _cosines(body.as_py(), plain[name][None], dimensions, seed)
                if found:
                    out.append((name, found[0], float(found[1][0])))
            yield pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int32()),
                pa.array([x[2] for x in out], pa.float64())], names=["lang", "bits", "cosine"])

    rows = (labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).dropna()
            .mapInArrow(measure, "lang string, bits int, cosine double"))
    medians = rows.groupBy("lang", "bits").agg(F.percentile_approx("cosine", 0.5).alias("middle"),
                                               F.count(F.lit(1)).alias("n"))
    out: dict[str, dict[int, float]] = {name: {} for name in plain}
    for r in medians.filter(F.col("n") >= LEAST_TEXTS).collect():
        out[r["lang"]][r["bits"]] = r["middle"]
    return out


def resembling(docs: DataFrame, plain: dict[str, np.ndarray], medians: dict[str, dict[int, float]],
               text: str = "text", dimensions: int = DIMENSIONS, seed: int = SEED) -> DataFrame:
    """The rows whose text has letters and comes up to ``LEAST_PART`` of a language's median. Without a
    median of its number of trigrams that of the next smaller number counts; a text with fewer than
    any median tells too little and stays."""
    names = sorted(plain)
    matrix = np.array([plain[n] for n in names]) if names else np.zeros((0, dimensions))

    def least(bits: int) -> np.ndarray:
        return np.array([LEAST_PART * m[max(b for b in m if b <= bits)] if any(b <= bits for b in m) else -1.0
                         for m in (medians[n] for n in names)])

    needed = [least(bits) for bits in range(64)]

    def fits(body: str | None) -> bool:
        found = _cosines(body, matrix, dimensions, seed)
        return found is not None and bool((found[1] >= needed[found[0]]).any())

    def judge(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text)
            yield batch.filter(pa.array([fits(body.as_py()) for body in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(judge, docs.schema)


def held_out(key) -> F.Column:
    """Rows kept from learning: checksum of the key as text, remainder 2 of 4."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4 == 2
