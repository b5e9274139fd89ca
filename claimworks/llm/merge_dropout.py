"""SentencePiece encoding with seeded merge-dropout, and decoding.

A word starts as its characters. An agenda holds every pair of neighbours that a piece of the
vocabulary joins, best score first, then leftmost. When a pair comes up, a hash keyed by the seed,
the document, the word's place in it and the candidate decides whether it is skipped (with
probability ``dropout``); otherwise it is merged and its new neighbours join the agenda. So each
occurrence of a word is cut for itself, alike in every run of the job. A dropout of 0 gives the
library's own segmentation.

What is kept of a word is its plain cut and the candidates that come up on the way there. Occurrences
none of whose candidates is skipped take the plain cut; the agendas of the others run side by side,
one step of all of them at a time, over matrices of symbols. Both give what ``segment`` gives.

Decoding joins the pieces; no segmentation loses anything: characters without a piece, and a
literal U+2581 (which the library takes for a space), are written as byte pieces. No shuffle.

Defined results: null stays null in decoding and becomes no ids in encoding; an empty text has no
ids; null keys are hashed as empty; an empty table gives an empty result. Whole texts are read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.llm.common import extended, mix64

_SPACE = "▁"
_UNITS = re.compile(r" *[^ ]+| +")
_CUT = re.compile(r"(?<=[^ ]) ")
#: Word parts and units kept, and characters of them; characters of a word whose agendas run side by
#: side; rows and characters encoded together.
_KEPT_PARTS, _KEPT_UNITS, _KEPT_CHARS = 600_000, 300_000, 1 << 23
_LONG = 64
_WIDTHS = (2, 4, 6, 8, 12, 16, 32, _LONG)
_ROWS = 512
_CHARS = 1 << 20
_NONE = 1 << 40
_NO_RANK = np.int32(2 ** 31 - 1)
#: Odd multipliers of the keyed hash; it has 16 bits, so a dropout counts in steps of 1/65536.
_LEFT, _RANK, _MIX = 0x9E3779B1, 0x85EBCA6B, 0xC2B2AE3D


class Vocabulary:
    """Pieces in the order of their scores, byte pieces, and the pairs of characters inside pieces."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.bytes_of: list[bytes] = [b""] * n
        self.byte_ids = [0] * 256
        scored = []
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value], self.bytes_of[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                scored.append((-model.get_score(i), i, piece))
                self.bytes_of[i] = piece.replace(_SPACE, " ").encode()
        self.rank = {piece: at for at, (_, _, piece) in enumerate(sorted(scored))}
        self.id_of = {piece: i for _, i, piece in scored}
        self.pairs = {piece[i:i + 2] for _, _, piece in scored for i in range(len(piece) - 1)}

    def ids(self, symbols) -> bytes:
        out = []
        for s in symbols:
            known = self.id_of.get(s)
            if known is not None:
                out.append(known)
            else:
                out.extend(self.byte_ids[b] for b in s.encode("utf-8", "replace"))
        return struct.pack(f"<{len(out)}I", *out)

    def parts(self, word: str) -> list[str]:
        """A word cut between characters that stand together in no piece: nothing merges there."""
        out, start = [], 0
        for i in range(1, len(word)):
            if word[i - 1:i + 1] not in self.pairs:
                out.append(word[start:i])
                start = i
        return [*out, word[start:]]


def skips(key: int, left: int, rank: int, limit: int) -> bool:
    """Whether the keyed hash skips the candidate of this rank whose first character is ``left``."""
    return ((key ^ left * _LEFT ^ rank * _RANK) * _MIX >> 20) & 0xFFFF < limit


def segment(word: str, rank: dict, key: int = 0, limit: int = 0) -> list[str]:
    """The symbols of a word after its agenda has run: a list of ranks for a short word."""
    if len(word) > _LONG:
        return segment_long(word, rank, key, limit)
    get, symbols, at = rank.get, list(word), list(range(len(word)))
    agenda = [get(a + b, _NONE) for a, b in zip(symbols, symbols[1:])]
    while agenda:
        first = min(agenda)
        if first == _NONE:
            break
        i = agenda.index(first)
        if limit and ((key ^ at[i] * _LEFT ^ first * _RANK) * _MIX >> 20) & 0xFFFF < limit:  # skips()
            agenda[i] = _NONE
            continue
        symbols[i] = joined = symbols[i] + symbols[i + 1]
        del symbols[i + 1], at[i + 1], agenda[i]
        if i < len(agenda):
            agenda[i] = get(joined + symbols[i + 1], _NONE)
        if i:
            agenda[i - 1] = get(symbols[i - 1] + joined, _NONE)
    return symbols


def segment_long(word: str, rank: dict, key: int = 0, limit: int = 0) -> list[str]:
    """The same for a long word, with a heap and links between neighbours."""
    symbols: list[str | None] = list(word)
    n = len(symbols)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    agenda: list[tuple[int, int, int]] = []

    def propose(i: int, j: int) -> None:
        found = rank.get(symbols[i] + symbols[j])
        if found is not None:
            heapq.heappush(agenda, (found, i, j))

    for i in range(n - 1):
        propose(i, i + 1)
    while agenda:
        first, i, j = heapq.heappop(agenda)
        if symbols[i] is None or symbols[j] is None or after[i] != j or rank.get(symbols[i] + symbols[j]) != first:
            continue
        if limit and skips(key, i, first, limit):
            continue
        symbols[i], symbols[j] = symbols[i] + symbols[j], None
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            propose(i, k)
        if before[i] >= 0:
            propose(before[i], i)
    return [s for s in symbols if s is not None]


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``counts`` numbers from each start on."""
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


def _ragged(starts: np.ndarray, counts: np.ndarray, pool: np.ndarray) -> np.ndarray:
    """Pieces of a pool, one after the other."""
    return pool[_runs(starts, counts)]


class Lookup:
    """Values of keys, for arrays of keys: a table with room, where a key lies at its hash or after."""

    def __init__(self, items: list[tuple[int, int]], missing):
        self.bits = max(4, (8 * len(items)).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, missing, np.int32)
        for key, value in items:
            at = int(self._at(np.array([key]))[0])
            while self.keys[at] != -1:
                at = (at + 1) % len(self.keys)
            self.keys[at], self.values[at] = key, value

    def _at(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self._at(keys)
        found = self.keys[at]
        out = self.values[at]
        on = np.flatnonzero((found != keys) & (found != -1))
        while len(on):
            at[on] = (at[on] + 1) % len(self.keys)
            found = self.keys[at[on]]
            out[on] = self.values[at[on]]
            on = on[(found != keys[on]) & (found != -1)]
        return out


class Symbols:
    """Symbols as numbers: a piece has its rank, other characters the numbers after. ``rank`` of two
    neighbours is that of the piece they join to."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.of_char = vocabulary, np.full(0x110000, -1, np.int32)
        pieces = sorted(vocabulary.rank, key=vocabulary.rank.__getitem__)
        self.ids = np.array([vocabulary.id_of[p] for p in pieces], np.uint32)
        self.at, self.n = np.arange(len(pieces)), np.ones(len(pieces), np.int64)
        for rank, piece in enumerate(pieces):
            if len(piece) == 1:
                self.of_char[ord(piece)] = rank
        self.learn(np.array(sorted({ord(c) for p in pieces for c in p}), np.int64))
        pairs = []
        for rank, piece in enumerate(pieces):
            for i in range(1, len(piece)):
                a, b = self._symbol(piece[:i]), self._symbol(piece[i:])
                if a is not None and b is not None:
                    pairs.append(((a << 32) | b, rank))
        self.neighbours = Lookup([((ord(p[0]) << 32) | ord(p[1]), 1) for p in vocabulary.pairs], 0)
        self.pairs = Lookup(pairs, _NO_RANK)

    def _symbol(self, text: str) -> int | None:
        return int(self.of_char[ord(text)]) if len(text) == 1 else self.vocabulary.rank.get(text)

    def learn(self, chars: np.ndarray) -> None:
        """Numbers for characters that have none yet; they are written in bytes."""
        for c in chars[self.of_char[chars] < 0].tolist():
            written = np.array([self.vocabulary.byte_ids[b] for b in chr(c).encode("utf-8", "replace")], np.uint32)
            self.of_char[c] = len(self.n)
            self.at, self.n = np.append(self.at, len(self.ids)), np.append(self.n, len(written))
            self.ids = np.append(self.ids, written)

    def together(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether characters stand next to each other in a piece."""
        return self.neighbours((a << 32) | b) == 1

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs; a negative symbol stands for none."""
        return self.pairs((a.astype(np.int64) << 32) | b)


def _codes(at: np.ndarray, rank: np.ndarray) -> np.ndarray:
    return (at.astype(np.uint64) * np.uint64(_LEFT)) ^ (rank.astype(np.uint64) * np.uint64(_RANK))


def _skipped(keys: np.ndarray, codes: np.ndarray, limit: int) -> np.ndarray:
    """``skips`` for arrays."""
    return _drawn(keys ^ codes, limit)


def _drawn(mixed: np.ndarray, limit: int) -> np.ndarray:
    """The draw of keys mixed with codes, which are overwritten."""
    mixed *= np.uint64(_MIX)
    mixed >>= np.uint64(20)
    mixed &= np.uint64(0xFFFF)
    return mixed < np.uint64(limit)


def run_agendas(symbols: np.ndarray, ranks: np.ndarray, table: Symbols, keys: np.ndarray | None = None, limit: int = 0):
    """The agendas of many words side by side: symbols (n, width), filled up with -1, and the ranks of
    neighbours. Returns the symbols at the end and the candidates as they came up: owners and codes."""
    out, width = symbols.copy(), symbols.shape[1]
    column = np.arange(width, dtype=np.int8)
    places = np.broadcast_to(column, symbols.shape).copy()
    live, came_up = np.arange(len(symbols)), []
    while len(live):
        row = np.arange(len(live))
        least = ranks.argmin(1)
        first = ranks[row, least]
        on = first != _NO_RANK
        if np.count_nonzero(on) < 0.75 * len(live):  # words that are done leave
            out[live] = symbols
            if not on.any():
                break
            live, symbols, places, ranks, least, first = (x[on] for x in (live, symbols, places, ranks, least, first))
            keys = None if keys is None else keys[on]
            row, on = np.arange(len(live)), on[on]
        codes = _codes(places[row, least], first)
        came_up.append((live[on], codes[on]))
        go = on if keys is None else on & ~_skipped(keys, codes, limit)
        ranks[row, least] = _NO_RANK  # skipped, or about to be replaced
        at = np.where(go, least, width).astype(np.int8)[:, None]
        symbols[row[go], least[go]] = first[go]
        right, here = column > at, column >= at
        symbols = np.where(right, _shifted(symbols, -1), symbols)
        places = np.where(right, _shifted(places, 0), places)
        ranks = np.where(here, _shifted(ranks, _NO_RANK), ranks)
        row, at, joined = row[go], least[go], first[go]
        inner = at < width - 1
        ranks[row[inner], at[inner]] = table.rank(joined[inner], symbols[row[inner], at[inner] + 1])
        inner = at > 0
        ranks[row[inner], at[inner] - 1] = table.rank(symbols[row[inner], at[inner] - 1], joined[inner])
    owners = np.concatenate([o for o, _ in came_up]) if came_up else np.empty(0, np.int64)
    return out, owners, np.concatenate([c for _, c in came_up]) if came_up else np.empty(0, np.uint64)


def _shifted(matrix: np.ndarray, last) -> np.ndarray:
    """Each column one to the left."""
    out = np.empty_like(matrix)
    out[:, :-1], out[:, -1] = matrix[:, 1:], last
    return out


class Encoder:
    """Texts to ids. Units of text are cut where no piece can reach across: before a space that follows
    another character. A unit is a row of word parts; both are numbered, and what is known of them lies
    in pools. When they are full, the rarer half of the units goes."""

    def __init__(self, path: str, seed: int, dropout: float, kept_nodes: int = _KEPT_PARTS, kept_units: int = _KEPT_UNITS):
        self.vocabulary, self.seed, self.limit = Vocabulary(path), seed, round(dropout * 2 ** 16)
        self.symbols = Symbols(self.vocabulary)
        self.most_parts, self.most_units = kept_nodes, kept_units
        self._forget()

    def _forget(self) -> None:
        self.units: dict[str, int] = {}
        self.long: dict[int, str] = {}
        self.chars = 0
        none = np.empty(0, np.int64)
        self.used = self.unit_at = self.unit_n = none
        self.code_at = self.code_n = self.id_at = self.id_n = self.char_at = self.char_n = none
        self.codes, self.ids = np.empty(0, np.uint64), np.empty(0, np.uint32)
        self.char_symbols = self.char_ranks = np.empty(0, np.int32)

    def _make_room(self) -> None:
        """Keep the more frequent half of the units, if there is too much."""
        if len(self.code_n) <= self.most_parts and len(self.units) <= self.most_units and self.chars <= _KEPT_CHARS:
            return
        used, bar = self.used, np.median(self.used)
        kept = [u for u, i in self.units.items() if used[i] > bar and len(u) <= _LONG]
        counts = used[[self.units[u] for u in kept]] // 2
        self._forget()
        if kept:
            self._learn(kept)
            self.used = counts

    def _learn(self, units: list[str]) -> None:
        """Take new units in: cut them to parts, where no piece reaches across, and run their agendas."""
        for unit in units:
            self.units[unit] = len(self.units)
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        self.chars += int(sizes.sum())
        text = "".join(units)
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        literal = chars == ord(_SPACE)  # written in bytes; it stops every merge
        chars = np.where(chars == 32, ord(_SPACE), chars)
        starts = np.append(True, literal[:-1] | literal[1:] | ~self.symbols.together(chars[:-1], chars[1:]))
        starts[np.cumsum(sizes) - sizes] = True
        at = np.flatnonzero(starts)
        lengths = np.diff(np.append(at, len(chars)))
        n = np.bincount(np.searchsorted(np.cumsum(sizes), at, "right"), minlength=len(units))
        known = len(self.code_n)
        self.unit_at, self.unit_n = np.append(self.unit_at, known + np.cumsum(n) - n), np.append(self.unit_n, n)
        self.used = np.append(self.used, np.zeros(len(n), np.int64))
        for i in np.flatnonzero(lengths > _LONG).tolist():  # cut when they come up
            self.long[known + i] = text[at[i]:at[i] + lengths[i]].replace(" ", _SPACE)

        self.symbols.learn(np.unique(chars))
        symbols = self.symbols.of_char[chars]
        ranks = np.append(self.symbols.rank(symbols[:-1], symbols[1:]), _NO_RANK)
        ranks[at[1:] - 1] = _NO_RANK
        char_at, lengths = len(self.char_symbols) + at, np.where((lengths > _LONG) | literal[at], 0, lengths)
        self.char_symbols, self.char_ranks = np.append(self.char_symbols, symbols), np.append(self.char_ranks, ranks)
        self.char_at, self.char_n = np.append(self.char_at, char_at), np.append(self.char_n, lengths)
        ids, id_n, owners, codes = self._cut(char_at, lengths)
        id_at = len(self.ids) + np.cumsum(id_n) - id_n
        own = np.array([self.vocabulary.byte_ids[b] for b in _SPACE.encode()], np.uint32)
        id_at[literal[at]], id_n[literal[at]] = len(self.ids) + len(ids), len(own)
        self.id_at, self.id_n, self.ids = np.append(self.id_at, id_at), np.append(self.id_n, id_n), np.concatenate([self.ids, ids, own])
        code_n = np.bincount(owners, minlength=len(lengths))
        self.code_at = np.append(self.code_at, len(self.codes) + np.cumsum(code_n) - code_n)
        self.code_n, self.codes = np.append(self.code_n, code_n), np.append(self.codes, codes[np.argsort(owners, kind="stable")])

    def _cut(self, char_at: np.ndarray, lengths: np.ndarray, keys: np.ndarray | None = None):
        """Ids of word parts after their agendas, with the number of ids of each, and the candidates."""
        owners, codes, rows, ids = [], [], [], []
        id_n = np.zeros(len(lengths), np.int64)
        least = 0
        for width in _WIDTHS:
            of = np.flatnonzero((lengths > least) & (lengths <= width))
            least = width
            if not len(of):
                continue
            column = np.arange(width)
            inside = column < lengths[of, None]
            place = np.where(inside, char_at[of, None] + column, 0)
            symbols = np.where(inside, self.char_symbols[place], np.int32(-1))
            ranks = np.where(column < lengths[of, None] - 1, self.char_ranks[place], _NO_RANK)
            symbols, owner, code = run_agendas(symbols, ranks, self.symbols, None if keys is None else keys[of], self.limit)
            owners.append(of[owner])
            codes.append(code)
            row, at = np.nonzero(symbols >= 0)
            found = symbols[row, at]
            n = self.symbols.n[found]
            ids.append(_ragged(self.symbols.at[found], n, self.symbols.ids))
            rows.append(np.repeat(of[row], n))
            id_n += np.bincount(rows[-1], minlength=len(lengths))
        if not ids:
            return np.empty(0, np.uint32), id_n, np.empty(0, np.int64), np.empty(0, np.uint64)
        order = np.argsort(np.concatenate(rows), kind="stable")
        return np.concatenate(ids)[order], id_n, np.concatenate(owners), np.concatenate(codes)

    def key(self, start, places: np.ndarray) -> np.ndarray:
        """The keys of the word parts at these places of a document: the 36 bits that the hash uses."""
        return mix64(places.astype(np.uint64) + np.asarray(start, np.uint64)) >> np.uint64(28)

    def _start(self, text: str, document) -> int:
        name = f"{self.seed}/{'' if document is None else document}/{zlib.crc32(text.encode('utf-8', 'replace'))}"
        return int.from_bytes(hashlib.blake2b(name.encode("utf-8", "replace"), digest_size=8).digest(), "little")

    def encode(self, text: str, document) -> bytes:
        return b"".join(ids.tobytes() for ids, _ in self.encoded([text], [document]))

    def encoded(self, texts: Sequence[str | None], documents: Sequence) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of texts, some texts or a part of a long one at a time, and for each id its text's number."""
        starts = np.array([self._start(t, d) if t else 0 for t, d in zip(texts, documents)], np.uint64)
        done = np.zeros(len(texts), np.int64)
        units, counts, owners, size = [], [], [], 0
        for i, text in enumerate(texts):
            for piece in _pieces(f" {text}") if text else ():
                found = _UNITS.findall(piece)
                units += found
                counts.append(len(found))
                owners.append(i)
                size += len(piece)
                if size >= _CHARS:
                    yield self._chunk(units, np.repeat(owners, counts), starts, done)
                    units, counts, owners, size = [], [], [], 0
        if units:
            yield self._chunk(units, np.repeat(owners, counts), starts, done)

    def _chunk(self, units: list[str], texts: np.ndarray, starts: np.ndarray, done: np.ndarray):
        self._make_room()
        numbers = list(map(self.units.get, units))
        if None in numbers:
            self._learn(sorted({u for u, i in zip(units, numbers) if i is None}))
            numbers = list(map(self.units.__getitem__, units))
        numbers = np.array(numbers, np.int64)
        self.used += np.bincount(numbers, minlength=len(self.used))
        n = self.unit_n[numbers]
        parts, of = _runs(self.unit_at[numbers], n), np.repeat(texts, n)
        # A part's place is counted in its text, from where the chunk before left off.
        each = np.bincount(of, minlength=len(done))
        places = np.arange(len(of)) + (done - np.cumsum(each) + each)[of]
        done += each
        id_at, id_n, pool = self.id_at[parts], self.id_n[parts], self.ids
        keys = self.key(starts[of], places)
        if self.limit:
            n = self.code_n[parts]
            hashes = _ragged(self.code_at[parts], n, self.codes)
            hashes ^= np.repeat(keys, n)
            hit = np.searchsorted(np.cumsum(n), np.flatnonzero(_drawn(hashes, self.limit)), "right")
            hit = hit[np.append(True, hit[1:] != hit[:-1])[:len(hit)]]
            ids, counts, _, _ = self._cut(self.char_at[parts[hit]], self.char_n[parts[hit]], keys[hit])
            id_at[hit], id_n[hit] = len(pool) + np.cumsum(counts) - counts, counts
            pool = np.append(pool, ids)
        if self.long:
            for i in np.flatnonzero(np.isin(parts, list(self.long))).tolist():
                cut = segment_long(self.long[int(parts[i])], self.vocabulary.rank, int(keys[i]), self.limit)
                ids = np.frombuffer(self.vocabulary.ids(cut), "<u4")
                id_at[i], id_n[i] = len(pool), len(ids)
                pool = np.append(pool, ids)
        return _ragged(id_at, id_n, pool), np.repeat(of, id_n)


def _pieces(text: str) -> Iterator[str]:
    """A text in parts, cut before a space that follows another character."""
    start = 0
    while len(text) - start > _CHARS:
        cut = _CUT.search(text, start + _CHARS)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


_encoders: dict[tuple, Encoder] = {}


_pieces_at: dict[str, Pieces] = {}


def encoder(*settings) -> Encoder:
    """The worker's encoder; another setting takes its place."""
    if settings not in _encoders:
        _encoders.clear()
        _encoders[settings] = Encoder(*settings)
    return _encoders[settings]


class Pieces:
    """The bytes of all pieces of a vocabulary, one after the other."""

    def __init__(self, path: str):
        pieces = Vocabulary(path).bytes_of
        self.n = np.array(list(map(len, pieces)), np.int64)
        self.at, self.pool = np.cumsum(self.n) - self.n, np.frombuffer(b"".join(pieces), np.uint8)

    def text_of(self, ids: bytes) -> str:
        """The text of ids: the bytes of its pieces, without the space the encoder puts in front."""
        numbers = np.frombuffer(ids, "<u4")
        parts = (numbers[i:i + _CHARS] for i in range(0, len(numbers), _CHARS))
        out = b"".join(_ragged(self.at[p], self.n[p], self.pool).tobytes() for p in parts)
        return (out[1:] if out[:1] == b" " else out).decode("utf-8", "replace")


def _slices(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            yield batch.slice(start, _ROWS)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", *, seed: int = 7,
           dropout: float = 0.1) -> DataFrame:
    """``key, text, ids`` per row: ids as little-endian unsigned 32-bit words."""
    def run(batches):
        coder = encoder(path, seed, dropout)
        for batch in _slices(batches):
            found = list(coder.encoded(batch.column(1).to_pylist(), batch.column(0).to_pylist()))
            flat = np.concatenate([ids for ids, _ in found]) if found else np.empty(0, np.uint32)
            of = np.concatenate([texts for _, texts in found]) if found else np.empty(0, np.int64)
            ends = np.append(0, np.cumsum(np.bincount(of, minlength=batch.num_rows))) * 4
            ids = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), batch.num_rows, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(flat)])
            yield pa.RecordBatch.from_arrays([*batch.columns, ids.cast(pa.binary())], names=[key, "text", "ids"])

    plain = docs.select(F.col(key), F.col(text).alias("text"))
    return plain.mapInArrow(run, extended(plain.schema, ids="binary"))


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """The columns of ``encoded`` and ``decoded``, the text of the ids."""
    schema = encoded.schema

    def run(batches):
        if path not in _pieces_at:
            _pieces_at[path] = Pieces(path)
        at = schema.names.index(ids)
        for batch in _slices(batches):
            texts = [None if b is None else _pieces_at[path].text_of(b) for b in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*schema.names, "decoded"])

    return encoded.mapInArrow(run, extended(schema, decoded="string"))
