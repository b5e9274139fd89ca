"""Packing, token counts and merge-dropout against the libraries themselves."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from claimworks.llm import merge_dropout, packing, token_counts
from claimworks.llm.merge_dropout import Encoder, segment, segment_long
from claimworks.llm.tokens import WordIds

from .conftest import edge_rows, prose

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [t for _, t, *_ in edge_rows() if t is not None] + [
    " lead", "trail  ", "a  b   c", "tab\t\tx\n\n y", "don't DON'T we'Re", "²³ ½ ªº ×÷ ÀÉ ÿß", "a_b__c", "\u2028x\u3000y\x1cz",
    "<|endoftext|><|startoftext|> <|end", "x<|endoftext|>y <|", "Ωmega ΣΑΣ ΤΕΛΟΣ", "ǅ Ĳ ŉ", "\u0301combining e\u0301"]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_of_words_are_those_of_the_library(text):
    want = Tokenizer.from_file(WORD).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(WordIds(WORD).encode(text), "<u4").tolist() == want


def pieces_by_brute_force(rows):
    library = Tokenizer.from_file(WORD)
    return [(d, np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")) for d, t, *_ in rows]


@pytest.mark.parametrize("settings", [{}, {"capacity": 64, "windows": 2, "fan": 2}, {"capacity": 16, "windows": 1, "cut_from": 1}])
def test_packing_places_each_id_once(edge, settings):
    rows = packing.pack(edge, WORD, **settings).collect()
    capacity = settings.get("capacity", 2048)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    want = pieces_by_brute_force(edge_rows())
    assert sum(r.length for r in rows) == sum(len(i) for _, i in want)
    docs = {d: ids for d, ids in want if d not in (None, 50)}
    covered = defaultdict(int)
    for r in rows:
        if r.doc_id in docs:
            ids = docs[r.doc_id]
            assert r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
            covered[r.doc_id] += r.length
    assert covered == {d: len(i) for d, i in docs.items()}
    waste = 1 - sum(len(i) for _, i in want) / capacity / len(sequences)
    assert len(sequences) == 1 or waste < 0.5 * capacity / 64


def test_packing_keeps_ids_when_asked_and_is_empty_for_no_rows(edge, empty):
    for r in packing.pack(edge, WORD, keep_ids=True, capacity=32).collect():
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
    assert packing.pack(empty, WORD).count() == 0


def test_packer_is_best_fit_and_emits_the_fullest():
    packer = packing.Packer(10, 2, 100, 0, 0, True)
    for n in (6, 3, 4, 5):
        packer.add(packing._Piece(n, 0, b"\0\0\0\0" * n, n))
    # 3 joins 6 (gap 4); 4 opens a window; 5 joins 4
    assert [(w[0], [p.doc for p in w[1]]) for w in packer.open] == [(9, [6, 3]), (9, [4, 5])]
    packer.add(packing._Piece(2, 0, b"\0\0\0\0" * 2, 2))
    assert [r[0] for r in packer.rows] == [6, 3]


@pytest.mark.parametrize("head", [token_counts.HEAD, 0, 8])
def test_token_counts(edge, head):
    library = Tokenizer.from_file(BYTE)
    rows = token_counts.token_counts(edge, BYTE, head=head).collect()
    want = Counter((d, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
                   for d, t, *_ in edge_rows())
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in rows) == want


def test_token_counts_of_many_texts(llm, empty):
    library = Tokenizer.from_file(BYTE)
    df = llm.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(df, BYTE).collect()}
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in enumerate(TEXTS)}
    assert token_counts.token_counts(empty, BYTE).count() == 0


@pytest.mark.parametrize("text", [t for t in TEXTS if "\u2581" not in t])
def test_no_dropout_is_the_library(text):
    want = sentencepiece.SentencePieceProcessor(model_file=PIECE).encode(text)
    assert np.frombuffer(Encoder(PIECE, 1, 0.0, 1, 64).encode(text, 1), "<u4").tolist() == want


def test_dropout_varies_and_loses_nothing(edge, empty):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    seen = {}
    for dropout in (0.1, 0.5, 1.0):
        for seed in (1, 2):
            coded = merge_dropout.encode(edge, PIECE, seed=seed, dropout=dropout)
            rows = merge_dropout.decode(coded, PIECE).collect()
            assert len(rows) == len(edge_rows())
            for r in rows:
                assert r.decoded == (r.text or "")
            long_ids = max((bytes(r.ids) for r in rows), key=len)
            seen[dropout, seed] = long_ids
            assert library.decode(np.frombuffer(long_ids, "<u4").tolist()) == prose(5, 30_000)
    assert len(set(seen.values())) == 5  # at 1 every merge is skipped, whatever the seed
    assert len(seen[0.1, 1]) < len(seen[0.5, 1]) < len(seen[1.0, 1])
    again = merge_dropout.encode(edge, PIECE, seed=1).collect()
    assert seen[0.1, 1] in [bytes(r.ids) for r in again]
    assert merge_dropout.encode(empty, PIECE).count() == 0


def test_both_agendas_agree():
    rank = Encoder(PIECE, 1, 0.1, 2, 64).vocabulary.rank
    for i in range(200):
        word = "▁" + prose(i, 8).replace(" ", "")[:60]
        for key in (1, 99):
            assert segment(word, rank, key, 2 ** 13) == segment_long(word, rank, key, 2 ** 13)


def test_each_occurrence_is_cut_by_its_own_key():
    coder = Encoder(PIECE, 1, 0.3)
    rank, ids_of = coder.vocabulary.rank, coder.vocabulary.ids
    cuts = Counter()
    for doc in range(40):
        ids = np.frombuffer(coder.encode("international " * 50, doc), "<u4").tolist()
        words, now = [], []
        for i in ids:
            if coder.vocabulary.bytes_of[i].startswith(b" ") and now:
                words.append(tuple(now))
                now = []
            now.append(i)
        cuts.update([*words, tuple(now)])
    assert len(cuts) > 20
    near = Counter(coder.encode("international " * 50, doc) for doc in range(40))
    assert len(near) == 40

    long_word = "x" + prose(3, 60).replace(" ", "").replace(".", "")
    for limit, dropout in ((2 ** 13, 0.125), (2 ** 15, 0.5)):
        for kept in ({}, {"kept_nodes": 2, "kept_units": 2}):
            coder = Encoder(PIECE, 1, dropout, **kept)
            for words in (prose(8, 300), f"{long_word} and {long_word}"):
                keys, seen = [], coder.key
                coder.key = lambda start, places: keys.append(seen(start, places)) or keys[-1]
                got = coder.encode(words, 5)
                coder.key = seen
                parts = [p for u in merge_dropout._UNITS.findall(" " + words)
                         for p in coder.vocabulary.parts(u.replace(" ", "\u2581"))]
                assert len(keys[0]) == len(parts)
                assert got == b"".join(ids_of(segment(p, rank, int(k), limit)) for p, k in zip(parts, keys[0]))


def test_long_pre_tokens_go_by_name(llm):
    dashes, other = "-" * 3000, "=" * 700
    rows = [(i, f"{dashes} {'word ' * (i % 5)}{other * (i % 2)}") for i in range(60)] + [(99, "\u4e2d" * 400)]
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(3)
    library = Tokenizer.from_file(BYTE)
    want = {d: len(library.encode(t, add_special_tokens=False).ids) for d, t in rows}
    for head in (token_counts.HEAD, 0):
        assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, BYTE, head=head).collect()} == want
    held = token_counts.most_seen(token_counts.piece_table(docs, BYTE), 1000)
    assert token_counts.name_of(" " + dashes) not in (" " + dashes,) and all(len(k.encode()) <= 256 for k in held)
    assert token_counts.name_of(dashes) in held
