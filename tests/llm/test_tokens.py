"""Token counts, byte-level BPE and packing against the public libraries."""

import base64
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from riskloom.llm import bpe, byte_bpe, packing, token_counts

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def ranked():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(4)
    texts = ["", " ", "\n \t", "a\t\n b", "x\x1c y\x1f\x85z", "<|endoftext|>a<|endoftext|><|endoftext|> b", "aaaa" * 99,
             "it's we'll THEY'RE", "日本語　テキスト x", "1234567890 12", "\r\n\r\n a\r\n", "é" * 50]
    texts += ["".join(rng.choice("abcdefgh") for _ in range(5000))]
    return texts + ["".join(rng.choice(" \t\n\x0b\x1c\x85\xa0ab'sé1!<|>　") for _ in range(rng.randrange(60))) for _ in range(800)]


def test_counts_of_odd_texts(library, odd_texts):
    units = token_counts.units_of("test", bpe.from_json(JSON), P.PATTERN)
    assert units.values(odd_texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in odd_texts]


def test_ids_of_odd_texts(ranked, odd_texts):
    vocabulary = bpe.from_ranks(RANKS)
    ids = byte_bpe.units_of("test", vocabulary, P.PATTERN).values(odd_texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [ranked.encode_ordinary(t) for t in odd_texts]
    assert [byte_bpe.decode(vocabulary, x).decode() for x in ids] == odd_texts


def test_heap_and_matrix_agree():
    vocabulary = bpe.from_ranks(RANKS)
    rng = random.Random(8)
    pieces = [bytes(rng.choice(b"abcdet hs") for _ in range(rng.randrange(1, 300))) for _ in range(200)] + [b"a" * 257]
    assert byte_bpe.encode_pieces(vocabulary, pieces) == [byte_bpe.merge_by_heap(vocabulary, p) for p in pieces]


def test_units_start_again_when_full(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    vocabulary = bpe.from_json(JSON)
    units = bpe.Units(P.PATTERN, lambda p: token_counts.count_pieces(vocabulary, p), sum, {"<|endoftext|>": 1})
    for text in ["one two three four five six", "seven one two", "<|endoftext|> two"]:
        assert units.values([text]) == [len(library.encode(text).ids)]


def test_token_counts_of_a_table(messy, messy_rows, library):
    got = token_counts.token_counts(messy, JSON, P.PATTERN, limit=20).collect()
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "").ids), n > 20) for i, t in messy_rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_encode_and_decode_of_a_table(messy, messy_rows, ranked):
    got = byte_bpe.encode_and_decode(messy, RANKS, P.PATTERN).collect()
    want = []
    for i, t in messy_rows:
        ids = ranked.encode_ordinary(t or "")
        want.append((i, len(ids), np.array(ids, "<u4").tobytes(), (t or "").encode()))
    assert sorted(((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("waiting", [8, 4096])
def test_packing_holds_every_id_once(messy, messy_rows, library, monkeypatch, waiting):
    monkeypatch.setattr(packing, "WAITING", waiting)
    pieces = packing.pack(messy, JSON, P.PATTERN, end_id=1, tiers=(32, 64, 128), with_ids=True).collect()
    want = defaultdict(list)
    for i, t in messy_rows:
        want[i].append([*library.encode(t or "", add_special_tokens=False).ids, 1])
    got, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length * 4 == len(p.ids) and p.ids_crc32 == zlib.crc32(p.ids)
        got[p.doc_id].extend(np.frombuffer(p.ids, "<u4").tolist())
        sequences[p.sequence_id].append(p)
    assert {i: sorted(x) for i, x in got.items()} == {i: sorted(sum(x, [])) for i, x in want.items()}
    for i in (k for k in want if len(want[k]) == 1):
        own = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start)
        assert sum((np.frombuffer(p.ids, "<u4").tolist() for p in own), []) == want[i][0]
        assert [p.start for p in own] == [sum(q.length for q in own[:k]) for k in range(len(own))]
        assert {p.doc_tokens for p in own} == {len(want[i][0])}
    for own in sequences.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [sum(q.length for q in own[:k]) for k in range(len(own))]
        size = sum(p.length for p in own)
        assert size <= 128 and size & (size - 1) == 0 and {p.sequence_tokens for p in own} == {size}
        assert len({p.step_group for p in own}) == 1


def test_steps_are_even(messy):
    pieces = packing.pack(messy.coalesce(1), JSON, P.PATTERN, end_id=1, tiers=(8, 16)).collect()
    tokens = defaultdict(int)
    for p in pieces:
        tokens[p.step_group] += p.length
    full = sorted(tokens.values())[packing.OPEN_STEPS :]
    assert full and all(t >= 16 * packing.STEP_WINDOWS and t < 16 * (packing.STEP_WINDOWS + 1) for t in full)


def test_empty_tables(nothing):
    assert token_counts.token_counts(nothing, JSON, P.PATTERN).count() == 0
    assert byte_bpe.encode_and_decode(nothing, RANKS, P.PATTERN).count() == 0
    assert packing.pack(nothing, JSON, P.PATTERN, end_id=1).count() == 0
