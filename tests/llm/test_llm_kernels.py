"""Vectorised kernels against plain Python."""

import random
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from corroba.llm import _text as T
from corroba.llm.packing import Packer, hilbert_keys
from corroba.llm.simhash_dedup import trie_links

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB \t\n\x0b\x85é😀#1", max_size=60)), max_size=8)


def fold(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.sampled_from([8, 1 << 19]), st.integers(1, 5))
def test_words_shingles_and_hashes(texts, size, k):
    at = 0
    for w in T.words(pa.array(texts, pa.string()), size=size):
        data, start, end = w.joined()
        first, last, begin = T.shingles(w, k)
        h = T.xxh64(data, start[first], end[last])
        word_hash = w.hashes()
        fp = T.majority_bits(h, begin)
        for i in range(w.n_docs):
            words = fold(texts[at]).encode().split()
            own = [bytes(w.data[a:b]) for a, b in zip(w.start[w.begin[i] : w.begin[i + 1]], w.end[w.begin[i] : w.begin[i + 1]], strict=True)]
            assert own == words
            want = [xxhash.xxh64_intdigest(b" ".join(words[j : j + k]), 42) for j in range(len(words) - k + 1)] or ([xxhash.xxh64_intdigest(b" ".join(words), 42)] if words else [])
            assert h[begin[i] : begin[i + 1]].tolist() == want
            assert int(fp[i]) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in want) > len(want))
            for x, y in zip(words, word_hash[w.begin[i] : w.begin[i + 1]].tolist(), strict=True):
                assert y == int(next(T.words(pa.array([x.decode()]))).hashes()[0])
            at += 1
    assert at == len(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=120), max_size=20))
def test_xxh64(parts):
    data = np.frombuffer(b"".join(parts) + b" " * 8, np.uint8)
    end = np.cumsum([len(p) for p in parts]).astype(np.int64)
    start = end - np.array([len(p) for p in parts], np.int64)
    assert T.xxh64(data, start, end).tolist() == [xxhash.xxh64_intdigest(p, 42) for p in parts]


def test_bit_counts_of_very_long_segments():
    h = np.random.default_rng(0).integers(0, 2**63, 200_000, dtype=np.uint64)
    begin = np.array([0, 3, 3, 150_000, 200_000])
    want = [[int((h[a:b] >> np.uint64(k) & np.uint64(1)).sum()) for k in range(64)] for a, b in zip(begin[:-1], begin[1:], strict=True)]
    assert T.bit_counts(h, begin).tolist() == want


def test_runs_and_counts():
    texts = [None, "", "aa b aaa", "b", "aaaa", "aa" * 40]
    assert T.longest_runs(pa.array(texts), T.byte_class("a")).tolist() == [0, 0, 3, 0, 4, 80]
    assert T.counts(pa.array(texts), T.byte_class("a")).tolist() == [0, 0, 5, 0, 4, 80]
    assert T.longest_runs(pa.array(["xa", "ay"]), T.byte_class("a")).tolist() == [1, 1]


@pytest.mark.parametrize("seed", range(8))
def test_trie_join_against_all_pairs(seed):
    r = np.random.default_rng(seed)
    fp = []
    for x in r.integers(0, 2**63, 15, dtype=np.uint64):
        for _ in range(r.integers(1, 50)):
            y = x
            for b in r.integers(0, 64, r.integers(0, 8)):
                y ^= np.uint64(1 << int(b))
            fp.append(y)
    fp = np.unique(np.array(fp, np.uint64))
    bucket = r.integers(0, 1 + seed % 3, len(fp))
    order = np.lexsort((fp, bucket))
    bucket, fp = bucket[order], fp[order]
    near = (np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4) & (bucket[:, None] == bucket[None, :])
    label = np.arange(len(fp))
    while True:
        new = np.where(near, label[None, :], len(fp)).min(1)
        if np.array_equal(new, label):
            break
        label = new
    assert np.array_equal(trie_links(bucket, fp), label)


def test_dense_cluster_is_joined_without_all_pairs():
    r = np.random.default_rng(1)
    x = np.uint64(0x123456789ABCDEF)
    fp = np.unique(np.array([x ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b)) ^ np.uint64(1 << int(c)) for a, b, c in r.integers(0, 64, (20_000, 3))]))
    assert not trie_links(np.zeros(len(fp), np.int64), fp).any()


@pytest.mark.parametrize("d", [2, 3, 4])
def test_hilbert_curve_visits_neighbours(d):
    grid = np.stack(np.meshgrid(*[np.arange(4)] * d, indexing="ij"), -1).reshape(-1, d)
    key = hilbert_keys(grid, 2)
    assert sorted(key.tolist()) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(1) == 1).all()


def test_packer_never_overfills():
    r = random.Random(0)
    packer, used = Packer(2048), {}
    total = 0
    for _ in range(5):
        lengths = [r.randint(1, 2047) for _ in range(3000)]
        for n, (s, at) in zip(lengths, packer.place(lengths), strict=True):
            used.setdefault(s, []).append((at, n))
        total += sum(lengths)
    for parts in used.values():
        at = 0
        for a, n in sorted(parts):
            assert a == at
            at += n
        assert at <= 2048
    assert total / (2048 * packer.used) > 0.97


def vocabulary(name):
    return pytest.importorskip("public_tokenizers").path(name)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(list(" '\n\tstrevmldLX9!é٣　.<|endoftext|>")), st.characters(max_codepoint=0x3FFF, exclude_categories=("Cs",))), max_size=40), max_size=6))
def test_pieces_give_the_ids_of_the_library(texts):
    from corroba.llm.packing import encoder

    tool = encoder(vocabulary("byte_bpe_50k.json"))
    ids, bounds = tool.encode(texts)
    for i, t in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == tool.whole.encode(t, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list(" '\nstSIİΣςé9!<|endoftext|>")), st.characters(max_codepoint=0x3FFF, exclude_categories=("Cs", "Cn"))), max_size=60))
def test_pre_tokens_give_the_counts_of_the_library(text):
    from tokenizers import Tokenizer

    from corroba.llm.token_counts import splitter

    path = vocabulary("word_bpe_49k.json")
    tool = splitter(path)
    pieces, special = tool.split(text)
    assert sum(tool.pieces(pieces)) + special == len(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids), unicodedata.normalize("NFC", text)
