from __future__ import annotations

import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fleetpulse.llm import packing, token_lengths, tokens
from tests.llm.helpers import FOLDER, documents, sample

ROWS = [
    (1, None), (2, ""), (3, "a"), (4, "word " * 9000), (None, "no id"), (3, "a"), (5, " \n\t  x  y "),
    (6, "<|endoftext|> is special"), (10, "a <|endoftext|> b"), (11, "<|endoftext|>" * 3000), (12, "in<|endoftext|>word"), (7, "don't  stop here \x1c z"), (8, "é" * 5000), (9, "1 22 333 !!"),
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aB1 .'\n\t  é漢\x1c's"), max_size=30))
def test_ids_equal_the_library(tokenizer_once, text):
    own, library = tokenizer_once
    coded = own.encode(text)
    assert list(struct.unpack(f"<{len(coded) // 4}I", coded)) == ids(library, text)
    assert own.count(text) == len(coded) // 4


@pytest.fixture(scope="module")
def tokenizer_once(tokenizer):
    return tokens.Encoder(), tokenizer


def test_ids_equal_the_library_on_the_table(spark, tokenizer_once):
    own, library = tokenizer_once
    for _, text in sample(spark) + ROWS:
        coded = own.encode(text or "")
        assert list(struct.unpack(f"<{len(coded) // 4}I", coded)) == ids(library, text)


def check_packing(rows, pieces, tokenizer):
    by_id = defaultdict(list)
    sequences = defaultdict(list)
    for r in pieces:
        by_id[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    texts = defaultdict(list)
    for doc_id, text in rows:
        texts[doc_id].append([*ids(tokenizer, text), 1])
    assert set(by_id) == set(texts)
    for doc_id, coded in texts.items():
        expected = sorted(
            (s, zlib.crc32(struct.pack(f"<{len(c[s : s + 2048])}I", *c[s : s + 2048])), len(c))
            for c in coded
            for s in range(0, len(c), 2048)
        )
        assert sorted((r.start, r.ids_crc32, r.doc_tokens) for r in by_id[doc_id]) == expected
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return len(sequences)


def test_packing_is_a_round_trip(spark, tokenizer):
    pieces = packing.pack(documents(spark, ROWS, clashing=True)).collect()
    check_packing(ROWS, pieces, tokenizer)
    assert packing.pack(documents(spark, [])).count() == 0


def test_packing_query(spark, tokenizer):
    rows = sample(spark)
    pieces = packing.op4_packing(spark, FOLDER).collect()
    count = check_packing(rows, pieces, tokenizer)
    least = -(-sum(r.length for r in pieces) // 2048)
    assert count <= 1.05 * least + 1


@pytest.mark.parametrize("seed", range(4))
def test_plans_cover_demand_exactly(seed):
    rng = np.random.default_rng(seed)
    demand = rng.integers(0, 10 ** rng.integers(1, 6), 65) * (rng.random(65) < 0.4)
    demand[0] = 0
    plan = packing.plan_patterns(demand)
    assert (plan.uses @ plan.patterns == demand).all()
    assert ((plan.patterns * np.arange(65)).sum(axis=1) <= 64).all()
    least = (demand * np.arange(65)).sum() / 64
    assert plan.uses.sum() <= max(1.35 * least, least + 20)


def test_one_class_fills_whole_sequences():
    demand = np.zeros(129, np.int64)
    demand[32] = 400_001
    assert packing.plan_patterns(demand).uses.sum() == 100_001


@pytest.mark.parametrize("rows", [ROWS, []])
def test_length_answers(spark, tokenizer, rows):
    docs = documents(spark, rows, clashing=True)
    histogram = token_lengths.length_histogram(token_lengths.encoded_lengths(docs))
    lengths = np.array(sorted(len(ids(tokenizer, t)) for _, t in rows), int)
    answers = token_lengths.limit_answers(histogram)
    found = answers.collect()
    assert sorted(r.context_limit for r in found) == sorted(set(lengths.tolist()))
    for r in found:
        fits = lengths <= r.context_limit
        assert (r.docs_within, r.docs_longer) == (fits.sum(), (~fits).sum())
        assert (r.tokens_within, r.total_tokens) == (lengths[fits].sum(), lengths.sum())
        assert r.truncated_tokens == np.minimum(lengths, r.context_limit).sum()
    for limit in (0, 1, 7, 10**6):
        total = token_lengths.truncated_total(histogram, limit).first()[0]
        assert total == np.minimum(lengths, limit).sum()
    if rows:
        middle = token_lengths.length_quantile(answers, 0.5).first()[0]
        assert middle == lengths[-(-len(lengths) // 2) - 1]


def test_length_query(spark, tokenizer):
    lengths = np.array([len(ids(tokenizer, t)) for _, t in sample(spark)])
    found = token_lengths.op5_token_lengths(spark, FOLDER).collect()
    assert {r.context_limit: r.n_docs for r in found} == {
        int(n): int(c) for n, c in zip(*np.unique(lengths, return_counts=True))
    }
    assert all(
        r.truncated_tokens == np.minimum(lengths, r.context_limit).sum() for r in found
    )
