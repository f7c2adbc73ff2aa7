import random
import zlib
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from inkwell.llm import packing
from inkwell.llm.queries import op8, tokenizer_path
from inkwell.llm.token_ids import WordTokens, word_tokens
from tests.llm.helpers import documents, save

WORDS = ["the", "The,", "Straße", "naïve", "éa", "12", "x<|endoftext|>y", "don't", "ΣΑΣ", " ", "日本", "re|", "👍🏽", "İx"]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(tokenizer_path())


def check(rows, texts, plain):
    """The contract, against the tokenizer's own ids."""
    ids = {i: [*plain.encode(t or "", add_special_tokens=False).ids, 2] for i, t in texts.items()}
    seen, sequences = {i: [] for i in texts}, {}
    for r in rows:
        got = ids[r["doc_id"]]
        part = got[r["start"]:r["start"] + r["length"]]
        assert r["doc_tokens"] == len(got) and len(part) == r["length"] > 0
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        seen[r["doc_id"]].append((r["start"], r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, spans in seen.items():
        assert covers(spans) == len(ids[i])
    sizes = [covers(s) for s in sequences.values()]
    assert all(n <= packing.CAPACITY and n & (n - 1) == 0 for n in sizes)
    assert sorted(sequences) == list(range(len(sequences)))


def covers(spans):
    at = 0
    for start, length in sorted(spans):
        assert start == at
        at += length
    return at


def test_query_against_the_plain_tokenizer(spark, tmp_path, plain):
    rnd = random.Random(3)
    texts = {i: " ".join(rnd.choices(WORDS, k=rnd.choice([1, 5, 300, 3000]))) for i in range(40)}
    texts |= {100: None, 101: "", 102: " \n", 103: "a" * 9000, 104: texts[3], 105: "the " * 30_000}
    rows = list(texts.items())
    sf = save(spark, tmp_path, documents=documents(spark, rows, key="k", ids="i", position="p"))
    check(op8(spark, sf).collect(), texts, plain)


def test_repeats_null_ids_and_empty(spark, tmp_path):
    df = documents(spark, [(None, "a b"), (1, "c"), (1, "c"), (None, None)])
    got = op8(spark, save(spark, tmp_path, documents=df)).collect()
    assert sum(r["length"] for r in got) == 3 + 2 + 2 + 1
    assert covers([(r["sequence_id"] * 4096 + r["offset"], r["length"]) for r in got if r["sequence_id"] == 0])
    assert op8(spark, save(spark, tmp_path / "none", documents=df.limit(0))).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6), st.lists(st.sampled_from(WORDS), max_size=20))
def test_word_cache_gives_the_tokenizers_ids(texts, words):
    texts = [*texts, " ".join(words), None]
    cached = word_tokens(tokenizer_path())
    ids, ends = cached.texts(pa.array(texts, pa.string()))
    at = [0, *ends.tolist()]
    for t, a, b in zip(texts, at, at[1:]):
        assert ids[a:b].tolist() == cached.tokenizer.encode(t or "", add_special_tokens=False).ids


def test_cache_generations(monkeypatch):
    from inkwell.llm import token_ids

    monkeypatch.setattr(token_ids, "CACHE_WORDS", 5)
    small = WordTokens(tokenizer_path())
    for text in ["a b c d e f g", "a b h i", "g h i j k l", "a z"]:
        ids, _ = small.texts(pa.array([text]))
        assert ids.tolist() == small.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 2), (3, 3)])
def test_hilbert_keys_walk_every_cell_in_unit_steps(dims, bits):
    cells = np.array(list(product(range(1 << bits), repeat=dims)))
    keys = packing.hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_neighbours_share_sequences(spark, tmp_path):
    rnd = random.Random(1)
    kinds = [[f"{c}{i}" for i in range(30)] for c in ("alpha", "beta", "gamma", "delta")]
    rows = [(i, " ".join(rnd.choices(kinds[i % 4], k=200))) for i in range(200)]
    got = op8(spark, save(spark, tmp_path, documents=documents(spark, rows))).collect()
    mixed = {}
    for r in got:
        mixed.setdefault(r["sequence_id"], set()).add(r["doc_id"] % 4)
    assert sum(len(k) for k in mixed.values()) / len(mixed) < 2


def test_the_rest_is_cut_at_powers_of_two():
    full, starts = packing.sequence_starts(3 * 4096 + 2048 + 256 + 1, 4096)
    assert (full, starts) == (3, [3 * 4096, 3 * 4096 + 2048, 3 * 4096 + 2304])
    assert packing.sequence_starts(0, 4096) == (0, [])
