import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from facetide.llm import tokens
from facetide.llm.words import buffers

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "b", "the", " ", "  ", "\n", "\t", "'s", "'re", "'", "'ll", " '", "1", "23", "é", "ß", "日本", "😀", "!", "##",
         "<|endoftext|>", "<|endoftext", "\r\n", "I'm", "'S", "x" * 300, "er", "ing", "́", "Ⅷ", "\x85", "\x1c", "\x00", "　"]


@pytest.fixture(scope="module")
def counter():
    return tokens.Counter(open(PATH, encoding="utf-8").read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def want(library, texts):
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_equals_the_library_on_random_texts(counter, library):
    rng = random.Random(3)
    for _ in range(10):
        texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60))) for _ in range(200)] + [None, ""]
        assert counter.count(*buffers(pa.array(texts, pa.string()))).tolist() == want(library, texts)


def test_equals_the_library_across_windows_and_with_few_states(counter, library, monkeypatch):
    monkeypatch.setattr(tokens, "WINDOW_BYTES", 700)
    monkeypatch.setattr(tokens, "MAX_STATES", 300)
    rng = random.Random(4)
    texts = ["".join(rng.choice(PARTS) for _ in range(3000)) for _ in range(3)] + ["y" * 5000, " " * 3000, "'" * 900]
    assert counter.count(*buffers(pa.array(texts))).tolist() == want(library, texts)


def test_chunk_maps_compose_to_a_walk(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(5)
    kinds = rng.choice([tokens.LETTER, tokens.NUMBER, tokens.OTHER, tokens.WHITE], 5000).astype(np.uint8)
    points = np.where(kinds == tokens.WHITE, rng.choice([32, 10], 5000), np.where(kinds == tokens.OTHER, 39, 115))
    last = rng.random(5000) < 0.01
    last[-1] = True
    got = {}
    for size in (1, 7, 128, 5000):
        monkeypatch.setattr(tokens, "CHUNK", size)
        got[size] = tokens.splits(kinds, points, last).tolist()
    assert got[1] == got[7] == got[128] == got[5000]


def test_columns_and_odd_rows(spark, odd, none, library):
    out = tokens.count_tokens(odd, PATH)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "score", "Shard", "n_bytes", "n_tokens", "over_limit"]
    texts = [r["text"] for r in odd.collect()]
    got = sorted((r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in out.collect())
    assert got == sorted((len((t or "").encode()), n, n > 512) for t, n in zip(texts, want(library, texts)))
    assert tokens.count_tokens(none, PATH).count() == 0
