import re

import numpy as np
import pyarrow as pa

from facetide.llm.words import NOT_ALNUM, SPACE, Words, joined, pieces

TEXTS = ["a b  c", "", None, " x ", "é–b\x85c\x1cD", "one\ttwo\x0bthree", "A-Z a_z 09 ß", "q" * 70_000 + " " + "r" * 70_000, "end"]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_words_are_those_of_the_patterns():
    for ends, pattern in ((SPACE, r"[^\x20\x09-\x0D]+"), (NOT_ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        words = Words(pa.array(TEXTS, pa.string()), ends)
        want = [re.findall(pattern, lower(t)) for t in TEXTS]
        assert words.counts().tolist() == [len(w) for w in want]
        got = [bytes(words.bytes[s:e]).decode() for s, e in zip(words.start, words.end)]
        flat = [w for t in want for w in t]
        assert got == flat
        by_hash = {}
        for w, h in zip(flat, words.hash.tolist()):
            assert by_hash.setdefault(w, h) == h
        assert len(set(by_hash.values())) == len(by_hash)


def test_a_word_hashes_alike_wherever_it_stands():
    texts = [" ".join(f"w{(i * k) % 50}" for i in range(20_000)) for k in (1, 7, 13)]
    words = Words(pa.array(texts), SPACE)
    seen = {}
    for s, e, h in zip(words.start, words.end, words.hash.tolist()):
        assert seen.setdefault(bytes(words.bytes[s:e]), h) == h
    assert len(set(seen.values())) == 50


def test_joined_runs():
    h = np.arange(6, dtype=np.uint64)
    assert len(joined(h, 5)) == 2 and len(joined(h[:4], 5)) == 0
    assert joined(h, 2)[0] != joined(h[::-1].copy(), 2)[-1]


def test_pieces_hold_all_rows_and_bound_bytes():
    batch = pa.RecordBatch.from_pydict({"t": ["a" * 10, None, "b" * 50, "c", "", "d" * 9]})
    parts = list(pieces(batch, "t", 20))
    assert sum((p.column("t").to_pylist() for p in parts), []) == batch.column("t").to_pylist()
    assert all(p.num_rows == 1 or sum(len(x or "") for x in p.column("t").to_pylist()) <= 20 for p in parts)
