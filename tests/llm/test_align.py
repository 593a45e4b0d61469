import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from facetide.llm import align
from facetide.llm.bpe import Vocabulary
from facetide.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "b", "the", " ", " ", "  ", "   ", "\n", "\t", "\n\n", "'s", "'re", "'", " '", "1", "23", "é", "ß", "日本", "😀", "!", "##",
         "<|endoftext|>", "\r\n", "I'm", "x" * 40, "er", "ing", "́", "Ⅷ", "\x85", "\x1c", "\x00", "　", "<s>", "<unk>", "<0x0A>",
         "ﬁ", "​", "\xa0", "tokenizer", "alignment", "unbelievable", ";\r", ").", "{"]


class Plain:
    """The contract, text by text."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.a_bytes = Vocabulary(open(A, encoding="utf-8").read()).bytes

    def tokens(self, text):
        if not text:
            return [], []
        a = [(i, self.a_bytes[i]) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
              else self.b.id_to_piece(i).replace("▁", " ").encode()) for i in self.b.encode(text)]
        raw = (" " + text).encode()
        if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            return [], []
        return a, b

    def rows(self, texts):
        held = []
        for t in texts:
            a, b = self.tokens(t)
            ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in (a, b)]
            cuts = sorted(set(ends[0]) & set(ends[1]))
            groups, at = [], [0, 0]
            for c in cuts:
                upto = [es.index(c, k) + 1 for es, k in zip(ends, at)]
                groups.append("|".join(",".join(str(i) for i, _ in s[k:u]) for s, k, u in zip((a, b), at, upto)))
                at = upto
            spans = [[(i, e - len(x), e) for (i, x), e in zip(s, es)] for s, es in zip((a, b), ends)]
            links, low = [], 0
            for i, p, q in spans[0]:
                while low < len(b) and spans[1][low][2] <= p:
                    low += 1
                at = low
                while at < len(b) and spans[1][at][1] < q:
                    links.append((i, spans[1][at][0]))
                    at += 1
            held.append((len(a), len(b), ";".join(groups), len(groups), links))
        counts = Counter(p for h in held for p in set(h[4]))
        most = {}
        for (i, _), n in counts.items():
            most[i] = max(most.get(i, 0), n)
        return [(na, nb, n, len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links), g)
                for na, nb, g, n, links in held], counts, most


@pytest.fixture(scope="module")
def plain():
    return Plain()


def texts(seed, n=150):
    rng = random.Random(seed)
    out = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    words = ["tokenizer", "alignment", "don't", "naïve", "x,", "(y)"]
    out += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 30))) for _ in range(n)]
    return out + out[:20] + [None, "", " ", "  ", "\n", "a ", " a", "▁ x", "a▁b", "word" * 2000, "日本語" * 500]


def got(rows):
    return [tuple(r[c] for c in align.RESULTS) for r in sorted(rows.collect(), key=lambda r: r["k"])]


@pytest.mark.parametrize("small", [False, True])
def test_equals_the_contract(spark, plain, monkeypatch, small):
    if small:  # many blocks of pairs, a table of few stretches, pairs put out early
        for name, value in (("BLOCK_PAIRS", 200), ("KNOWN", 30), ("HELD_PAIRS", 100)):
            monkeypatch.setattr(align, name, value)
        monkeypatch.setattr("facetide.llm.words.PIECE_BYTES", 500)
        monkeypatch.setattr(align, "pieces", lambda b, t: __import__("facetide.llm.words").llm.words.pieces(b, t, 500))
    held = texts(1 + small)
    docs = spark.createDataFrame(list(enumerate(held)), "k long, text string").repartition(4)
    rows, pairs = align.align(docs, A, B)
    want, counts, most = plain.rows(held)
    for t, x, y in zip(held, got(rows), want):
        assert x == y, t
    assert {(r["a"], r["b"]): (r["n"], r["best"]) for r in pairs.collect()} == {
        p: (n, n == most[p[0]]) for p, n in counts.items()}


def test_stretches_do_not_change_tokens(plain):
    table = align.Stretches(open(A, encoding="utf-8").read(), open(B, "rb").read())
    assert table._b.cuts
    for t in texts(5, 2000):
        number, _ = table.read([t])
        a, b = plain.tokens(t)
        if a:
            assert table.counts[number, :2].sum(axis=0).tolist() == [len(a), len(b)], t
            assert ";".join(table.groups[k] for k in number) == plain.rows([t])[0][0][6]


def test_intervals_coalesce():
    rng = np.random.default_rng(0)
    for _ in range(50):
        ends = [np.unique(np.append(rng.integers(1, 60, rng.integers(1, 25)), 60)) for _ in range(2)]
        starts = [np.append(0, e[:-1]) for e in ends]
        order, group, a, b = align.coalesce(starts[0], ends[0], starts[1], ends[1])
        assert sorted(zip(a.tolist(), b.tolist())) == [
            (i, j) for i in range(len(ends[0])) for j in range(len(ends[1]))
            if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]]
        cuts = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
        start = np.concatenate(starts)[order]
        assert group.tolist() == [sum(c <= s for c in cuts) for s in start.tolist()]


def test_odd_rows(spark, odd, none, plain):
    rows, _ = align.align(odd.withColumns({"n_a": F.lit("mine"), "Groups": F.lit(3), "pair": F.lit(1)}), A, B)
    assert rows.columns == ["doc_id", "lang", "source", "n_chars", "score", "Shard", "pair", *align.RESULTS]
    want = plain.rows([r["text"] for r in odd.collect()])[0]
    assert sorted(tuple(r[c] for c in align.RESULTS) for r in rows.collect()) == sorted(want)
    out, pairs = align.align(none, A, B)
    assert out.count() == 0 and pairs.count() == 0


def test_query_equals_the_contract(spark, plain):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    want, _, _ = plain.rows([d["text"] for d in docs])
    found = {r["doc_id"]: r for r in QUERIES["op12_tokenizer_alignment"](spark, sf_dir).collect()}
    assert len(found) == len(docs)
    for d, w in zip(docs, want):
        r = found[d["doc_id"]]
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"]) == w[:6]
        assert r["groups_sha256"] == (hashlib.sha256(w[6].encode()).hexdigest() if w[6] else "")
