import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from facetide.llm import bpe
from facetide.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "b", "the", " ", "  ", "\n", "\t", "'s", "'re", "'", "'ll", " '", "1", "23", "é", "ß", "日本", "😀", "!", "##",
         "<|endoftext|>", "<|endoftext", "\r\n", "I'm", "'S", "x" * 300, "er", "ing", "́", "Ⅷ", "\x85", "\x1c", "\x00", "　",
         "՘", "ࢉ", "ఽ", "₝", "ȡ", "ɏ", "²", "¾"]
RUNS = [" " * 3000, "a" * 5000, "abcde fghij" * 500, "'" * 900, "regress" * 900, "  \n " * 700 + "x", "日本語" * 800,
        "inatedreverted" * 400, "12345" * 700 + "th", "\n" * 500, "don" + " " * 90 + "'re" * 40]


@pytest.fixture(scope="module")
def spec():
    return open(PATH, encoding="utf-8").read()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def want(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def lists(ids, starts):
    return [ids[a:b].tolist() for a, b in zip(starts, starts[1:])]


@pytest.mark.parametrize("sizes", [(1 << 16, 1 << 10, 1 << 12), (7, 3, 5), (40, 9, 64), (500, 100, 100)])
def test_equals_the_library_however_the_text_is_cut(spec, library, monkeypatch, sizes):
    for name, value in zip(("WINDOW", "LONG", "STEP"), sizes):
        monkeypatch.setattr(bpe, name, value)
    encoder, decoder, rng = bpe.Encoder(spec), bpe.Decoder(spec), random.Random(3)
    for _ in range(3):
        texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60))) for _ in range(200)] + [None, "", *RUNS]
        ids, starts = encoder.encode(texts)
        assert lists(ids, starts) == want(library, texts)
        assert decoder.decode(ids, starts) == [t or "" for t in texts]


def test_a_small_table_of_pieces_changes_nothing(spec, library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN", 10)
    encoder, rng = bpe.Encoder(spec), random.Random(4)
    for _ in range(5):
        texts = ["".join(rng.choice(PARTS) for _ in range(40)) for _ in range(30)]
        assert lists(*encoder.encode(texts)) == want(library, texts)


def test_special_strings_as_plain_text(spec, library):
    library = Tokenizer.from_str(spec)
    library.encode_special_tokens = True
    texts = ["<|endoftext|>", "a<|endoftext|> b<|endoftext|>"]
    assert lists(*bpe.Encoder(spec, special=False).encode(texts)) == want(library, texts)


@pytest.mark.parametrize("block", [1 << 16, 3, 50])
def test_any_ids_decode_as_the_library_decodes_them(spec, library, monkeypatch, block):
    monkeypatch.setattr(bpe, "BLOCK_IDS", block)
    rng = random.Random(5)
    held = [[rng.randrange(50_300) for _ in range(rng.randint(0, 300))] for _ in range(200)]
    held += [[rng.randrange(100, 256) for _ in range(200)] for _ in range(100)]  # single bytes, seldom whole characters
    starts = np.append(0, np.cumsum([len(x) for x in held]))
    assert bpe.Decoder(spec).decode(np.array([i for x in held for i in x]), starts) == [
        library.decode(x, skip_special_tokens=False) for x in held]


def test_the_lookahead_suffices(spec):
    """No text after a prefix changes a boundary that lies further back than the lookahead; some change one near it."""
    letters = "abcd"
    rng = random.Random(6)
    for _ in range(30):
        vocabulary = {bpe_letter: i for i, bpe_letter in enumerate(_letters())}
        merges, made = [], list(letters)
        while len(merges) < 25:
            a, b = rng.choice(made), rng.choice(made)
            if a + b not in vocabulary and len(a + b) < 8:
                vocabulary[a + b] = len(vocabulary)
                merges.append(f"{a} {b}")
                made.append(a + b)
        file = json.loads(spec) | {"added_tokens": []}
        file["model"] = file["model"] | {"vocab": vocabulary, "merges": merges}
        m = bpe.Merges(bpe.Vocabulary(json.dumps(file)))

        def ends(text):
            ids, _ = m.encode(np.frombuffer(text.encode(), np.uint8), np.array([len(text)]))
            return np.cumsum(m.size[ids]).tolist()

        for _ in range(40):
            text = "".join(rng.choice(letters) for _ in range(60))
            whole = set(ends(text))
            for n in range(5, 60, 7):
                part = set(ends(text[:n]))
                assert all((p in whole) == (p in part) for p in range(1, n - m.lookahead + 1) if p <= n - m.lookahead)


def _letters():
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return [*map(chr, plain), *(chr(256 + i) for i in range(256 - len(plain)))]


def test_an_open_run_holds_little(spec, monkeypatch):
    monkeypatch.setattr(bpe, "STEP", 64)
    encoder = bpe.Encoder(spec)
    run, most, text = bpe.OpenRun(encoder.merges), 0, "reverseddesolate" * 300
    for at in range(0, len(text), 10):
        run.feed(text[at:at + 10].encode())
        most = max(most, len(run._held))
    assert encoder.merges.lookahead < 1000 and most <= 2 * (64 + encoder.merges.lookahead)
    assert run.finish().tolist() == encoder.merges.encode(
        np.frombuffer(text.encode(), np.uint8), np.array([len(text)]))[0].tolist()


def test_merge_lists_out_of_order_are_refused(spec):
    file = json.loads(spec)
    file["model"]["merges"] = file["model"]["merges"][::-1]
    with pytest.raises(ValueError, match="later"):
        bpe.Encoder(json.dumps(file))


def test_columns_and_odd_rows(spark, odd, none, library):
    rows = odd.withColumn("ids", F.lit("mine")).withColumn("_made", F.lit(1))
    out = bpe.encode(rows, PATH)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "score", "Shard", "_made", "ids"]
    key = lambda r: tuple((x is None, x) for x in r)
    held = odd.collect()
    got = sorted(((r["doc_id"], r["n_chars"], r["ids"]) for r in out.collect()), key=key)
    assert got == sorted(((r["doc_id"], r["n_chars"], i) for r, i in zip(held, want(library, [r["text"] for r in held]))), key=key)
    back = bpe.decode(out.withColumn("text", F.lit("replaced")), PATH)
    assert sorted(((r["doc_id"], r["text"]) for r in back.collect()), key=key) == sorted(
        ((r["doc_id"], r["text"] or "") for r in held), key=key)
    assert bpe.decode(bpe.encode(none, PATH), PATH).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, []), (3, [64, None, 65, 99999, -5])], "k int, ids array<long>")
    assert {r["k"]: r["text"] for r in bpe.decode(nulls, PATH).collect()} == {1: None, 2: "", 3: "ab"}


def test_query_equals_the_library(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op13_bpe_roundtrip"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        (ids,) = want(library, [texts[r["doc_id"]]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
