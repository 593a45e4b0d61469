import random

import numpy as np
import pyarrow as pa

from facetide.llm import queries, toxicity


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(0)
    names = ["idiot", "stupid", "scum", "trash", "trashy", "mörön"]
    lexicon = toxicity.Lexicon(dict.fromkeys(names, 1.0))
    words = ["".join(rng.choice("idotsupcmrahyö@") for _ in range(rng.randint(1, 8))) for _ in range(300)]
    for n in names:
        for _ in range(60):
            at, c = rng.randrange(len(n) + 1), rng.choice("idöx@")
            words += [n[:at] + c + n[at:], n[:at] + n[at + 1:], n[:at] + c + n[at + 1:], n, n + "ly"]
    words = [w for w in words if w]
    letters = np.array([ord(c) for w in words for c in w])
    end = np.cumsum([len(w) for w in words])
    exact, near = lexicon.find(letters, end - [len(w) for w in words], end)
    for w, e, m in zip(words, exact, near):
        starts = [n for n in names if w.startswith(n)]
        assert (lexicon.names[e] if e >= 0 else None) == (max(starts, key=len) if starts else None), w
        close = [n for n in names if len(n) >= toxicity.FUZZY_LETTERS and edits(w, n) == 1]
        assert starts or (m >= 0) == bool(close), w
        assert m < 0 or lexicon.names[m] in close


def test_quotation_is_told_from_abuse():
    lexicon = toxicity.Lexicon({"idiot": 2.0})
    x = toxicity.features(pa.array(["you idiot", 'he said "you idiot" and left', "an idi0t", "fine", None, ""]), lexicon)
    assert x[0, 0] > 0 and x[0, 1] == 0 and x[1, 0] == 0 and x[1, 1] > 0 and x[2, 2] > 0 and x[2, 0] == 0
    assert not x[3:].any()


def test_marks_of_another_text_do_not_quote():
    lexicon = toxicity.Lexicon({"idiot": 2.0})
    x = toxicity.features(pa.array(['"', "idiot", '"']), lexicon)
    assert x[1, 0] > 0 and x[1, 1] == 0


def test_held_out(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = queries.op10(spark, sf_dir).where("held_out").join(labels, "doc_id").collect()
    toxic = [r for r in rows if r["toxic"]]
    assert sum(r["predicted"] for r in toxic) >= 0.85 * len(toxic)
    assert sum(r["predicted"] for r in rows if not r["toxic"]) <= 0.02 * len(rows)


def test_common_words_do_not_push_a_rare_term_out(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "CANDIDATES", 20)
    common = " ".join(f"common{chr(97 + i)}word" for i in range(20))
    rows = [(i, common + (" wretch" if i < toxicity.SUPPORT else ""), int(i < 20)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    assert model.lexicon.names == ["wretch"]


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (6, 0), (7, 0), (None, 1), (8, None)], "doc_id long, toxic int")
    model = toxicity.fit(odd, labels)
    out = toxicity.score(odd, model)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "Shard", *toxicity.FEATURES, "score", "predicted"]
    rows = out.collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (3, 4, 5)}) == 1
    assert toxicity.score(none, model).count() == 0
    for labelled in (labels.limit(0), labels.where("toxic = 1")):
        assert len({r["score"] for r in toxicity.score(odd, toxicity.fit(odd, labelled)).collect()}) == 1
