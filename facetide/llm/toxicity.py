"""Toxicity: a learned lexicon, matched by Levenshtein automata, and scores of the context.

1. Lexicon: word beginnings that toxic documents have and others hardly have, counted over a bounded sample of labelled
   documents. Of beginnings that the same documents have, the longest is taken.
   An entry's misspellings count only if they hardly occur in clean documents.
2. Matching: the lexicon is a trie. The automaton that accepts what is within one edit of an entry is intersected with it
   and made deterministic as words are read, so a word costs a table look-up per letter and most end after a few. A word
   that begins with an entry is an exact find; a whole word one edit away from an entry is a misspelled one.
3. Context: finds in a window with a quotation mark on either side are counted apart from open ones.
4. Score: logistic regression over the finds of a document, weighted by the entries' log odds. Labelled documents hardly
   ever misspell, so each toxic one is learned from a second time with its exact finds taken as misspelled ones.

Scoring is a map over whole texts; only the text is read. Long texts are worked on one at a time.

Defined cases: a null or empty text has no finds and gets the score of a document without any. Without labelled rows of
both kinds all scores are the share of toxic ones (0 without labels). Repeated rows get equal scores; of a key labelled
twice, the higher label counts. Columns of the input with the name of a result are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from facetide.llm.common import without
from facetide.llm.tokens import Transitions, code_points
from facetide.llm.words import buffers, pieces
from facetide.session import ship

#: Labelled documents that are learned from at most, chosen by a hash of the key.
TRAIN_ROWS = 1 << 16
#: Candidates for the lexicon (of those with SUPPORT and SHARE), and its entries, at most; those in most toxic documents first.
CANDIDATES, ENTRIES = 20_000, 1_000
SHORTEST, LONGEST = 4, 16
#: An entry is in so many toxic documents and in so large a share of them among all that have it.
SUPPORT, SHARE = 5, 0.7
#: Misspellings are looked for of entries of so many letters.
FUZZY_LETTERS = 5
#: Clean documents with a misspelling of an entry, at most, for each toxic one with the entry.
NEAR_SHARE = 0.02
CONTEXT = 48
QUOTES = '"“”„«»‹›'
FEATURES = ("open", "quoted", "misspelled", "misspelled_quoted", "strongest", "distinct", "density")
RESULTS = ("score", "predicted", *FEATURES)
_WORD = re.compile(r"[^\W_]+")
#: Word beginnings a task counts before it hands them on.
HELD_STARTS = 1 << 18


def _starts(text: str | None) -> set[str]:
    return {w[:k] for w in set(_WORD.findall((text or "").lower())) for k in range(SHORTEST, min(len(w), LONGEST) + 1)}


class Lexicon:
    """A trie of entries, and the deterministic automaton of what is within one edit of them."""

    DEAD, ROOT = 0, 1

    def __init__(self, entries: dict[str, float]):
        self.names = sorted(entries)
        self.weights = np.array([entries[n] for n in self.names])
        self.reliable = np.ones(len(self.names), bool)
        self._children: list[dict[int, int]] = [{}]
        self._entry: list[int] = [-1]
        for i, name in enumerate(self.names):
            node = 0
            for letter in map(ord, name):
                if letter not in self._children[node]:
                    self._children[node][letter] = len(self._children)
                    self._children.append({})
                    self._entry.append(-1)
                node = self._children[node][letter]
            self._entry[node] = i
        self._states: list[dict[int, int]] = []
        self._number: dict[frozenset, int] = {}
        # Of each state: the entry found exactly, and the entry one edit away if the word ends here.
        self.exact, self.near = np.full(64, -1), np.full(64, -1)
        self.step = Transitions()
        self._add({})
        self._add(self._closed({0: 0}))

    def _closed(self, nodes: dict[int, int]) -> dict[int, int]:
        """With entries' letters left out. The fewest edits count."""
        out = dict(nodes)
        for node, edits in nodes.items():
            if edits == 0:
                for child in self._children[node].values():
                    out.setdefault(child, 1)
        return out

    def _add(self, nodes: dict[int, int]) -> int:
        key = frozenset(nodes.items())
        n = self._number.setdefault(key, len(self._states))
        if n == len(self._states):
            self._states.append(nodes)
            if n >= len(self.exact):
                self.exact = np.concatenate([self.exact, np.full_like(self.exact, -1)])
                self.near = np.concatenate([self.near, np.full_like(self.near, -1)])
            for node, edits in sorted(nodes.items()):
                found = self._entry[node]
                if found >= 0 and edits == 0:
                    self.exact[n] = found
                elif found >= 0 and len(self.names[found]) >= FUZZY_LETTERS:
                    self.near[n] = found
        return n

    def compile(self, state: int, letter: int) -> None:
        to: dict[int, int] = {}
        for node, edits in self._states[state].items():
            child = self._children[node].get(letter)
            if child is not None:
                to[child] = min(to.get(child, 2), edits)
            if edits == 0:
                to.setdefault(node, 1)  # a letter too many
                for other in self._children[node].values():  # another letter
                    to.setdefault(other, 1)
        self.step.add(state << 21 | letter, self._add(self._closed(to)), 0)

    def find(self, letters: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each word the entry it begins with (the longest), and the entry it misspells; -1 if none."""
        exact, near = np.full(len(start), -1), np.full(len(start), -1)
        words, state, k = np.arange(len(start)), np.full(len(start), self.ROOT, np.int64), 0
        while len(words):
            key = state << 21 | letters[start[words] + k]
            slot = self.step.find(key)
            if (slot < 0).any():
                for missing in np.unique(key[slot < 0]).tolist():
                    self.compile(missing >> 21, missing & (1 << 21) - 1)
                slot = self.step.find(key)
            state = self.step.to[slot].astype(np.int64)
            k += 1
            found = self.exact[state]
            exact[words[found >= 0]] = found[found >= 0]
            last = end[words] - start[words] == k
            near[words[last]] = self.near[state[last]]
            go = ~last & (state != self.DEAD)
            words, state = words[go], state[go]
        near[exact >= 0] = -1
        return exact, near


_lower = np.arange(0x110000, dtype=np.int32)
for _p in range(0x3000):
    if len(chr(_p).lower()) == 1:
        _lower[_p] = ord(chr(_p).lower())
#: Letters, digits and the signs that stand in for letters belong to a word.
_IN_WORD = np.zeros(0x110000, bool)
_IN_WORD[0x80:] = True
_IN_WORD[[p for p in range(0x80, 0x3000) if not chr(p).isalnum()]] = False
_IN_WORD[[p for p in range(0x80) if chr(p).isalnum()] + [ord(c) for c in "@$*#%&"]] = True


def _finds(texts: pa.Array, lexicon: Lexicon) -> tuple[np.ndarray, ...]:
    """Of each find the text, the entry, whether it is exact and whether it is quoted; and the words of each text."""
    data, starts = buffers(texts)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    letters = _lower[code_points(data, lead)]
    first = np.searchsorted(lead, starts)
    inside = np.append(_IN_WORD[letters], False)
    before = np.append(False, inside[:-1])
    cut = np.zeros(len(inside), bool)
    cut[first] = True
    begin, end = np.flatnonzero(inside & (~before | cut)), np.flatnonzero(before & (~inside | cut))
    words = np.diff(np.searchsorted(begin, first))
    exact, near = lexicon.find(letters, begin, end)
    hit = np.flatnonzero((exact >= 0) | (near >= 0))
    text = np.searchsorted(first, begin[hit], "right") - 1
    # A mark in the window before and in the one after, within the text.
    marks = np.concatenate([[0], np.cumsum(np.isin(letters, [ord(c) for c in QUOTES]))])
    left, right = np.maximum(begin[hit] - CONTEXT, first[text]), np.minimum(end[hit] + CONTEXT, first[text + 1])
    quoted = (marks[begin[hit]] > marks[left]) & (marks[right] > marks[end[hit]])
    is_exact = exact[hit] >= 0
    return text, np.where(is_exact, exact[hit], near[hit]), is_exact, quoted, words


def features(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """A row of FEATURES per text."""
    text, entry, is_exact, quoted, words = _finds(texts, lexicon)
    out = np.zeros((len(texts), len(FEATURES)))
    held = is_exact | lexicon.reliable[entry] if len(entry) else np.zeros(0, bool)
    text, entry, is_exact, quoted = text[held], entry[held], is_exact[held], quoted[held]
    if not len(text):
        return out
    weight = lexicon.weights[entry]
    np.add.at(out, (text, np.where(is_exact, 0, 2) + quoted), weight)
    np.maximum.at(out[:, 4], text[~quoted], weight[~quoted])
    pairs = np.unique(np.stack([text, entry])[:, ~quoted], axis=1)
    np.add.at(out[:, 5], pairs[0], 1.0)
    np.add.at(out[:, 6], text[~quoted], 1.0)
    out[:, 6] /= np.sqrt(np.maximum(words, 1))
    out[:, :4] = np.log1p(np.maximum(out[:, :4], 0))
    return out


class Model:
    def __init__(self, lexicon: Lexicon, weights: np.ndarray, mean: np.ndarray, scale: np.ndarray):
        self.lexicon, self.weights, self.mean, self.scale = lexicon, weights, mean, scale

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(((rows - self.mean) / self.scale) @ self.weights[1:] + self.weights[0], -30, 30)))


def _regress(rows: np.ndarray, labels: np.ndarray, counts: np.ndarray, penalty: float = 1.0) -> Model:
    """Newton steps of penalised logistic regression; ``counts`` says how often a row occurs."""
    mean = np.average(rows, axis=0, weights=counts)
    scale = np.maximum(np.sqrt(np.average((rows - mean) ** 2, axis=0, weights=counts)), 1e-6)
    x = np.hstack([np.ones((len(rows), 1)), (rows - mean) / scale])
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-6] + [penalty] * rows.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (counts * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (counts * (labels - p)) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return Model(None, w, mean, scale)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        rows: int = TRAIN_ROWS) -> Model:
    """Learn from at most ``rows`` labelled documents; ``labels`` has key and label, of the rows to learn from only."""
    spark = docs.sparkSession
    ship(spark)
    keys = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("_key"))
        .agg(F.max(label).cast("int").alias("_label")).orderBy(F.xxhash64("_key"), "_key").limit(rows))
    known = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(keys), "_key").select("_text", "_label")

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counts() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"start": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})

        seen: Counter = Counter()
        for batch in batches:
            for body in batch.column(0).to_pylist():
                seen.update(_starts(body))
                if len(seen) > HELD_STARTS:
                    yield counts()
                    seen.clear()
        yield counts()

    def counted(label: int, n: str) -> DataFrame:
        return known.where(F.col("_label") == label).mapInArrow(starts, "start string, n long").groupBy("start").agg(F.sum("n").alias(n))

    found = (
        counted(1, "n").where(F.col("n") >= SUPPORT).join(counted(0, "clean"), "start", "left").na.fill(0, "clean")
        .where(F.col("n") >= SHARE * (F.col("n") + F.col("clean"))).orderBy(F.desc("n"), "start").limit(CANDIDATES).collect())
    toxic, clean = {r["start"]: r["n"] for r in found}, {r["start"]: r["clean"] for r in found}
    lexicon = Lexicon(_entries(toxic, clean))
    first = spark.sparkContext.broadcast(lexicon)

    def near_misses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = first.value, Counter()
        for batch in batches:
            for piece in pieces(batch, "_text"):
                at, entry, is_exact, _, _ = _finds(piece.column("_text"), held)
                seen.update(e for _, e in set(zip(at[~is_exact].tolist(), entry[~is_exact].tolist())))
        yield pa.RecordBatch.from_pydict({"entry": pa.array(list(seen), pa.int64()), "n": pa.array(list(seen.values()), pa.int64())})

    for r in known.where("_label = 0").mapInArrow(near_misses, "entry long, n long").groupBy("entry").agg(F.sum("n").alias("n")).collect():
        lexicon.reliable[r["entry"]] = r["n"] <= NEAR_SHARE * toxic[lexicon.names[r["entry"]]]
    send = spark.sparkContext.broadcast(lexicon)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = send.value
        for batch in batches:
            for piece in pieces(batch, "_text"):
                made = features(piece.column("_text"), held)
                yield pa.RecordBatch.from_pydict({
                    "y": piece.column("_label"), **{n: pa.array(made[:, i]) for i, n in enumerate(FEATURES)}})

    schema = "y int, " + ", ".join(f"{n} double" for n in FEATURES)
    # Numbers of a bounded sample, of which most are alike; in order, so that sums are always the same.
    held = sorted(known.mapInArrow(measured, schema).groupBy("y", *FEATURES).count().collect())
    x = np.array([r[1:-1] for r in held], float).reshape(-1, len(FEATURES))
    y, counts = np.array([r["y"] for r in held], float), np.array([r["count"] for r in held], float)
    if not len(y) or y.min() == y.max():
        share = y[0] if len(y) else 0.0
        odds = math.log(max(share, 1e-13) / max(1 - share, 1e-13))
        model = Model(None, np.array([odds] + [0.0] * len(FEATURES)), np.zeros(len(FEATURES)), np.ones(len(FEATURES)))
    else:
        # What is exact in a toxic document, once more as misspelled.
        again = x[y == 1].copy()
        again[:, 2:4] += again[:, :2]
        again[:, :2] = 0
        model = _regress(np.vstack([x, again]), np.concatenate([y, np.ones(len(again))]), np.concatenate([counts, counts[y == 1]]))
    model.lexicon = lexicon
    return model


def _entries(toxic: dict[str, int], clean: dict[str, int]) -> dict[str, float]:
    """Entries and their log odds, of those that qualify the shortest, each made as long as its documents allow."""
    good = {s for s, n in toxic.items() if n >= SHARE * (n + clean.get(s, 0))}
    chosen: dict[str, float] = {}
    for start in sorted(good, key=lambda s: (len(s), s)):
        if any(start[:k] in chosen or start[:k] in good for k in range(SHORTEST, len(start))):
            continue
        longest = max((s for s in good if s.startswith(start) and toxic[s] == toxic[start]), key=lambda s: (len(s), s))
        chosen[longest] = math.log((toxic[longest] + 0.5) / (clean.get(longest, 0) + 0.5))
    return dict(sorted(chosen.items(), key=lambda e: (-toxic[e[0]], e[0]))[:ENTRIES])


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Replace ``text`` by the FEATURES, ``score`` and ``predicted``; other columns stay."""
    ship(docs.sparkSession)
    rows = without(docs, set(RESULTS) - {text})
    made = (*FEATURES, "score")
    schema = StructType([f for f in rows.schema if f.name != text] + [StructField(n, DoubleType()) for n in made])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out, held = to_arrow_schema(schema), sent.value
        for batch in batches:
            for piece in pieces(batch, text):
                x = features(piece.column(text), held.lexicon)
                columns = {n: pa.array(x[:, i]) for i, n in enumerate(FEATURES)} | {"score": pa.array(held.score(x))}
                yield pa.RecordBatch.from_arrays(
                    [columns[f.name] if f.name in columns else piece.column(f.name).cast(f.type) for f in out], schema=out)

    return rows.mapInArrow(judge, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
