"""Language of texts by a small byte convolutional network, trained and applied in numpy.

Windows of ``WINDOW`` bytes are read by filters of several widths; each filter keeps its highest value in the window, and a
softmax over the kept values gives the language. A filter is a table per byte it covers, so applying it is a look-up and a
sum; for whole texts, tables of neighbouring bytes are added together beforehand. A text's score is the mean over its
windows, each weighted by the bytes it holds.

Training takes a bounded sample: at most ``TRAIN_WINDOWS`` windows, from documents chosen by a hash with equal chances for
each language, a window from a place in the text that the hash gives. Applying is a map over whole texts.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as is everything if there was nothing to learn
from. Rows are judged one by one. Columns of the input with the name of a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from facetide.llm.common import apart, stored
from facetide.llm.words import buffers, pieces
from facetide.session import ship

WINDOW = 256
WIDTHS = (2, 3, 4, 5)
FILTERS = 12
TRAIN_WINDOWS = 6_000
EPOCHS, BATCH, RATE = 6, 64, 0.01
UNKNOWN = "und"
PAD = max(WIDTHS) - 1
WINDOWS_AT_ONCE = 128
RESULTS = ("lang_pred", "score")


class Network:
    def __init__(self, names: list[str]):
        rng = np.random.default_rng(7)
        self.names = names
        self.tables = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS + 1, len(names))).astype(np.float32)

    def train(self, windows: np.ndarray, labels: np.ndarray) -> None:
        rng = np.random.default_rng(11)
        held = [*self.tables, self.out]
        first, second = [np.zeros_like(h) for h in held], [np.zeros_like(h) for h in held]
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(windows))
            for at in range(0, len(order), BATCH):
                rows = order[at:at + BATCH]
                step += 1
                for i, g in enumerate(self._gradients(windows[rows], labels[rows])):
                    first[i] += 0.1 * (g - first[i])
                    second[i] += 0.01 * (g * g - second[i])
                    held[i] -= RATE * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.99 ** step)) + 1e-6)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        n = len(x)
        kept, places = [], []
        for w, table in zip(WIDTHS, self.tables):
            values = sum(table[k][x[:, k:k + WINDOW]] for k in range(w))
            place = values.argmax(axis=1)
            places.append(place)
            kept.append(np.take_along_axis(values, place[:, None, :], axis=1)[:, 0])
        pooled = np.maximum(np.hstack(kept), 0)
        full = np.hstack([pooled, np.ones((n, 1), np.float32)])
        p = _softmax(full @ self.out)
        p[np.arange(n), y] -= 1
        p /= n
        back = (p @ self.out[:-1].T) * (pooled > 0)
        grads = []
        for i, (w, place) in enumerate(zip(WIDTHS, places)):
            g = np.zeros_like(self.tables[i])
            own = back[:, i * FILTERS:(i + 1) * FILTERS]
            for k in range(w):
                # Only the highest place of each filter has a gradient.
                np.add.at(g[k], (x[np.arange(n)[:, None], place + k], np.arange(FILTERS)[None, :]), own)
            grads.append(g)
        return [*grads, full.T @ p]

    def compiled(self) -> Compiled:
        return Compiled(self)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Compiled:
    """The network with the tables of two neighbouring bytes added up, and all widths side by side."""

    def __init__(self, net: Network):
        self.names, self.out = net.names, net.out
        self.pairs = []
        for k in range(0, max(WIDTHS), 2):
            wide = [t for w, t in zip(WIDTHS, net.tables) if w > k]
            pair = np.concatenate([
                t[k][:, None, :] + (t[k + 1][None, :, :] if len(t) > k + 1 else np.zeros((1, 256, FILTERS), np.float32))
                for t in wide], axis=2)
            self.pairs.append((k, pair.reshape(65536, -1)))

    def windows(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of windows with their padding."""
        pair = x[:, :-1].astype(np.int32) << 8 | x[:, 1:]
        values = self.pairs[0][1][pair[:, :WINDOW]]
        for k, table in self.pairs[1:]:
            # Later bytes belong to the wider filters, which stand last.
            values[:, :, -table.shape[1]:] += table[pair[:, k:k + WINDOW]]
        pooled = np.maximum(values.max(axis=1), 0)
        return _softmax(np.hstack([pooled, np.ones((len(x), 1), np.float32)]) @ self.out)

    def texts(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Mean probabilities of each text, over all its windows."""
        sizes = np.diff(starts)
        many = -(-sizes // WINDOW)
        text = np.repeat(np.arange(len(sizes)), many)
        begin = starts[text] + (np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)) * WINDOW
        length = np.minimum(starts[text + 1] - begin, WINDOW)
        padded = np.append(data, np.zeros(WINDOW + PAD + 1, np.uint8))
        out = np.zeros((len(sizes), len(self.names)))
        span = np.arange(WINDOW + PAD + 1)
        for at in range(0, len(text), WINDOWS_AT_ONCE):
            b, n, t = (v[at:at + WINDOWS_AT_ONCE] for v in (begin, length, text))
            x = padded[b[:, None] + span]
            x[span[None, :] >= n[:, None]] = 0
            np.add.at(out, t, self.windows(x) * n[:, None])
        return out / np.maximum(sizes, 1)[:, None]


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = TRAIN_WINDOWS) -> Compiled | None:
    """Learn from ``docs`` (the rows to learn from only); None if there are none."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(text).rlike(r"\p{L}"))
    counts = known.groupBy(F.col(lang).alias("_lang")).agg(F.count(F.lit(1)).alias("_n"))
    # Twice the share of a language, so that each most likely has its share; then the first by hash.
    share = stored(counts.orderBy(F.desc("_n"), "_lang").limit(rows), "languages")
    share = share.withColumn("_share", 2.0 * rows / (F.lit(max(1, share.count())) * F.col("_n")))
    chance = F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(1)), 11) / F.lit(float(1 << 53))
    place = 1 + F.pmod(F.xxhash64(F.col(key), F.lit(2)), F.greatest(F.lit(1), F.length(text) - WINDOW)).cast("int")
    sample = (
        known.select(F.col(lang).alias("_lang"), F.substr(F.col(text), place, F.lit(WINDOW)).alias("_window"), chance.alias("_u"))
        .join(F.broadcast(share), "_lang").where("_u < _share")
        .orderBy(F.col("_u") * F.col("_n"), "_u", "_window").limit(rows).select("_lang", "_window").collect())
    names = sorted({r["_lang"] for r in sample})
    if not names:
        return None
    x = np.zeros((len(sample), WINDOW + PAD), np.uint8)
    for i, r in enumerate(sample):
        held = np.frombuffer(r["_window"].encode()[:WINDOW], np.uint8)
        x[i, :len(held)] = held
    net = Network(names)
    net.train(x, np.array([names.index(r["_lang"]) for r in sample]))
    return net.compiled()


def predict(docs: DataFrame, net: Compiled | None, text: str = "text") -> DataFrame:
    """Replace ``text`` by ``lang_pred`` and ``score``; other columns stay."""
    ship(docs.sparkSession)
    return apart(docs, RESULTS, (text,), lambda *held: _predicted(*held, net))


def _predicted(docs: DataFrame, text: str, net: Compiled | None) -> DataFrame:
    rows = docs.withColumn("_letters", F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    schema = StructType([f for f in rows.schema if f.name not in (text, "_letters")] + [
        StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out, held = to_arrow_schema(schema), sent.value
        for batch in batches:
            for piece in pieces(batch, text, 1 << 20):
                known = piece.column("_letters").to_numpy(zero_copy_only=False) & (held is not None)
                names, score = np.full(piece.num_rows, UNKNOWN, object), np.zeros(piece.num_rows)
                if known.any():
                    p = held.texts(*buffers(piece.column(text).filter(pa.array(known))))
                    names[known], score[known] = np.array(held.names, object)[p.argmax(axis=1)], p.max(axis=1)
                made = {"lang_pred": pa.array(names, pa.string()), "score": pa.array(np.clip(score, 0, 1))}
                yield pa.RecordBatch.from_arrays(
                    [made[f.name] if f.name in made else piece.column(f.name).cast(f.type) for f in out], schema=out)

    return rows.mapInArrow(judge, schema)
