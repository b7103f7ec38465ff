"""Quality classifier: a factorization machine over hashed words, structure
statistics and metadata.

A document is a sparse vector x: its distinct words hashed to ``HASHED``
slots (weights 1 + log count, scaled to unit length), and after them the
standardized statistics of its layout and length. The score is the logistic
of  w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j,  and the pair sum
is taken in linear time as  (|sum v_i x_i|^2 - sum |v_i|^2 x_i^2) / 2.

``fit`` learns on the driver from at most ``max_rows`` labelled rows, taken in
the order of a hash of their id; only their feature vectors are collected.
``score`` is a per-row pass with the model (a fixed few megabytes) broadcast.

Null and empty texts are scored like any other (all-zero statistics). A null
id is scored but never learned from. Rows labelled both ways are not learned
from; repeated rows are learned once. Without both labels the model is empty
and every score is 0.5. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import importable, keep_only, worker_cache

HASHED = 1 << 15
RANK = 6
MAX_ROWS = 8_000
STATISTICS = ["length", "words", "word_length", "letters", "upper", "digits", "symbols", "outer_symbols", "distinct",
              "repeated_run", "lines", "line_length", "repeated_lines", "sentence_ends", "short_words", "bare_symbols"]
_LETTERS = re.compile(r"[^\W\d_]+")
_SYMBOLS = re.compile(r"[^\w\s.,;:'\"()-]+")


class Words(dict):
    """Word -> code; ``slot`` and ``facts`` have by code its hashed slot and
    what it adds to each statistic. Emptied at ``limit`` words, which bounds
    it, but never while a text is read."""

    FACTS = ("letters", "upper", "digits", "symbols", "outer_symbols", "sentence_ends", "short_words", "bare_symbols")

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit
        self.slot, self.facts = np.zeros(1 << 12, np.int32), np.zeros((1 << 12, len(self.FACTS)), np.int32)

    def __missing__(self, w: str) -> int:
        code = self[w] = len(self)
        if code >= len(self.slot):
            self.slot, self.facts = (np.concatenate([x, np.zeros_like(x)]) for x in (self.slot, self.facts))
        self.facts[code] = 0
        self.slot[code] = zlib.crc32(w.lower().encode("utf-8", "surrogatepass")) % HASHED
        if w.isalpha():
            self.facts[code, 0] = len(w)
        else:
            self.facts[code] = (sum(map(len, _LETTERS.findall(w))), 0, any(map(str.isdigit, w)),
                                sum(map(len, _SYMBOLS.findall(w))), not w[-1].isalnum() and w[-1] not in ".,;:?!",
                                w[-1] in ".?!", 0, not w[0].isalnum() and len(w) < 3)
        if len(w) < 4:
            self.facts[code, 6] = 1
        elif w.isupper():
            self.facts[code, 1] = 1
        return code


_words = worker_cache(Words())


def features(text: str) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Slots and weights of the words, and the statistics, of a whole text."""
    if len(_words) >= _words.limit:
        _words.clear()
    words = text.split()
    n, size = len(words), len(text)
    codes = np.fromiter(map(_words.__getitem__, words), np.int32, n)
    distinct, counts = np.unique(codes, return_counts=True)
    slots, weights = _words.slot[distinct], 1 + np.log(counts)
    if n:
        weights /= np.sqrt((weights * weights).sum())
    letters, upper, digits, symbols, odd, ends, short, bare = counts @ _words.facts[distinct]
    repeats = int((codes[1:] == codes[:-1]).sum())
    lines = text.split("\n")
    m, k = max(n, 1), max(size, 1)
    stats = [np.log1p(size), np.log1p(n), size / m, letters / k, upper / m, digits / m, symbols / k, odd / m,
             len(distinct) / m, repeats / m, np.log1p(len(lines)), np.log1p(n / len(lines)),
             1 - len(set(lines)) / len(lines), ends / m, short / m, bare / m]
    return slots, weights, [float(s) for s in stats]


@dataclass
class Model:
    bias: float
    linear: np.ndarray   # HASHED + statistics
    factors: np.ndarray  # the same, RANK
    mean: np.ndarray
    scale: np.ndarray

    def rows(self, data: list[tuple[np.ndarray, np.ndarray, list[float]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sparse rows: all indices, all values, and where each row begins."""
        stats = np.clip((np.array([s for _, _, s in data]).reshape(len(data), len(STATISTICS)) - self.mean) / self.scale, -4, 4)
        own = np.arange(HASHED, HASHED + stats.shape[1])
        index = np.concatenate([np.concatenate([i, own]) for i, _, _ in data])
        value = np.concatenate([np.concatenate([v, s]) for (_, v, _), s in zip(data, stats)])
        starts = np.cumsum([0] + [len(i) + len(own) for i, _, _ in data[:-1]])
        return index, value, starts

    def margin(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Margins; and per entry v*x and per row its sums, for the gradient."""
        vx = self.factors[index] * value[:, None]
        sums = np.add.reduceat(vx, starts, axis=0)
        pairs = (sums * sums).sum(1) - np.add.reduceat((vx * vx).sum(1), starts)
        return self.bias + np.add.reduceat(self.linear[index] * value, starts) + pairs / 2, vx, sums


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(data: list[tuple[np.ndarray, np.ndarray, list[float]]], labels: np.ndarray, epochs: int = 6, batch: int = 256,
          rate: float = 0.05, decay: float = 1e-4, seed: int = 0) -> Model:
    """Adaptive-gradient training of the logistic loss; both labels weigh the same."""
    width = HASHED + len(STATISTICS)
    stats = np.array([s for _, _, s in data]).reshape(len(data), len(STATISTICS))
    rng = np.random.default_rng(seed)
    if not len(data) or labels.min() == labels.max():
        return Model(0.0, np.zeros(width), np.zeros((width, RANK)), np.zeros(len(STATISTICS)), np.ones(len(STATISTICS)))
    model = Model(0.0, np.zeros(width), rng.normal(0, 0.02, (width, RANK)), stats.mean(0), stats.std(0) + 1e-3)
    share = labels.mean()
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    g0, g1, g2 = 1e-8, np.full(width, 1e-8), np.full((width, RANK), 1e-8)
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            index, value, starts = model.rows([data[i] for i in pick])
            z, vx, sums = model.margin(index, value, starts)
            err = (_logistic(z) - labels[pick]) * weight[pick] / len(pick)
            lengths = np.diff(np.append(starts, len(index)))
            e = np.repeat(err, lengths) * value
            touched, where = np.unique(index, return_inverse=True)
            d1, d2 = np.zeros(len(touched)), np.zeros((len(touched), RANK))
            np.add.at(d1, where, e)
            np.add.at(d2, where, e[:, None] * (np.repeat(sums, lengths, axis=0) - vx))
            d1 += decay * model.linear[touched]
            d2 += decay * model.factors[touched]
            g0 += err.sum() ** 2
            g1[touched] += d1 * d1
            g2[touched] += d2 * d2
            model.bias -= rate * err.sum() / np.sqrt(g0)
            model.linear[touched] -= rate * d1 / np.sqrt(g1[touched])
            model.factors[touched] -= rate * d2 / np.sqrt(g2[touched])
    return model


def is_held_out(id_col: str):
    """The rows never learned from: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        max_rows: int = MAX_ROWS) -> Model:
    """A model learned from the labelled rows that are not held out."""
    marked = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
              .where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~is_held_out("id"))
              .groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("y2")).where("y = y2").select("id", "y")
              .orderBy(F.xxhash64("id"), "id").limit(max_rows))  # at most max_rows pairs of numbers
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(marked), "id")
    importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only(_words)
        for b in batches:
            found = [features(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("id").cast(pa.int64()), b.column("y").cast(pa.int32()),
                 pa.array([s.astype("<i4").tobytes() for s, _, _ in found], pa.binary()),
                 pa.array([w.astype("<f4").tobytes() for _, w, _ in found], pa.binary()),
                 pa.array([s for _, _, s in found], pa.list_(pa.float64()))], names=["id", "y", "slots", "weights", "stats"])

    got = {}
    for r in rows.select("id", "y", "text").mapInArrow(run, "id long, y int, slots binary, weights binary, stats array<double>").toLocalIterator():
        # of rows that repeat an id the one of the smallest features, whatever the order of tasks
        if r.id not in got or (r.slots, r.weights, r.stats) < (got[r.id].slots, got[r.id].weights, got[r.id].stats):
            got[r.id] = r
    rows = [got[k] for k in sorted(got)]
    data = [(np.frombuffer(r.slots, "<i4"), np.frombuffer(r.weights, "<f4").astype(float), list(r.stats)) for r in rows]
    return train(data, np.array([r.y for r in rows], float))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) per row: how likely label 1 is."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()
    importable(docs.sparkSession)

    def run(batches):
        keep_only(_words)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores(sent.value, b.column(1).to_pylist()))],
                                             names=["id", "score"])

    return (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .mapInArrow(run, f"id {kind}, score double").withColumnsRenamed({"id": id_col}))


def scores(model: Model, texts: list[str], rows: int = 500) -> np.ndarray:
    out = [_logistic(model.margin(*model.rows([features(t) for t in texts[i:i + rows]]))[0]) for i in range(0, len(texts), rows)]
    return np.concatenate(out) if out else np.zeros(0)


def keep(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows scored ``threshold`` or more, all columns as they were."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    importable(docs.sparkSession)

    def run(batches):
        keep_only(_words)
        for b in batches:
            texts = [t or "" for t in b.column(b.schema.get_field_index(text_col)).to_pylist()]
            yield b.filter(pa.array(scores(sent.value, texts) >= threshold, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
