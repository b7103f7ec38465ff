"""Benchmark decontamination by SimHash over item-sized windows.

A window is a run of as many words as a benchmark item has (the whole text,
where it is shorter). Its fingerprint is the 64-bit SimHash of its shingles of
five words, each weighing by how rare it is among the items. A multi-index
holds the item fingerprints of every size: the 64 bits are cut in 8 blocks,
and each block's table lists the items whose block lies within 2 bits of the
key. Two fingerprints within 23 bits agree to within 2 bits in at least one
of the 8 blocks, so looking up all blocks of a window finds every item within
the radius; those in it are verified by the exact weighted similarity of the
shingle multisets, sum of minima over sum of maxima.

Windows without a single shingle of an item of their size have similarity 0
and are passed over; all others, at every word, are fingerprinted and looked
up. (At similarity 0.8 two fingerprints differ in about 10 of 64 bits, with a
deviation of 3; the radius of 23 is four deviations away.)

The items are taken in blocks of at most ``block_bytes`` of text, one index
and one pass over the documents each, so the broadcast index is bounded
whatever the benchmark's size; documents are never shuffled by their text.

Result: one row per document and item found, (id, item_id, similarity of the
best window, first_word and last_word of that window, the leftmost of equal
ones). Items and texts without words match nothing; null texts count as
empty; repeated documents or items give their rows each once per distinct
(id, item); null ids are reported with a null id; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.llm.common import chunked, importable, keep_only, shingles, worker_cache, word_hashes, WordHashes

SHINGLE, THRESHOLD = 5, 0.8
BITS, BLOCKS, RADIUS = 64, 8, 23
_U = np.uint64
_cache = worker_cache(WordHashes())


def _signs(hashes: np.ndarray) -> np.ndarray:
    """+1 / -1 for each bit of each hash."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.float64) * 2 - 1


def _pack(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 1e-9, axis=1, bitorder="little").copy().view("<u8")[:, 0]


class ItemIndex:
    """Multi-index of the items: built on the driver from one block of items."""

    def __init__(self, items: list[tuple[int, str]], shingle: int = SHINGLE, radius: int = RADIUS,
                 shared: dict[int, int] | None = None, n_items: int | None = None):
        """``items`` is a block of all items; ``shared`` has the shingles that
        several of all items have, with their number, and ``n_items`` is the
        number of all. So weights are the same in every block (a shingle of one
        item weighs what one of none does). Without them the block is all."""
        self.shingle, self.radius = shingle, radius
        cache = WordHashes()
        words = [(i, w) for i, w in ((i, word_hashes(t, cache)) for i, t in items) if len(w)]
        self.ids = [i for i, _ in words]
        self.grams = [shingles(w, shingle) for _, w in words]
        if shared is None:
            shared, n_items = defaultdict(int), len(words)
            for g in self.grams:
                for h in set(g.tolist()):
                    shared[h] += 1
        self.own = np.unique(np.concatenate(self.grams)) if words else np.zeros(0, np.uint64)
        known = sorted(h for h, n in shared.items() if n > 1)
        self.known = np.array(known, np.uint64)
        self.rarity = np.log(1 + n_items / np.array([shared[h] for h in known], float))
        self.unseen = float(np.log(1 + max(n_items, 1)))
        prints = [int(_pack((_signs(g) * self.weights(g)[:, None]).sum(0)[None])[0]) for g in self.grams]
        self.prints = np.array(prints, np.uint64)
        self.bags = [self.bag(g) for g in self.grams]
        # by size: the items' shingles, and for each block the items near a key
        self.sizes: dict[int, tuple[np.ndarray, list[dict[int, list[int]]]]] = {}
        near = [x for x in range(256) if bin(x).count("1") <= radius // BLOCKS]
        by_size: dict[int, list[int]] = defaultdict(list)
        for k, (_, w) in enumerate(words):
            by_size[len(w)].append(k)
        for size, ks in by_size.items():
            tables: list[dict[int, list[int]]] = [defaultdict(list) for _ in range(BLOCKS)]
            for k in ks:
                for block in range(BLOCKS):
                    key = prints[k] >> 8 * block & 255
                    for flips in near:
                        tables[block][key ^ flips].append(k)
            self.sizes[size] = np.unique(np.concatenate([self.grams[k] for k in ks])), tables
        self.widths = sorted({min(shingle, s) for s in by_size})
        self.filter = np.zeros(1 << 22, bool)
        self.filter[(self.own >> _U(42)).astype(np.int64)] = True

    def weights(self, grams: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.full(len(grams), self.unseen)
        at = np.minimum(np.searchsorted(self.known, grams), len(self.known) - 1)
        return np.where(self.known[at] == grams, self.rarity[at], self.unseen)

    def bag(self, grams: np.ndarray) -> tuple[dict[int, int], dict[int, float], float]:
        hs, ns = np.unique(grams, return_counts=True)
        w = self.weights(hs)
        return dict(zip(hs.tolist(), ns.tolist())), dict(zip(hs.tolist(), w.tolist())), float((w * ns).sum())

    def similarity(self, grams: np.ndarray, k: int) -> float:
        count, weight, total = self.bag(grams)
        other, w2, total2 = self.bags[k]
        both = sum(w2[h] * min(n, count[h]) for h, n in other.items() if h in count)
        return both / (total + total2 - both) if both else 0.0

    def hits(self, grams: np.ndarray) -> np.ndarray:
        """Places of shingles that some item has."""
        at = np.flatnonzero(self.filter[(grams >> _U(42)).astype(np.int64)])
        if not len(at):
            return at
        own = np.minimum(np.searchsorted(self.own, grams[at]), len(self.own) - 1)
        return at[self.own[own] == grams[at]]

    def touched(self, texts: list[np.ndarray]) -> list[int]:
        """Texts with a shingle of an item, and some at whose border one lies."""
        out: set[int] = set()
        if not texts or not len(self.own):
            return []
        lengths = np.array([len(t) for t in texts])
        ends = np.cumsum(lengths)
        flat = np.concatenate(texts)
        for width in self.widths:
            if len(flat) >= width:
                out.update(np.searchsorted(ends, self.hits(shingles(flat, width)), side="right").tolist())
        # a text shorter than the shingle is a single shingle of its own length
        out.update(np.flatnonzero((lengths > 0) & (lengths < self.shingle)).tolist())
        return sorted(out)

    def search(self, words: np.ndarray, threshold: float) -> dict[int, tuple[float, int, int]]:
        """Item number -> best (similarity, first word, last word) of a text."""
        best: dict[int, tuple[float, int, int]] = {}
        n = len(words)
        grams = {w: shingles(words, w) for w in {min(w, n) for w in self.widths}}
        known = {w: self.hits(g) for w, g in grams.items()}
        totals: dict[int, np.ndarray] = {}
        for size, (own, tables) in self.sizes.items():
            span = min(size, n)
            width = min(self.shingle, span)
            if min(self.shingle, size) != width or width not in grams:
                continue
            g, hits = grams[width], known[width]
            hits = hits[np.isin(g[hits], own)]
            if not len(hits):
                continue
            inside = span - width + 1  # shingles in a window
            starts = np.unique((hits[:, None] - np.arange(inside)[None, :]).ravel())
            starts = starts[(starts >= 0) & (starts <= n - span)]
            if width not in totals:
                totals[width] = np.concatenate([np.zeros((1, BITS)), np.cumsum(_signs(g) * self.weights(g)[:, None], axis=0)])
            t = totals[width]
            prints = _pack(t[starts + inside] - t[starts])
            for start, mark in zip(starts.tolist(), prints.tolist()):
                found = {k for block in range(BLOCKS) for k in tables[block].get(mark >> 8 * block & 255, ())}
                for k in found:
                    if (mark ^ int(self.prints[k])).bit_count() <= self.radius:
                        s = self.similarity(g[start:start + inside], k)
                        if s >= threshold - 1e-12 and (k not in best or s > best[k][0] + 1e-12):
                            best[k] = s, start, start + span - 1
        return best


def shared_shingles(own: DataFrame, shingle: int) -> tuple[dict[int, int], int]:
    """Shingles that several items have, with their number, and the number of
    items with words: what the weights depend on, whatever the blocks."""
    importable(own.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text in b.column(0).to_pylist():
                words = word_hashes(text, _cache)
                if len(words):
                    found = np.unique(shingles(words, shingle)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([None, *found.tolist()], pa.int64())], names=["shingle"])  # null: the item itself

    counts = own.select("text").mapInArrow(run, "shingle long").groupBy("shingle").agg(F.count("*").alias("n"))
    found = counts.where("n > 1 or shingle is null").collect()
    return ({r.shingle % (1 << 64): r.n for r in found if r.shingle is not None}, sum(r.n for r in found if r.shingle is None))


def indexes(spark: SparkSession, items: DataFrame, item_col: str, item_text_col: str, shingle: int, block_bytes: int):
    """The broadcast indexes of the blocks of items, one after the other."""
    own = (items.select(F.col(item_col).cast("long").alias("item_id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text")).distinct()
           .withColumn("size", F.octet_length("text")))
    total = own.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    n_blocks = max(1, -(-2 * total // block_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    shared, n_items = shared_shingles(own, shingle) if n_blocks > 1 else (None, None)
    for k in range(n_blocks):
        part = [(r.item_id, r.text) for r in own.where(block == k).orderBy("item_id", "text").collect()]
        yield spark.sparkContext.broadcast(ItemIndex(part, shingle, shared=shared, n_items=n_items))


def matches(spark: SparkSession, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD, shingle: int = SHINGLE,
            block_bytes: int = 16 << 20) -> DataFrame:
    """(id, item_id, similarity, first_word, last_word); see the module."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = None
    for index in indexes(spark, items, item_col, item_text_col, shingle, block_bytes):
        importable(docs.sparkSession)

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            keep_only(_cache)
            ix = index.value
            for b in batches:
                texts, found = b.column(1).to_pylist(), []
                for i, j in chunked([len(t) // 6 for t in texts], 400_000):
                    words = [word_hashes(t, _cache) for t in texts[i:j]]
                    for at in ix.touched(words):
                        found += [(i + at, ix.ids[k], *m) for k, m in ix.search(words[at], threshold).items()]
                if found:
                    at, item, s, a, z = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(at, pa.int64())), pa.array(item, pa.int64()), pa.array(s, pa.float64()),
                         pa.array(a, pa.int64()), pa.array(z, pa.int64())], names=["id", "item_id", "similarity", "first_word", "last_word"])

        part = rows.mapInArrow(run, "id long, item_id long, similarity double, first_word long, last_word long")
        out = part if out is None else out.union(part)
    best = (out.groupBy("id", "item_id").agg(F.max(F.struct("similarity", (-F.col("first_word")).alias("f"), "last_word")).alias("m"))
            .select(F.col("id").alias(id_col), "item_id", "m.similarity", (-F.col("m.f")).alias("first_word"), F.col("m.last_word").alias("last_word")))
    return best


def clean(spark: SparkSession, docs: DataFrame, items: DataFrame, text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """The rows of documents in which no item is found, all columns as they
    were: a row's own text decides, in one pass per block of items without any
    exchange. Null and empty texts stay."""
    importable(spark)
    at, out = docs.columns.index(text_col), docs
    for index in indexes(spark, items, "item_id", "text", SHINGLE, 16 << 20):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            keep_only(_cache)
            ix = index.value
            for b in batches:
                stays = np.ones(b.num_rows, bool)
                for i, j in chunked((pc.binary_length(b.column(at)).fill_null(0).to_numpy() // 6).tolist(), 400_000):
                    words = [word_hashes(t, _cache) for t in b.column(at).slice(i, j - i).to_pylist()]
                    for k in ix.touched(words):
                        stays[i + k] = not ix.search(words[k], threshold)
                yield b.filter(pa.array(stays))

        out = out.mapInArrow(run, out.schema)
    return out
