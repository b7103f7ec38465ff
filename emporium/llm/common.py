"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import string
import weakref
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.session import run_folder

_OUTER = string.punctuation + "¡¿«»“”‘’…–—"
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


#: Bytes of an Arrow batch, unless the session sets them: a task holds several
#: copies of one (in the JVM both ways, in Python as buffers and as strings).
BATCH_BYTES, _BATCH_KEY, _BATCH_DEFAULT = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def importable(spark: SparkSession) -> None:
    """Python workers find this package where the driver does (a cluster
    that has it elsewhere names it with --py-files), and get rows in batches
    of ``BATCH_BYTES`` or so, not in Spark's 10,000 rows whatever their texts."""
    if spark.conf.get(_BATCH_KEY, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the rest of a job
    starts from files every executor sees, so a lost one costs no recompute.
    What was exchanged for it goes from the executors' disks when it is written."""
    importable(spark)
    path = run_folder(spark, f"llm-{name}")
    before = spark.conf.get(_CLEANUP_KEY, "false")
    spark.conf.set(_CLEANUP_KEY, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP_KEY, before)
    out = spark.read.schema(df.schema).parquet(path)
    _STORED[id(out)] = (weakref.ref(out, lambda _, k=id(out): _STORED.pop(k, None)), path)
    return out


_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_STORED: dict[int, tuple[weakref.ref, str]] = {}


def spent(*tables: DataFrame) -> None:
    """Empty the folders of tables made by ``cut`` that no later job reads:
    all that was derived from them has to be written already."""
    for df in tables:
        _, path = _STORED.pop(id(df))
        none = df.sparkSession.range(0, 0, 1, 1).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema))
        none.write.mode("overwrite").parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` has them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijective scrambling of unsigned 64-bit integers."""
    with np.errstate(over="ignore"):
        x = x + _GOLD
        x = (x ^ (x >> np.uint64(30))) * _MIX1
        x = (x ^ (x >> np.uint64(27))) * _MIX2
        return x ^ (x >> np.uint64(31))


_CACHES: list = []


def worker_cache(cache):
    """Marks a module's cache (anything with ``clear``) as one of a Python worker."""
    _CACHES.append(cache)
    return cache


def keep_only(*caches) -> None:
    """Called where a task of an operator begins: a worker serves the tasks of
    many operators, and holds the caches of one at a time."""
    for c in _CACHES:
        if not any(c is k for k in caches):
            c.clear()


class WordHashes(dict):
    """Raw token -> 64-bit hash of the word in lower case without outer
    punctuation; 0 for tokens that are punctuation only. Bounded: emptied
    when it holds ``limit`` tokens."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, token: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        word = token.lower().strip(_OUTER)
        h = (xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) or 1) if word else 0
        self[token] = h
        return h


def word_hashes(text: str | None, cache: WordHashes) -> np.ndarray:
    """64-bit hashes of the words of a text, in order (see ``WordHashes``)."""
    tokens = (text or "").split()
    out = np.fromiter(map(cache.__getitem__, tokens), np.uint64, len(tokens))
    return out if out.all() else out[out != 0]


_SPACE, _PUNCTUATION = (np.isin(np.arange(256), [*map(ord, c)]) for c in ("\t\n\v\f\r\x1c\x1d\x1e\x1f ", string.punctuation))
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
#: Characters of two bytes in lower case (both bytes), 0 for those that are no
#: letters of a word, that change their length or that depend on their neighbours.
_LOWER2 = np.array([int.from_bytes(b) if len(b := c.lower().encode()) == 2 and not c.isspace() and c not in _OUTER + "Σ" else 0 for c in map(chr, range(0x800))], np.uint16)
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def short_xxh64(data: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """xxh64 (seed 0) of the runs of ``n`` < 32 bytes from ``at`` on."""
    data = np.append(data, np.zeros(8, np.uint8))
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))  # the bytes from each place on
    h = n.astype(np.uint64) + _P5
    for k in (8, 16, 24):
        t = np.flatnonzero(n >= k)
        h[t] = _turned(h[t] ^ (_turned(eight[at[t] + (k - 8)] * _P2, 31) * _P1), 27) * _P1 + _P4
    t = np.flatnonzero(n & 4)
    h[t] = _turned(h[t] ^ ((eight[at[t] + (n[t] & 24)] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
    for k in range(3):
        t = np.flatnonzero((n & 3) > k)
        h[t] = _turned(h[t] ^ (data[at[t] + (n[t] & 28) + k] * _P5), 11) * _P1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def text_hashes(texts: pa.Array, cache: WordHashes) -> list[np.ndarray]:
    """``word_hashes`` of each text of a column of strings, from its bytes: words
    of less than 32 bytes and of characters of one or two are hashed together,
    the others one by one."""
    if not len(texts):
        return []
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    texts.validate(full=True)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    space = np.concatenate([[True], _SPACE[data], [True]])
    starts = np.flatnonzero(~space[1:-1] & (space[:-2] | edge[:-1]))
    if not len(starts):
        return [np.zeros(0, np.uint64)] * len(texts)
    ends = np.flatnonzero(~space[1:-1] & (space[2:] | edge[1:])) + 1
    doc = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, offsets)))
    # without outer punctuation
    at, end = starts.copy(), ends.copy()
    outer = _PUNCTUATION[data]
    t = np.flatnonzero(outer[starts] | outer[ends - 1])
    inner = np.append(np.flatnonzero(~outer), len(data))
    i, j = np.searchsorted(inner, starts[t]), np.searchsorted(inner, ends[t])
    at[t] = inner[i]
    end[t] = np.where(i < j, inner[j - 1] + 1, inner[i])
    n = end - at
    low = _LOWER[data]
    high = np.flatnonzero(data > 127)
    two = high[(data[high] >= 0xC0) & (data[high] < 0xE0)]
    both = _LOWER2[(data[two] & 31).astype(np.int64) << 6 | data[two + 1] & 63]
    low[two], low[two + 1] = both >> 8, both & 255
    alone = n > 31
    alone[np.searchsorted(starts, np.concatenate([two[both == 0], high[data[high] >= 0xE0]]), "right") - 1] = True
    h = short_xxh64(low, at, np.where(alone, 0, n))
    h[h == 0] = 1
    h[n == 0] = 0
    if alone.any():
        raw = data.tobytes()
        found = [[*map(cache.__getitem__, raw[a:b].decode().split())] for a, b in zip(starts[alone].tolist(), ends[alone].tolist())]
        sizes = np.ones(len(h), np.int64)
        sizes[alone] = [len(f) for f in found]
        h, doc, alone = np.repeat(h, sizes), np.repeat(doc, sizes), np.repeat(alone, sizes)
        h[alone] = np.array([x for f in found for x in f], np.uint64)
    h, doc = h[h != 0], doc[h != 0]
    return np.split(h, np.cumsum(np.bincount(doc, minlength=len(texts)))[:-1])


def shingles(words: np.ndarray, k: int = 5) -> np.ndarray:
    """One hash per run of ``k`` words; a shorter text is one shingle."""
    n = len(words)
    if n == 0:
        return words
    k = min(k, n)
    with np.errstate(over="ignore"):
        h = words[:n - k + 1].copy()
        for i in range(1, k):
            h = h * _MIX1 + words[i:n - k + 1 + i]
        return mix64(h)


def multiset(items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(items, return_counts=True)


def multiset_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of minimal over sum of maximal multiplicities."""
    total = int(a[1].sum()) + int(b[1].sum())
    if total == 0:
        return 0.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / (total - both)


def chunked(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows whose sizes sum to ``limit`` at most (a
    larger row is alone)."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


BITMAP_BITS = 1 << 25  # in 524,288 words: what is broadcast at most


class IdBitmap:
    """A bitmap of hashed ids, 64 bits an id and ``BITMAP_BITS`` at most: tells
    most rows whose id is not among the ids apart without an exchange of the
    rows. Its words are broadcast, a table of proven size. Of more than some
    millions of ids it separates fewer rows, and none falsely."""

    def __init__(self, spark: SparkSession, ids: DataFrame):
        """``ids`` has one column of type long."""
        self.bits = min(BITMAP_BITS, 1 << max(10, int(64 * max(ids.count(), 1) - 1).bit_length()))
        place = self._place(F.col(ids.columns[0]))
        one = ids.where(F.col(ids.columns[0]).isNotNull()).select(F.shiftright(place, 6).alias("at"), F.expr("1L").alias("one"), place.bitwiseAND(63).cast("int").alias("n"))
        self.words = cut(spark, one.groupBy("at").agg(F.expr("bit_or(shiftleft(one, n))").alias("word")), "bitmap")

    def _place(self, column: Column) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.bits))

    def rows(self, df: DataFrame, id_col: str, among: bool) -> DataFrame:
        """The rows whose id may be among the ids (null ids aren't), or the others."""
        place, at, word = fresh(df, "place", "at", "word")
        words = self.words.select(F.col("at").alias(at), F.col("word").alias(word))
        found = df.withColumn(place, self._place(F.col(id_col))).join(F.broadcast(words), F.shiftright(F.col(place), 6) == F.col(at), "left")
        hit = (F.col(id_col).isNotNull() & F.coalesce(F.expr(f"getbit(`{word}`, cast(`{place}` & 63 as int)) = 1"), F.lit(False)))
        return found.where(hit if among else ~hit).select(df.columns)
