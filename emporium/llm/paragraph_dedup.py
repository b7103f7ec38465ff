"""Repeated passages: paragraphs banded by MinHash, verified by word edit distance, and clustered.

A paragraph is ``WORDS`` words from a content-defined border on. Borders are
winnowed: places whose run of five words has the smallest hash of any
``REACH`` places in a row. They depend on the words beside them alone, so any
``WORDS + REACH - 1`` = 49 equal words in two documents hold an equal
paragraph, whatever is around them; one lies some 13 words after the other.

  1. Equal paragraphs are one (a digest, combined before the shuffle). Each
     has ``BANDS`` bands of ``ROWS`` minhashes of its runs of five words: with
     one word of 25 changed (similarity 0.62) two meet in a band with
     probability 0.80, and a passage has several paragraphs.
  2. In every bucket each paragraph is compared with the smallest one. Links
     are word edit distances of ``(1 - threshold) * WORDS`` = 5 at most. Where
     a bucket then holds several components, those are compared in pairs of
     blocks, which return links that join components, not pairs.
  3. Components of links are clusters; one in a single document is no repeat.
     A cluster's paragraphs stay in the document of the smallest id and go
     from the others.
  4. The outer paragraphs of a stretch, and those that aren't equal word for
     word, are compared with the paragraph of the cluster's first document (in
     that document: of its last one) and the words around it. They reach from
     the first to the last word that both have, past changed words where four
     of five words agree and three equal ones end the match. A match can go
     ``REACH`` words beyond its outer paragraph, no farther.
  5. Clusters whose paragraphs overlap in a document are one passage; a
     passage is named by its smallest cluster.

Result: stretches of repeated text, one row each: (id, first_word, last_word,
n_words covered, cluster_id of the passage, kept). Those of one document at
most ``GAP`` words apart are one stretch. Words are runs without white space,
counted from 0, punctuation alone not counted. Null, empty and texts under
``WORDS`` words and ids that are null or no numbers have no rows; very long
texts are read whole, alone in their batch; rows that repeat an id are one
document; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from emporium.llm.common import IdBitmap, WordHashes, chunked, cut, importable, keep_only, mix64, shingles, spent, text_hashes, worker_cache
from emporium.llm.components import components

SHINGLE, THRESHOLD = 5, 0.8
WORDS, REACH, GAP = 25, 25, 15
BANDS, ROWS = 6, 3
SLICE = 2  # bands whose entries are exchanged at once
SPAN = WORDS + 2 * REACH  # words of a paragraph and around it
_U = np.uint64
_cache = worker_cache(WordHashes(500_000))


def permuted(grams: np.ndarray, n: int) -> np.ndarray:
    """The n-th permutation of hashes (already well mixed): an offset and an odd factor."""
    offset, factor = mix64(np.array([2 * n + 1, 2 * n + 2], np.uint64))
    with np.errstate(over="ignore"):
        return (grams ^ offset) * (factor | _U(1))


def _sliding(x: np.ndarray, w: int, of: np.ufunc) -> np.ndarray:
    """``of`` over every w neighbours."""
    n, have = len(x) - w + 1, 1
    while have < w:
        step = min(have, w - have)
        x = of(x[:-step], x[step:])
        have += step
    return x[:n]


class Paragraphs:
    """Paragraphs of some documents: ``doc`` (which one), ``start`` (in it) and
    ``at`` (in ``words``, the words of all documents one after another)."""

    def __init__(self, texts: list[np.ndarray]):
        sizes = np.array([len(t) for t in texts], np.int64)
        base = np.cumsum(sizes) - sizes
        self.base, self.sizes = base, sizes
        self.words = np.concatenate([*texts, np.zeros(0, np.uint64)])
        self.doc = self.start = self.at = np.zeros(0, np.int64)
        self.grams = shingles(self.words, SHINGLE)
        m = np.maximum(sizes - WORDS + 1, 0)
        total = int(m.sum())
        if not total:
            return
        doc = np.repeat(np.arange(len(sizes)), m)
        start = np.arange(total) - np.repeat(np.cumsum(m) - m, m)
        g = self.grams[base[doc] + start]
        best = np.zeros(total, np.uint64)
        if total >= REACH:
            least = _sliding(g, REACH, np.minimum)
            least[doc[:total - REACH + 1] != doc[REACH - 1:]] = 0  # of two documents
            pad = np.zeros(REACH - 1, np.uint64)
            # the largest of the minima of all stretches that hold a place
            best = _sliding(np.concatenate([pad, least, pad]), REACH, np.maximum)
        few = (m > 0) & (m < REACH)
        if few.any():
            filled = np.flatnonzero(m)
            lows = np.zeros(len(m), np.uint64)
            lows[filled] = np.minimum.reduceat(g, (np.cumsum(m) - m)[filled])
            best = np.where(few[doc], lows[doc], best)
        chosen = np.flatnonzero(best == g)
        self.doc, self.start = doc[chosen], start[chosen]
        self.at = base[self.doc] + self.start

    def digests(self) -> np.ndarray:
        h = np.full(len(self.at), 0x77, np.uint64)
        for k in range(0, WORDS, SHINGLE):
            h = mix64(h ^ self.grams[self.at + k])
        return h.view(np.int64)

    def band_keys(self) -> list[np.ndarray]:
        """The bucket of each paragraph, band by band."""
        cuts = np.stack([self.at, self.at + WORDS - SHINGLE + 1], 1).ravel()
        grams = np.append(self.grams, self.grams[:1])  # the one added is in no paragraph
        out = []
        for band in range(BANDS):
            key = _U(band)
            for row in range(ROWS):
                key = mix64(np.minimum.reduceat(permuted(grams, band * ROWS + row), cuts)[::2] ^ key)
            out.append(key.view(np.int64))
        return out

    def bodies(self) -> pa.Array:
        return _binary(self.words[self.at[:, None] + np.arange(WORDS)])

    def contexts(self) -> pa.Array:
        """Shorter hashes of the paragraph and ``REACH`` words on each side, 0 beyond the text."""
        near = self.start[:, None] + np.arange(-REACH, WORDS + REACH)
        inside = (near >= 0) & (near < self.sizes[self.doc][:, None])
        words = (self.words[np.where(inside, self.base[self.doc][:, None] + near, 0)] & _U(0xFFFFFFFF)).astype(np.uint32) | np.uint32(1)
        return _binary(np.where(inside, words, np.uint32(0)))


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row of a matrix as bytes."""
    width = rows.shape[1] * rows.itemsize
    return pa.Array.from_buffers(pa.binary(width), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows).tobytes())]).cast(pa.binary())


def _matrix(column: pa.Array, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def of_documents(docs: DataFrame, columns, schema: str) -> DataFrame:
    """Rows (id, ...) of the paragraphs of (id, text); ``columns`` gives all but the id."""
    importable(docs.sparkSession)
    names = ["id", *(c.split()[0] for c in schema.split(","))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only(_cache)
        for b in batches:
            for i, j in chunked((pc.binary_length(b.column(1)).to_numpy() // 6).tolist(), 40_000):
                found = Paragraphs(text_hashes(b.column(1).slice(i, j - i), _cache))
                if len(found.at):
                    ids = b.column(0).slice(i, j - i).to_numpy(zero_copy_only=False)[found.doc]
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c) for c in columns(found))], names=names)

    return docs.mapInArrow(run, f"id long, {schema}")


def word_edits(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Edit distances of the rows of two matrices of words, ``most + 1`` if larger."""
    n, length = a.shape
    far = np.int8(most + 1)
    before = [np.full(n, k - most if k >= most else far, np.int8) for k in range(2 * most + 1)]
    for i in range(1, length + 1):
        now: list[np.ndarray] = []
        for k in range(2 * most + 1):
            j = i + k - most
            if j < 0 or j > length:
                now.append(np.full(n, far, np.int8))
                continue
            d = before[k] + (a[:, i - 1] != b[:, j - 1]) if j else np.full(n, far, np.int8)
            if k < 2 * most:
                d = np.minimum(d, before[k + 1] + np.int8(1))
            if k:
                d = np.minimum(d, now[k - 1] + np.int8(1))
            now.append(np.minimum(d, far))
        before = now
    return before[most].astype(np.int64)


def compared(pairs: DataFrame, bodies: DataFrame, most: int, share: int = 5000) -> DataFrame:
    """The pairs (a, b) of at most ``most`` edits. A paragraph that many pairs
    name as ``b`` is sent once per ``share`` of them."""
    load = pairs.groupBy("b").agg(F.ceil(F.count("*") / share).cast("int").alias("parts")).withColumnRenamed("b", "kb")
    dealt = (pairs.join(load, F.col("b") == F.col("kb")).withColumn("part", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int")).drop("kb", "parts"))
    right = (bodies.join(load, F.col("digest") == F.col("kb"))
             .select("kb", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("kp"), F.col("body").alias("body_b")))
    left = bodies.select(F.col("digest").alias("ka"), F.col("body").alias("body_a"))
    both = (dealt.join(left, F.col("a") == F.col("ka")).join(right, (F.col("b") == F.col("kb")) & (F.col("part") == F.col("kp")))
            .select("a", "b", "body_a", "body_b"))

    def run(batches):
        for t in batches:
            if t.num_rows:
                x, y = (_matrix(t.column(k), np.uint64, WORDS) for k in (2, 3))
                yield t.select(["a", "b"]).filter(pa.array(word_edits(x, y, most) <= most))

    return both.mapInArrow(run, "a long, b long")


def _joining_links(t: pa.Table, most: int) -> pa.Table:
    """Links between components of some buckets' paragraphs (or of two blocks
    of one bucket), those only that join components anew."""
    bucket, own, i, j = t.column("bucket").to_numpy(), t.column("own").to_numpy(), t.column("i")[0].as_py(), t.column("j")[0].as_py()
    digest, comp = t.column("digest").to_numpy(), t.column("comp").to_numpy()
    words = _matrix(t.column("body"), np.uint64, WORDS)
    out, root = [], {c: c for c in comp.tolist()}

    def find(c):
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    def join(x, y):
        other = comp[x] != comp[y]
        x, y = x[other], y[other]
        for k in range(0, len(x), 50_000):
            a, b = x[k:k + 50_000], y[k:k + 50_000]
            near = word_edits(words[a], words[b], most) <= most
            for p, q in zip(a[near].tolist(), b[near].tolist()):
                u, v = find(comp[p]), find(comp[q])
                if u != v:
                    root[u] = v
                    out.append((int(digest[p]), int(digest[q])))

    if i != j:
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        join(np.repeat(left, len(right)), np.tile(right, len(left)))
    else:
        order = np.argsort(bucket, kind="stable")
        some: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for rows in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            x, y = np.triu_indices(len(rows), 1)
            some.append((rows[x], rows[y]))
            held += len(x)
            if held > 50_000:
                join(*(np.concatenate(c) for c in zip(*some)))
                some, held = [], 0
        if some:
            join(*(np.concatenate(c) for c in zip(*some)))
    return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})


def links(spark: SparkSession, held: DataFrame, bodies: DataFrame, most: int, block: int = 400) -> DataFrame:
    """Links (a, b) that join all similar paragraphs of each bucket of ``held(bucket, digest, head)``."""
    pairs = held.where("digest <> head").select(F.col("digest").alias("a"), F.col("head").alias("b")).distinct()
    part = components(spark, cut(spark, compared(pairs, bodies, most), "alike"))
    placed = (held.where("digest <> head").join(part.withColumnRenamed("node", "kn"), F.col("digest") == F.col("kn"), "left")
              .select("bucket", "digest", F.coalesce("component", "digest").alias("comp")))
    mixed = placed.groupBy("bucket").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2"), F.ceil(F.count("*") / block).cast("int").alias("blocks")).where("c1 < c2")
    open_ = cut(spark, placed.join(mixed.select(F.col("bucket").alias("k"), "blocks"), F.col("bucket") == F.col("k")), "open")
    # buckets of one block share tasks, some 2,000 rows each; a larger one has its own
    shard = F.when(F.col("blocks") > 1, F.col("bucket")).otherwise(F.pmod(F.xxhash64("bucket"), F.lit(open_.count() // 2000 + 1)))
    dealt = (open_.join(bodies.withColumnRenamed("digest", "kd"), F.col("digest") == F.col("kd"))
             .withColumn("own", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("bucket", shard.alias("shard"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "digest", "comp", "body"))
    more = dealt.groupBy("shard", "i", "j").applyInArrow(lambda t: _joining_links(t, most), "a long, b long").distinct()
    return part.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)


def extension(same: np.ndarray) -> np.ndarray:
    """How far rows of words agree from their beginning on: to the farthest
    word that ends three equal ones (or equals from the first on) while four of
    five words are equal. 0 is no word."""
    reach = np.arange(1, same.shape[1] + 1, dtype=np.int16)
    total = same.cumsum(1, dtype=np.int16)
    three = same.copy()
    three[:, 1:] &= same[:, :-1]
    three[:, 2:] &= same[:, :-2]
    ends = (total == reach) | (three & (total * 5 >= reach * 4) & (reach > 2))
    return (ends * reach).max(1)


def first_equal(x: np.ndarray, y: np.ndarray, most: int = 5) -> np.ndarray:
    """Where in contexts ``x`` the words begin that ``y`` has too: from the first
    three equal words of the paragraph (words put in or left out may have moved
    them by ``most``) as far before it as they extend."""
    best = np.full(len(x), SPAN)
    back = np.arange(1, REACH + WORDS + 1)
    for shift in range(-most, most + 1):
        same = np.zeros(x.shape, bool)
        here, there = slice(max(0, -shift), SPAN - max(0, shift)), slice(max(0, shift), SPAN - max(0, -shift))
        same[:, here] = x[:, here] == y[:, there]
        same &= x != 0
        three = (same[:, :-2] & same[:, 1:-1] & same[:, 2:])[:, REACH:REACH + WORDS - 2]
        rows = np.flatnonzero(three.any(1))  # few, but for one shift
        at = REACH + three[rows].argmax(1)
        before = at[:, None] - back
        begin = at - extension((before >= 0) & same[rows[:, None], np.maximum(before, 0)])
        best[rows] = np.minimum(best[rows], begin)
    return np.where(best < SPAN, best, REACH)


def extended(edges: DataFrame, most: int) -> DataFrame:
    """(id, start, end, cluster, kept) of the equal words in and around paragraphs with contexts."""
    importable(edges.sparkSession)

    def run(batches):
        for t in batches:
            if t.num_rows:
                x, y = (_matrix(t.column(c), np.uint32, SPAN) for c in ("context", "other"))
                origin = t.column("start").to_numpy().astype(np.int64) - REACH
                first, last = first_equal(x, y, most), SPAN - first_equal(x[:, ::-1], y[:, ::-1], most)
                yield pa.RecordBatch.from_arrays([t.column("id"), pa.array(origin + first), pa.array(origin + last), t.column("cluster"), t.column("kept")],
                                                 names=["id", "start", "end", "cluster", "kept"])

    return edges.select("id", "start", "cluster", "kept", "context", "other").mapInArrow(run, "id long, start long, end long, cluster long, kept boolean")


def _place() -> Column:
    return F.xxhash64("id", "start", "digest")


def in_buckets(spark: SparkSession, keyed: DataFrame, keys: list[str]) -> DataFrame:
    """(bucket, digest, lo, head) of the paragraphs in the buckets of some bands
    that hold several, not all begun in one document; head is the smallest."""
    entry = keyed.select("digest", "lo", F.explode(F.array(*keys)).alias("bucket"))
    # paragraphs that all begin in one document need no link
    heads = cut(spark, entry.groupBy("bucket").agg(F.min("digest").alias("head"), F.min("lo").alias("l1"), F.max("lo").alias("l2"))
                .where("l1 < l2").select(F.col("bucket").alias("k"), "head"), "heads")
    out = cut(spark, IdBitmap(spark, heads.select("k")).rows(entry, "bucket", among=True).join(heads, F.col("bucket") == F.col("k"))
              .select("bucket", "digest", "lo", "head"), "held")
    spent(heads)
    return out


def repeated(spark: SparkSession, df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, gap: int = GAP) -> DataFrame:
    """(id, first_word, last_word, n_words, cluster_id, kept); see the module."""
    most = int((1 - threshold) * WORDS + 1e-9)
    docs = (df.select(F.col(id_col).try_cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where("id is not null"))

    # 1: distinct paragraphs and their buckets
    keys = [f"k{b}" for b in range(BANDS)]
    rows = of_documents(docs, lambda p: [p.digests(), *p.band_keys()], ", ".join(f"{c} long" for c in ["digest", *keys]))
    keyed = cut(spark, rows.groupBy("digest").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), *(F.min(k).alias(k) for k in keys)), "keyed")
    # a bucket is one band's: some bands at a time are exchanged
    slices = [in_buckets(spark, keyed, keys[i:i + SLICE]) for i in range(0, BANDS, SLICE)]
    held = reduce(DataFrame.union, slices)
    copied = cut(spark, keyed.where("lo < hi").select("digest", "lo", "hi"), "copied")
    spent(keyed)

    # 2: their words, from the first document that has them
    wanted = cut(spark, held.select(F.col("digest").alias("k"), "lo").distinct(), "wanted")
    holders = IdBitmap(spark, wanted.select("lo")).rows(docs, "id", among=True)
    written = of_documents(holders, lambda p: [p.digests(), p.bodies()], "digest long, body binary")
    bodies = cut(spark, IdBitmap(spark, wanted.select("k")).rows(written, "digest", among=True)
                 .join(wanted, (F.col("digest") == F.col("k")) & (F.col("id") == F.col("lo"))).groupBy("digest").agg(F.first("body").alias("body")), "bodies")
    part = components(spark, links(spark, held.drop("lo"), bodies, most))
    spent(*slices, bodies)

    # 3: clusters of two documents or more, and where they are; a paragraph without links is one if equal ones are
    ranges = wanted.select(F.col("k").alias("digest"), "lo", F.col("lo").alias("hi")).union(copied)
    of_cluster = (ranges.join(part, F.col("digest") == F.col("node"), "left").where("component is not null or lo < hi")
                  .select("digest", F.coalesce("component", "digest").alias("cluster"), "lo", "hi"))
    shared = of_cluster.groupBy("cluster").agg(F.min("lo").alias("least"), F.max("hi").alias("most")).where("least < most").select(F.col("cluster").alias("kc"), "least")
    chosen = cut(spark, of_cluster.select("digest", "cluster").distinct().join(shared, F.col("cluster") == F.col("kc")).select(F.col("digest").alias("k"), "cluster", "least"), "chosen")
    spent(copied, wanted, part)
    places = of_documents(docs, lambda p: [p.start.astype(np.int32), p.digests()], "start int, digest long")
    located = (IdBitmap(spark, chosen.select("k")).rows(places, "digest", among=True).join(chosen, F.col("digest") == F.col("k"))
               .select("id", "start", "digest", "cluster", (F.col("id") == F.col("least")).alias("kept")))

    # 4: outer paragraphs of what stays and of what goes, and what they are compared with
    order, own = W.partitionBy("id").orderBy("start"), W.partitionBy("id", "kept").orderBy("start")
    # a document's rows are exchanged once, to be made distinct and put in order
    beside = cut(spark, located.repartition("id").distinct().select("*", F.lag("start").over(order).alias("near"), F.lag("cluster").over(order).alias("previous"),
                                                  F.lag("start").over(own).alias("before"), F.lead("start").over(own).alias("after")), "beside")
    outer = F.expr(f"before is null or start - before > {WORDS} or after is null or after - start > {WORDS}")
    ends = cut(spark, beside.groupBy(F.col("cluster").alias("kc")).agg(*(f(F.struct("id", "start", "digest")).alias(n) for f, n in ((F.min, "first"), (F.max, "last")))), "ends")
    edges = cut(spark, beside.join(ends, F.col("cluster") == F.col("kc")).withColumn("o", F.when(F.col("kept"), F.col("last")).otherwise(F.col("first")))
                .select("id", "start", "digest", "cluster", "kept", (outer | (F.col("digest") != F.col("o.digest"))).alias("faces"), *(F.col(f"o.{c}").alias(f"o_{c}") for c in ("id", "start", "digest"))), "edges")
    spent(ends)
    faced, whole = edges.where("faces"), edges.where("not faces")
    needed = cut(spark, faced.select("id", "start", "digest").union(faced.select("o_id", "o_start", "o_digest")).select("id", _place().alias("place")).distinct(), "needed")
    around = of_documents(IdBitmap(spark, needed.select("id").distinct()).rows(docs, "id", among=True),
                          lambda p: [p.start.astype(np.int32), p.digests(), p.contexts()], "start int, digest long, context binary")
    contexts = cut(spark, IdBitmap(spark, needed.select("place")).rows(around.withColumn("place", _place()), "place", among=True)
                   .groupBy("place").agg(F.first("context").alias("context")), "contexts")
    mine = faced.withColumn("p", _place()).withColumn("q", F.xxhash64("o_id", "o_start", "o_digest"))
    paired = (mine.join(contexts.withColumnRenamed("place", "kp"), F.col("p") == F.col("kp"))
              .join(contexts.select(F.col("place").alias("kq"), F.col("context").alias("other")), F.col("q") == F.col("kq")))
    longer = cut(spark, extended(paired, most), "longer")
    spent(needed, contexts)

    # 5: passages
    passage = components(spark, beside.where(f"start - near < {WORDS}").select(F.col("previous").alias("a"), F.col("cluster").alias("b")))
    spans = longer.union(whole.select("id", F.col("start").cast("long"), (F.col("start") + WORDS).cast("long").alias("end"), "cluster", "kept"))

    order = W.partitionBy("id", "kept").orderBy("start", "end")
    marked = (spans.withColumn("before", F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1)))
              .withColumn("fresh", F.greatest(F.col("end") - F.greatest("start", F.coalesce("before", F.lit(0))), F.lit(0)))
              .withColumn("n", F.sum(F.when(F.col("before").isNull() | (F.col("start") > F.col("before") + gap), 1).otherwise(0)).over(order)))
    stretches = marked.groupBy("id", "kept", "n").agg(F.min("start").alias("first_word"), (F.max("end") - 1).alias("last_word"), F.sum("fresh").cast("long").alias("n_words"),
                                                      F.min("cluster").alias("cluster"))
    # what goes anyway isn't reported as staying too
    gone = F.max(F.when(~F.col("kept"), F.col("last_word"))).over(W.partitionBy("id").orderBy("first_word").rangeBetween(W.unboundedPreceding, W.currentRow))
    left = stretches.withColumn("gone", gone).where(~F.col("kept") | F.col("gone").isNull() | (F.col("gone") < F.col("last_word")))
    return (left.join(passage.withColumnRenamed("node", "kn"), F.col("cluster") == F.col("kn"), "left")
            .select(F.col("id").alias(id_col), "first_word", "last_word", "n_words", F.coalesce("component", "cluster").alias("cluster_id"), "kept"))
