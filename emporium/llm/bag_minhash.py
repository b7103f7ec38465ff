"""Near-duplicate documents by BagMinHash signatures.

A document is the multiset of its runs of five words. The signature is the
weighted minhash of that multiset: every shingle owns, for each stretch
[0,1), [1,2), [2,4), [4,8), ... of the weight axis, a Poisson process in time
whose points carry a signature slot and a place in the stretch, found by
halving it; a document sees the points whose place lies under its count of
the shingle. A slot keeps the earliest point it sees. Two documents agree in
a slot with the probability of their multiset Jaccard similarity. Points are
made in the order of time and only up to the time at which all slots are
filled, so long documents need less than one point a shingle.

Slots are banded; documents that agree in a whole band are candidates:
  1. Equal word sequences are one text, which has a number of its own.
  2. In every band bucket, each text is compared with the bucket's smallest
     (candidates grow with the bucket, not with its square).
  3. The exact multiset similarity of these pairs is verified from the texts.
  4. Verified links make components. Where a bucket still holds several
     components, its texts of different components are compared as well, in
     pairs of blocks of ``block`` texts, unless the triangle inequality of
     1 - similarity rules the link out by what both have with the bucket's
     smallest. A task returns the links that join components, not all pairs.
     So no link is lost to step 2.
  5. The components of all links are the classes; only there texts give way to
     ids.

Results: one row per input row (id, class_id = smallest id of the class, kept
= the id is the smallest of its class). A text without words is equal to
none, rows without an id take no part (class null, kept). Rows that repeat an
id are one document: their texts share a class, and only ``drop_copies``
tells the rows apart. Null text counts as empty. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.llm.common import (IdBitmap, WordHashes, chunked, cut, fresh, importable, keep_only, mix64, multiset, multiset_jaccard,
                                 shingles, spent, word_hashes, worker_cache)
from emporium.llm.components import components

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 20, 5
_U = np.uint64


def signatures(counts: list[tuple[np.ndarray, np.ndarray]], slots: int) -> np.ndarray:
    """BagMinHash signatures of multisets (hashes, counts), one row each; an
    empty multiset has zeros."""
    out = np.zeros((len(counts), slots), np.uint64)
    todo = [i for i, (h, _) in enumerate(counts) if len(h)]
    reach = {i: slots * (np.log(slots) + 3) / counts[i][1].sum() for i in todo}
    while todo:
        doc = np.concatenate([np.full(len(counts[i][0]), k) for k, i in enumerate(todo)])
        item = np.concatenate([counts[i][0] for i in todo])
        count = np.concatenate([counts[i][1] for i in todo]).astype(np.int64)
        until = np.array([reach[i] for i in todo])
        # one process for each shingle and stretch of the weight axis under its count
        levels = np.where(count > 1, np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64), 0) + 1
        who = np.repeat(np.arange(len(item)), levels)
        level = np.arange(len(who)) - np.repeat(np.cumsum(levels) - levels, levels)
        low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
        width = np.maximum(low, 1)
        seed = mix64(item[who] ^ mix64(level.astype(np.uint64) + _U(77)))
        doc, count = doc[who], count[who]
        clock = np.zeros(len(seed))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        step = 0
        while len(seed):
            r = mix64(seed + _U((2 * step + 1) * 0x9E3779B1))
            clock = clock - np.log(((r >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / width
            live = clock <= until[doc]
            seed, doc, count, low, width, clock, r = (x[live] for x in (seed, doc, count, low, width, clock, r))
            q = mix64(r ^ _U(0xA5A5A5A5A5A5A5A5))
            place = low + ((q >> _U(32)).astype(np.int64) & (width - 1))  # the halvings, as bits
            seen = place < count
            slot = (q & _U(0xFFFFFFFF)).astype(np.int64) * slots >> 32
            found.append(((doc * slots + slot)[seen], clock[seen], q[seen]))
            step += 1
        at, when, value = (np.concatenate(x) for x in zip(*found))
        late_first = np.argsort(-when, kind="stable")
        flat, filled = np.zeros(len(todo) * slots, np.uint64), np.zeros(len(todo) * slots, bool)
        flat[at[late_first]] = value[late_first]  # the earliest is written last
        filled[at] = True
        done = filled.reshape(-1, slots).all(1)
        rows = flat.reshape(-1, slots)
        for k, i in enumerate(todo):
            if done[k]:
                out[i] = rows[k]
            else:
                reach[i] *= 2
        todo = [i for k, i in enumerate(todo) if not done[k]]
    return out


def bands(signature: np.ndarray, n: int, rows: int) -> np.ndarray:
    """A hash for each band of each signature, different from band to band."""
    h = mix64(np.arange(n, dtype=np.uint64))[None, :].repeat(len(signature), 0)
    for r in range(rows):
        h = mix64(h ^ signature[:, r * n:(r + 1) * n])
    return h


_cache = worker_cache(WordHashes())


def _texts(batches: Iterator[pa.RecordBatch], limit: int = 60_000) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of (id, text) batches of ``limit`` words or so, with the words' hashes."""
    keep_only(_cache)
    for b in batches:
        for i, j in chunked((pc.binary_length(b.column(1)).to_numpy() // 6).tolist(), limit):
            part = b.slice(i, j - i)
            yield part, [word_hashes(t, _cache) for t in part.column(1).to_pylist()]


def sketch(docs: DataFrame, n_bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE) -> DataFrame:
    """(id, digest of the words, band hashes) for each row of (id, text) with words."""
    importable(docs.sparkSession)

    def run(batches):
        for b, words in _texts(batches):
            got = [i for i, w in enumerate(words) if len(w)]
            if not got:
                continue
            sig = signatures([multiset(shingles(words[i], shingle)) for i in got], n_bands * rows)
            keys = bands(sig, n_bands, rows).astype("<u8").view("<i8")
            flat = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), n_bands).cast(pa.list_(pa.int64()))
            digests = [xxhash.xxh128_digest(words[i].tobytes()) for i in got]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(got)), pa.array(digests, pa.binary()), flat],
                                             names=["id", "digest", "bands"])

    return docs.mapInArrow(run, "id long, digest binary, bands array<long>")


def digested(docs: DataFrame) -> DataFrame:
    """(digest of the words, text) for each row of (id, text) with words."""
    importable(docs.sparkSession)

    def run(batches):
        for b, words in _texts(batches):
            got = [i for i, w in enumerate(words) if len(w)]
            yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh128_digest(words[i].tobytes()) for i in got], pa.binary()),
                                              b.column(1).take(pa.array(got, pa.int64()))], names=["digest", "text"])

    return docs.select("id", "text").mapInArrow(run, "digest binary, text string")


def verified(pairs: DataFrame, texts: DataFrame, shingle: int = SHINGLE, share: int = 500) -> DataFrame:
    """pairs(a, b, ...) with the exact multiset similarity of their texts(id, text).

    A text that many pairs name as ``b`` is sent once per ``share`` of them."""
    load = pairs.groupBy("b").agg(F.ceil(F.count("*") / share).cast("int").alias("parts")).withColumnRenamed("b", "kb")
    dealt = (pairs.join(load, F.col("b") == F.col("kb"))
             .withColumn("part", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int")).drop("kb", "parts"))
    right = (texts.join(load, F.col("id") == F.col("kb"))
             .select(F.col("id").alias("kb"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("kp"), F.col("text").alias("text_b")))
    left = texts.select(F.col("id").alias("ka"), F.col("text").alias("text_a"))
    extra = [c for c in pairs.columns if c not in ("a", "b")]
    joined = (dealt.join(left, F.col("a") == F.col("ka"))
              .join(right, (F.col("b") == F.col("kb")) & (F.col("part") == F.col("kp")))
              .select("text_a", "text_b", "a", "b", *extra))
    importable(pairs.sparkSession)

    def run(batches):
        keep_only(_cache)
        known: dict[str, tuple] = {}
        for batch in batches:
            out = []
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if b not in known:
                    known.clear()
                    known[b] = multiset(shingles(word_hashes(b, _cache), shingle))
                out.append(multiset_jaccard(multiset(shingles(word_hashes(a, _cache), shingle)), known[b]))
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(out, pa.float64())],
                                             names=[*batch.schema.names[2:], "similarity"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in joined.schema.fields[2:])
    return joined.mapInArrow(run, f"{schema}, similarity double")


def _links_of_blocks(t: pa.Table, shingle: int, threshold: float) -> pa.Table:
    """Links between different components of a block (or two) of a bucket's
    texts: exact similarities where the triangle inequality leaves one
    possible, and of the links only those that join components anew."""
    keep_only(_cache)
    own, i, j = t.column("own").to_numpy(), t.column("i")[0].as_py(), t.column("j")[0].as_py()
    rep, comp, owner, far = (t.column(c).to_numpy() for c in ("rep", "comp", "owner", "far"))
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    maybe = ((np.abs(far[left][:, None] - far[right][None, :]) <= 1 - threshold + 1e-9) & (comp[left][:, None] != comp[right][None, :])
             & (owner[left][:, None] != owner[right][None, :]))
    if i == j:
        maybe &= rep[left][:, None] < rep[right][None, :]
    out: list[tuple[int, int]] = []
    if maybe.any():
        texts = t.column("text").to_pylist()
        bags = {k: multiset(shingles(word_hashes(texts[k], _cache), shingle)) for k in {*left[maybe.any(1)].tolist(), *right[maybe.any(0)].tolist()}}
        used = [k for k in right.tolist() if k in bags]
        place = {k: n for n, k in enumerate(used)}
        # the right texts by shingle
        items, counts = np.concatenate([bags[k][0] for k in used]), np.concatenate([bags[k][1] for k in used])
        row = np.repeat(np.arange(len(used)), [len(bags[k][0]) for k in used])
        order = np.argsort(items, kind="stable")
        items, counts, row = items[order], counts[order], row[order]
        sizes = np.array([bags[k][1].sum() for k in used])
        root = {c: c for c in {*comp.tolist()}}

        def find(c):
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        for x, wanted in zip(left.tolist(), maybe):
            if not wanted.any():
                continue
            h, n = bags[x]
            a, b = np.searchsorted(items, h, "left"), np.searchsorted(items, h, "right")
            length = b - a
            at = np.repeat(a - np.cumsum(length) + length, length) + np.arange(length.sum())
            both = np.bincount(row[at], np.minimum(counts[at], np.repeat(n, length)), len(used))
            near = both >= threshold * (n.sum() + sizes - both) - 1e-9
            for k in right[wanted].tolist():
                if near[place[k]] and find(comp[x]) != find(comp[k]):
                    root[find(comp[x])] = find(comp[k])
                    out.append((max(rep[x], rep[k]), min(rep[x], rep[k])))
    return pa.table({"a": pa.array([int(a) for a, _ in out], pa.int64()), "b": pa.array([int(b) for _, b in out], pa.int64())})


def linked(spark: SparkSession, held: DataFrame, texts: DataFrame, shingle: int, threshold: float, block: int = 400) -> DataFrame:
    """Verified links (a, b) that join all similar texts of a bucket.

    ``held(bucket, rep, head)`` has the members of each bucket and its
    smallest; ``texts(id, text)`` has their texts. With a column ``owner``,
    links between members of one owner are of no use and not looked for
    after the comparison with the bucket's smallest."""
    if "owner" not in held.columns:
        held = held.withColumn("owner", F.col("rep"))
    pairs = held.where("rep > head").select(F.col("rep").alias("a"), F.col("head").alias("b")).distinct()
    first = cut(spark, verified(pairs, texts, shingle), "verified")
    links = first.where(F.col("similarity") >= threshold).select("a", "b")

    # buckets of several components
    part = components(spark, links)
    placed = (held.join(part.withColumnRenamed("node", "kn"), F.col("rep") == F.col("kn"), "left")
              .where("rep <> head")  # pairs with the smallest are verified
              .select("bucket", "rep", "head", "owner", F.coalesce("component", "rep").alias("comp")))
    mixed = (placed.groupBy("bucket").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2"), F.min("owner").alias("o1"), F.max("owner").alias("o2"))
             .where("c1 < c2 and o1 < o2").select(F.col("bucket").alias("k")))
    open_ = (placed.join(mixed, F.col("bucket") == F.col("k"), "left_semi")
             .join(first.select(F.col("a").alias("ka"), F.col("b").alias("kb"), "similarity"),
                   (F.col("rep") == F.col("ka")) & (F.col("head") == F.col("kb")))
             .select("bucket", "rep", "comp", "owner", (1 - F.col("similarity")).alias("far")))
    # compared block by block; each task returns links that join components, not pairs
    open_ = cut(spark, open_, "open")
    blocks = open_.groupBy("bucket").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).withColumnRenamed("bucket", "k")
    dealt = (open_.join(blocks, F.col("bucket") == F.col("k")).join(texts.select(F.col("id").alias("kt"), "text"), F.col("rep") == F.col("kt"))
             .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "comp", "owner", "far", "text"))
    second = dealt.groupBy("bucket", "i", "j").applyInArrow(lambda t: _links_of_blocks(t, shingle, threshold), "a long, b long").distinct()
    by_part = part.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    return by_part.union(second)


def near_duplicates(spark: SparkSession, df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_bands: int = BANDS,
                    rows: int = ROWS, shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """(id, class_id, kept, digest) per input row; see the module."""
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    named = docs.where("id is not null")
    sketches = cut(spark, sketch(named, n_bands, rows, shingle), "sketch")

    # 1: equal word sequences are one text, numbered, as an id can have several
    of_text = sketches.groupBy("digest").agg(F.min("id").alias("least"), F.first("bands").alias("bands"))
    texts = cut(spark, of_text.withColumn("rep", F.monotonically_increasing_id()), "texts")
    member = cut(spark, sketches.select("id", "digest").distinct().join(texts.select("digest", "rep", "least"), "digest"), "members")
    spent(sketches)
    several = cut(spark, member.groupBy("id").agg(F.count("*").alias("n"), F.min("rep").alias("first")).where("n > 1").select(F.col("id").alias("k"), "first"), "several")

    # 2: within each bucket, all against the smallest
    entry = texts.select("rep", F.explode("bands").alias("bucket")).distinct()
    head = (entry.groupBy("bucket").agg(F.min("rep").alias("head"), F.max("rep").alias("top"))
            .where("head < top").select(F.col("bucket").alias("k"), "head"))
    held = cut(spark, entry.join(head, F.col("bucket") == F.col("k")).select("bucket", "rep", "head"), "buckets")

    # 3: exact similarity, from the texts of candidates alone; where an id has several, by the digest
    near = held.select(F.col("rep").alias("kr")).distinct()
    wanted = cut(spark, texts.select("rep", "digest", "least").join(near, F.col("rep") == F.col("kr"), "left_semi"), "wanted")
    sole = wanted.join(several, F.col("least") == F.col("k"), "left_anti").select(F.col("least").alias("kl"), "rep")
    # most documents are no candidates: they are left out before any exchange
    thin = IdBitmap(spark, wanted.select("least")).rows(named, "id", among=True)
    by_id = (thin.join(sole, F.col("id") == F.col("kl")).groupBy("id").agg(F.min("text").alias("text"), F.first("rep").alias("rep"))
             .select(F.col("rep").alias("id"), "text"))
    rest = wanted.join(several, F.col("least") == F.col("k"), "left_semi").select(F.col("digest").alias("kd"), "rep")
    # ids of several texts are few: no other document meets them in an exchange
    repeated = IdBitmap(spark, several.select("k")).rows(named, "id", among=True).join(several, F.col("id") == F.col("k"), "left_semi")
    by_digest = (digested(repeated).join(rest, F.col("digest") == F.col("kd"))
                 .groupBy("rep").agg(F.min("text").alias("text")).select(F.col("rep").alias("id"), "text"))
    chosen = cut(spark, by_id.union(by_digest), "candidates")
    spent(wanted)
    # rows that share an id share a class
    same_id = member.join(several, F.col("id") == F.col("k")).where("rep <> first").select(F.col("rep").alias("a"), F.col("first").alias("b"))

    # 5: classes, named by their smallest id
    classes = components(spark, linked(spark, held, chosen, shingle, threshold).union(same_id))
    placed = cut(spark, member.join(classes.withColumnRenamed("node", "kn"), F.col("rep") == F.col("kn"), "left")
                 .select("id", "least", F.coalesce("component", "rep").alias("class")), "classes")
    names = placed.groupBy("class").agg(F.min("least").alias("class_id")).withColumnRenamed("class", "kc")
    classed = placed.join(names, F.col("class") == F.col("kc")).select("id", "class_id").distinct()
    return (docs.select("id").join(classed.withColumnRenamed("id", "kn"), F.col("id") == F.col("kn"), "left")
            .select(F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"),
                    F.coalesce(F.col("class_id") == F.col("id"), F.lit(True)).alias("kept")))


def drop_copies(spark: SparkSession, df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``df`` that stay, all columns as they were: one document of
    each class, and of rows that repeat its id one (the one of the smallest
    text and columns). Rows without an id stay."""
    key, stays, times = fresh(df, "key", "stays", "times")
    classes = near_duplicates(spark, df, id_col, text_col, **how)
    flags = cut(spark, classes.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias(key))
                .agg(F.max("kept").alias(stays), F.count("*").alias(times)), "flags")
    # most rows stay and repeat no id: only the others meet their flags in an exchange
    changed = flags.where(~F.col(stays) | (F.col(times) > 1))
    ids = IdBitmap(spark, changed.select(key))
    (own,) = fresh(df, "own")
    rows = df.withColumn(own, df[id_col].cast("long"))
    untouched = ids.rows(rows, own, among=False).drop(own)
    marked = ids.rows(rows, own, among=True).join(changed, F.col(own) == F.col(key), "left")
    once = marked.where(F.col(key).isNull()).select(df.columns)
    first = F.min_by(F.struct(*df.columns), F.struct(F.coalesce(text_col, F.lit("")), F.xxhash64(*df.columns)))
    again = marked.where(F.col(stays) & (F.col(times) > 1)).groupBy(key).agg(first.alias(stays)).select(f"{stays}.*")
    return untouched.union(once).union(again)
