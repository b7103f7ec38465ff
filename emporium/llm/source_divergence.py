"""Source divergence audit over a single-pass in-memory index.

Terms are runs of non-ASCII characters and ASCII letters, A-Z in lower case.
Of every language the terms in at least ``least_docs`` of its documents are
kept; for every (lang, source) group and every language a smoothed share p of
each kept term is compared between groups.

1. Index. A task reads its documents once into a block of postings: counts by
   (lang, source, term) and numbers of documents by (lang, term). When a block
   holds ``block`` entries it is spilled as a run: rows of term-sorted chunks,
   each of one hash shard and language.
2. Merge. Shards are shuffled whole (a term is in a run once, so the most
   frequent one is one entry per run) and their chunks sorted by first term. A
   heap over the open chunks merges them: what lies before the first term of
   the next chunk is final. Terms in too few documents end here.
3. Corrections. For a pair of sources the sum over all kept terms is V times
   the value of two absent terms plus, for every term that one of them has,
   the difference to that. Chunks of terms are streamed against the totals of
   the sources of their language; a task adds up whole pairs and the ten best
   terms of each group before anything is shuffled.

Arithmetic is in integers throughout: p comes from whole division of integers
that grow where a count passes 2^32, all other products stay below 2^63.

A row is a document, repeated or not; null text, lang and source count as ''.
Empty texts make their group occur. A very long text is counted whole (its own
distinct words are held beside the block). A language has one row that names
its sources, which is small beside the pairs that are asked for. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from emporium.llm.common import cut, importable, spent

LEAST_DOCS = 10
TOP_TERMS = 10
BLOCK = 800_000      # entries of a block of postings
CHUNK = 2_000        # terms of a chunk
TILE = 1 << 20       # counts (terms x sources) compared at once
HELD = 1 << 22       # sums of pairs a task holds before it hands them on
UNIT = 10 ** 9
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_CHUNK = "lang string, names array<string>, terms array<binary>, docs array<long>, sizes array<int>, source array<int>, count array<long>"


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Block:
    """Postings in memory. The empty term stands for the group itself."""

    def __init__(self):
        self.counts: dict[tuple[str, str], Counter] = defaultdict(Counter)
        self.docs: dict[str, Counter] = defaultdict(Counter)
        self.entries = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        counts, docs = self.counts[lang, source], self.docs[lang]
        before = len(counts) + len(docs)
        found = words(text)
        counts.update(found)
        counts[b""] += 0
        docs.update(set(found))
        docs[b""] += 1
        self.entries += len(counts) + len(docs) - before

    def run(self, shards: int) -> Iterator[pa.RecordBatch]:
        """(shard, first, chunk) rows of each language, terms ascending within a shard."""
        for lang, docs in self.docs.items():
            names = sorted(s for x, s in self.counts if x == lang)
            counts = [self.counts[lang, s] for s in names]
            terms = sorted(docs)
            n = len(terms)
            shard = np.fromiter((xxhash.xxh64_intdigest(t) % shards for t in terms), np.int32, n)
            order = np.argsort(shard, kind="stable")
            terms, shard = [terms[i] for i in order.tolist()], shard[order]
            place = dict(zip(terms, range(n)))
            at = np.concatenate([np.fromiter(map(place.__getitem__, c), np.int64, len(c)) for c in counts])
            source = np.repeat(np.arange(len(names), dtype=np.int32), [len(c) for c in counts])
            count = np.concatenate([np.fromiter(c.values(), np.int64, len(c)) for c in counts])
            by_term = np.argsort(at, kind="stable")
            sizes = np.bincount(at, minlength=n)
            new = np.flatnonzero(np.diff(shard, prepend=-1))
            start = np.flatnonzero((np.arange(n) - np.repeat(new, np.diff(new, append=n))) % CHUNK == 0)
            cuts = np.append(start, n)
            entry = np.append(0, np.cumsum(sizes))[cuts]
            lists = lambda values, where: pa.ListArray.from_arrays(pa.array(where, pa.int32()), values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard[start]), pa.array([terms[i] for i in start.tolist()], pa.binary()), pa.array([lang] * len(start)), pa.array([names] * len(start)),
                 lists(pa.array(terms, pa.binary()), cuts), lists(pa.array(np.fromiter(map(docs.__getitem__, terms), np.int64, n)), cuts),
                 lists(pa.array(sizes.astype(np.int32)), cuts), lists(pa.array(source[by_term]), entry), lists(pa.array(count[by_term]), entry)],
                names=["shard", "first", "lang", "names", "terms", "docs", "sizes", "source", "count"])


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def runs(docs: DataFrame, shards: int, text_col: str, lang_col: str, source_col: str, block: int) -> DataFrame:
    importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Block()
        for text, lang, source in _rows(batches):
            held.add(lang, source, text)
            if held.entries >= block:
                yield from held.run(shards)
                held = Block()
        yield from held.run(shards)

    of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(of(text_col).cast("binary"), of(lang_col), of(source_col)).mapInArrow(run, f"shard int, first binary, {_CHUNK}")


def _opened(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, str, tuple]]:
    """(shard, lang, chunk) with a chunk as (names, terms, documents, where each
    term's entries start, sources, counts)."""
    for b in batches:
        shard, lang, names = b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()
        for i in range(b.num_rows):
            terms, docs, sizes, source, count = (b.column(c)[i].values for c in range(4, 9))
            starts = np.append(0, np.cumsum(sizes.to_numpy())).tolist()
            yield shard[i], lang[i], (names[i], terms.to_pylist(), docs.to_numpy().tolist(), starts, source.to_numpy(), count.to_numpy())


def merged(chunks: Iterable[tuple], least_docs: int) -> Iterator[tuple[bytes, int, dict[str, int]]]:
    """(term, documents, count by source) of the terms in enough documents (and
    of the empty one), from chunks that ascend by first term."""
    heap: list = []
    for seq, c in enumerate(chain(chunks, [None])):
        while heap and (c is None or heap[0][0] < c[1][0]):
            term, docs, parts = heap[0][0], 0, []
            while heap and heap[0][0] == term:
                _, k, i, x = heap[0]
                docs += x[2][i]
                parts.append((x, i))
                i += 1
                if i < len(x[1]):
                    heapq.heapreplace(heap, (x[1][i], k, i, x))
                else:
                    heapq.heappop(heap)
            if docs >= least_docs or not term:
                counts: dict[str, int] = {}
                for (names, _, _, starts, source, count), i in parts:
                    for s, n in zip(source[starts[i]:starts[i + 1]].tolist(), count[starts[i]:starts[i + 1]].tolist()):
                        counts[names[s]] = counts.get(names[s], 0) + n
                yield term, docs, counts
        if c is not None:
            heapq.heappush(heap, (c[1][0], seq, 0, c))


def frequencies(spilled: DataFrame, shards: int, least_docs: int) -> DataFrame:
    """Chunks of the kept terms with their whole counts, and ``totals``: the
    sums of the chunk by name."""
    names = ["lang", "names", "terms", "docs", "sizes", "source", "count", "totals"]
    kinds = [pa.string(), pa.list_(pa.string()), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()),
             pa.list_(pa.int64()), pa.list_(pa.int64())]

    def whole(lang: str, terms: list) -> pa.RecordBatch:
        found = sorted({s for t in terms for s in t[2]})
        place, totals = {s: i for i, s in enumerate(found)}, [0] * len(found)
        for _, _, counts in terms:
            for s, n in counts.items():
                totals[place[s]] += n
        pairs = [sorted((place[s], n) for s, n in counts.items()) for _, _, counts in terms]
        values = (lang, found, [t[0] for t in terms], [t[1] for t in terms], [len(p) for p in pairs], [x[0] for p in pairs for x in p],
                  [x[1] for p in pairs for x in p], totals)
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, lang), rows in groupby(_opened(batches), lambda r: r[:2]):
            out = []
            for t in merged((r[2] for r in rows), least_docs):
                out.append(t)
                if len(out) == CHUNK:
                    yield whole(lang, out)
                    out = []
            if out:
                yield whole(lang, out)

    dealt = spilled.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "lang", "first")
    return dealt.mapInArrow(run, f"{_CHUNK}, totals array<long>")


def share(count, total, terms):
    """p of counts, as arrays or plain integers."""
    return 1 + UNIT * (count + 2) // (total + 2 * terms)


def gap(p, q):
    return (p - q) * (p - q) // (p + q)


def _integers(values: list[int]) -> np.ndarray:
    """Of any length: products with UNIT have to fit."""
    return np.array(values, np.int64 if max(values, default=0) < 1 << 32 else object)


def corrections(joined: DataFrame, top: int) -> DataFrame:
    """(lang, part, source, item, value) of chunks beside the sources and
    totals of their language, summed or cut to the best terms by task."""
    importable(joined.sparkSession)
    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64()]
    names = ["lang", "part", "source", "item", "value"]

    def batch(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(rows), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows[i:i + 50_000]), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: dict[tuple[str, str], tuple[list[str], np.ndarray, np.ndarray]] = {}  # lang, source -> others, sums met alone, sums met by both
        best: dict[tuple[str, str], list[tuple[int, bytes]]] = {}
        held = 0

        def handed() -> Iterator[pa.RecordBatch]:
            for (lang, s), (others, alone, both) in pairs.items():
                there, back = alone + both, alone
                yield from batch([(lang, "pair", s, others[t], int(there[t])) for t in np.flatnonzero(there).tolist()]
                                 + [(lang, "pair", others[t], s, int(back[t])) for t in np.flatnonzero(back).tolist()])
            yield from batch([(lang, "term", s, t.decode("utf-8", "replace"), -v) for (lang, s), found in best.items() for v, t in found])
            pairs.clear()
            best.clear()

        for lang, of_chunk, terms, _, sizes, source, count, _, others, totals, kept in _rows(batches):
            place = {s: i for i, s in enumerate(others)}
            total = _integers(totals)
            row = np.repeat(np.arange(len(terms)), sizes)
            column = np.array([place[of_chunk[s]] for s in source], int)
            value = _integers(count)
            base, width = share(0, total, kept), max(1, TILE // len(others))
            whole = sum(totals)
            for low in range(0, len(terms), width):
                high = min(low + width, len(terms))
                here = (row >= low) & (row < high)
                counts = np.zeros((high - low, len(others)), value.dtype)
                counts[row[here] - low, column[here]] = value[here]
                p = share(counts, total[None, :], kept).astype(np.int64)
                in_lang = share(_integers([int(c) for c in counts.sum(1)]), whole, kept).astype(np.int64)
                has = counts > 0
                for s in np.flatnonzero(has.any(0)).tolist():
                    at = np.flatnonzero(has[:, s])
                    change = gap(p[at, s][:, None], p[at]) - gap(int(base[s]), base.astype(np.int64))[None, :]
                    met = (change * has[at]).sum(0)
                    sums = pairs.get((lang, others[s]))
                    if sums is None:
                        sums = pairs[lang, others[s]] = (others, np.zeros(len(others), np.int64), np.zeros(len(others), np.int64))
                        held += 2 * len(others)
                    sums[1][:] += change.sum(0) - met
                    sums[2][:] += met
                    over = at[p[at, s] > in_lang[at]]
                    values = gap(p[over, s], in_lang[over])
                    order = np.argsort(-values, kind="stable")[:top]
                    best[lang, others[s]] = sorted(best.get((lang, others[s]), []) + [(-int(values[i]), terms[low + over[i]]) for i in order])[:top]
                    if held > HELD:
                        yield from handed()
                        held = 0
        yield from handed()

    return joined.mapInArrow(run, "lang string, part string, source string, item string, value long")


def divergence(spark: SparkSession, docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
               least_docs: int = LEAST_DOCS, top: int = TOP_TERMS, block: int = BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank); see the module."""
    shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spilled = cut(spark, runs(docs, shards, text_col, lang_col, source_col, block), "runs")
    kept = cut(spark, frequencies(spilled, shards, least_docs), "frequencies")
    spent(spilled)
    n_terms = F.size(F.filter("terms", lambda t: t != F.lit(b"")))
    groups = kept.select("lang", F.explode(F.arrays_zip("names", "totals")).alias("g")).groupBy("lang", F.col("g.names").alias("source")).agg(
        F.sum("g.totals").alias("total"))
    langs = (groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "total"))).alias("s"))
             .select(F.col("lang").alias("l"), F.col("s.source").alias("others"), F.col("s.total").alias("all_totals"))
             .join(kept.groupBy(F.col("lang").alias("l")).agg(F.sum(n_terms).alias("n_kept")), "l"))
    totals = cut(spark, langs, "totals")
    of_terms = kept.where(n_terms > 0).select(  # the empty term has no counts
        "lang", "names", "terms", "docs", "sizes", "source", "count", "totals")
    found = cut(spark, corrections(of_terms.join(totals, F.col("lang") == F.col("l")).select(
        *of_terms.columns, "others", "all_totals", "n_kept"), top), "corrections")
    spent(kept)
    change = (found.where("part = 'pair'").groupBy(F.col("lang").alias("l"), F.col("source").alias("a"), F.col("item").alias("b"))
              .agg(F.sum("value").alias("change")))
    of_source = totals.select("l", "n_kept", F.explode(F.arrays_zip("others", "all_totals")).alias("g")).select(
        "l", "n_kept", F.col("g.others").alias("a"), F.expr("case when n_kept > 0 then 1 + 2000000000 div (g.all_totals + 2 * n_kept) end").alias("p"))
    both = of_source.join(of_source.select("l", F.col("a").alias("b"), F.col("p").alias("q")), "l").where("a <> b")
    pair = (both.join(change, ["l", "a", "b"], "left")
            .select(F.col("l").alias("lang"), F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"),
                    F.expr("coalesce(n_kept * ((p - q) * (p - q) div (p + q)), 0) + coalesce(change, 0)").cast("long").alias("value")))
    term = found.where("part = 'term'").select("lang", "source", "part", "item", "value")
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (pair.withColumn("rank", F.row_number().over(order))
            .unionByName(term.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (SELECT rid, lang, source, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS item FROM d),
kept AS MATERIALIZED (SELECT lang, item FROM w GROUP BY lang, item HAVING count(DISTINCT rid) >= 10),
v AS (SELECT lang, count(*) AS n FROM kept GROUP BY lang),
c AS MATERIALIZED (SELECT lang, source, item, count(*) AS n FROM w JOIN kept USING (lang, item) GROUP BY lang, source, item),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
total AS (SELECT lang, source, coalesce(sum(n), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS MATERIALIZED (SELECT g.lang, g.source, k.item, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (total.n + 2 * v.n) AS p
  FROM g JOIN kept k ON g.lang = k.lang JOIN v ON v.lang = g.lang JOIN total ON total.lang = g.lang AND total.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.item = k.item),
q AS (SELECT lang, item, 1 + (1000000000::HUGEINT * (sum(p.n) + 2)) // (any_value(t.n) + 2 * any_value(v.n)) AS q
  FROM p JOIN v USING (lang) JOIN (SELECT lang, sum(n) AS n FROM total GROUP BY lang) t USING (lang) GROUP BY lang, item),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT a.lang, a.source AS s, b.source AS o, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.item = b.item AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source) x ON x.lang = a.lang AND x.s = a.source AND x.o = b.source),
term AS (SELECT lang, source, 'term' AS part, item, (p - q) * (p - q) // (p + q) AS value FROM p JOIN q USING (lang, item) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
