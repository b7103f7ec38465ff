"""Byte-pair encoding by prefix-sharing trie traversal, and decoding.

Texts are cut into words by the vocabulary's own pre-tokenization pattern.
The distinct words of a batch go into one byte trie. Every trie node is a
prefix, and the last token of the prefix's encoding is the node's state: a
token t that ends the prefix is that last token exactly if the shorter prefix
before t is empty, or its own last token s and t stay two tokens when s+t is
encoded. A depth-first walk fills in the states, so a prefix shared by many
words is encoded once; a word's tokens are read back along its path. The walk
takes the words in byte order, which visits the trie depth first, and keeps
the states of the current path only.

Work is per row: no shuffle, memory bounded by a batch and bounded caches.
Null text counts as empty (0 tokens); repeated rows are encoded each; a null
id is passed through; other columns are ignored by ``encode``.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import chunked, importable, keep_only, worker_cache

#: Fixed value: the pre-tokenization pattern of byte-level vocabularies.
BYTE_LEVEL_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: The same pattern for texts of these characters only, without the slow
#: Unicode classes.
PLAIN_LETTERS = "a-zA-ZÀ-ÖØ-öø-ÿ"
PLAIN_TEXT = re.compile(rf"[{PLAIN_LETTERS}0-9\t\n\r !-/:-@\[-`{{-~¡¿«»©·–—‘’“”]*")
PLAIN_PATTERN = re.compile(rf" ?[{PLAIN_LETTERS}]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+"
                           rf"| ?[^\s{PLAIN_LETTERS}0-9]+|\s+(?!\S)|\s+")
WORD_CACHE = 150_000
PAIR_CACHE = 400_000


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in the file: itself
    where printable, else the next free code point from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TrieEncoder:
    def __init__(self, spec: str):
        parsed = json.loads(spec)
        of = byte_characters()
        vocab = parsed["model"]["vocab"]
        raw = {t: bytes(of[c] for c in t) for t in vocab}
        self.bytes_of: dict[int, bytes] = {i: raw[t] for t, i in vocab.items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(parsed["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[left], vocab[right]] = rank, vocab[left + right]
        self.byte_id = {b[0]: i for i, b in self.bytes_of.items() if len(b) == 1}
        self.formed = dict.fromkeys(self.bytes_of, -1)  # the rank of the merge that makes a token
        self.parts: dict[int, tuple[int, int]] = {}
        for pair, (rank, i) in self.merges.items():
            if self.formed[i] < 0:
                self.formed[i], self.parts[i] = rank, pair
        # a token that its own bytes don't encode to never ends an encoding
        self.token: dict[bytes, int] = {b: i for i, b in self.bytes_of.items() if self.merge(b) == [i]}
        self.begun = {b[:i]: -1 for b in self.token for i in range(1, len(b))} | self.token
        self.width = {i: len(b) for i, b in self.bytes_of.items()}
        self.special = {t["content"]: t["id"] for t in parsed.get("added_tokens", [])}
        self.bytes_of.update({i: t.encode() for t, i in self.special.items()})
        self.special_pattern = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pattern = regex.compile(BYTE_LEVEL_PATTERN)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[str, bytes] = {}

    def merge(self, data: bytes) -> list[int]:
        """Plain merging by rank, for single tokens and pairs of tokens."""
        ids = [self.byte_id[b] for b in data]
        while len(ids) > 1:
            best = min(((self.merges.get(p, (1 << 60, 0))[0], i) for i, p in enumerate(zip(ids, ids[1:]))))
            if best[0] == 1 << 60:
                break
            rank, out, i = best[0], [], 0
            while i < len(ids):
                hit = self.merges.get((ids[i], ids[i + 1])) if i + 1 < len(ids) else None
                if hit and hit[0] == rank:
                    out.append(hit[1])
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def stay_apart(self, s: int, t: int) -> bool:
        known = self.pairs.get((s, t))
        if known is None:
            if len(self.pairs) >= PAIR_CACHE:
                self.pairs.clear()
            known = self.pairs[s, t] = self._apart(s, t)
        return known

    def _apart(self, s: int, t: int) -> bool:
        """Replays the merges of s and t backwards: the two tokens at the
        border stay apart if no merge of them comes before one of them is
        itself merged away (``used``; of equal merges the left one is first)."""
        formed, parts, merges = self.formed, self.parts, self.merges
        used = 1 << 60
        while True:
            hit = merges.get((s, t))
            if hit and hit[0] < used:
                return False
            a, b = formed[s], formed[t]
            if a < 0 and b < 0:
                return True
            if a > b:
                used, s = a, parts[s][1]
            else:
                used, t = b + 1, parts[t][0]

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Distinct words -> their ids as little-endian unsigned 32-bit integers.

        In byte order, words visit the nodes of their trie depth first: what a
        word shares with the one before is the path already walked, and only
        the nodes below it are new."""
        begun, known, apart, width = self.begun, self.pairs, self.stay_apart, self.width
        out: dict[str, bytes] = {}
        # the path walked; at each of its depths, the state, and the start of
        # the longest ending that begins some token (it never moves back)
        before, last, longest = b"", [-1], [0]
        for data, word in sorted((w.encode("utf-8", "surrogatepass"), w) for w in words):
            shared, most = 0, min(len(before), len(data))
            while shared < most and before[shared] == data[shared]:
                shared += 1
            del last[shared + 1:], longest[shared + 1:]
            for depth in range(shared + 1, len(data) + 1):
                first = -1
                for start in range(longest[depth - 1], depth):
                    t = begun.get(data[start:depth])
                    if t is None:
                        continue
                    if first < 0:
                        first = start
                    if t < 0:
                        continue
                    if not start:
                        break
                    s = last[start]
                    ok = known.get((s, t))
                    if apart(s, t) if ok is None else ok:
                        break
                last.append(t)
                longest.append(first)
            ids, at = [], len(data)
            while at:
                ids.append(last[at])
                at -= width[last[at]]
            out[word] = b"".join([i.to_bytes(4, "little") for i in reversed(ids)])
            before = data
        return out

    def split(self, text: str) -> list[str]:
        return (PLAIN_PATTERN if PLAIN_TEXT.fullmatch(text) else self.pattern).findall(text)

    def pieces(self, text: str) -> list[list[str] | bytes]:
        """Lists of words between special tokens, and these tokens' ids."""
        if self.special_pattern is None or not any(s in text for s in self.special):
            return [self.split(text)]
        return [self.special[p].to_bytes(4, "little") if p in self.special else self.split(p)
                for p in self.special_pattern.split(text) if p]

    def encode_batch(self, texts: list[str]) -> Iterator[bytes]:
        cut = [self.pieces(t) for t in texts]
        fresh = {w for ps in cut for p in ps if isinstance(p, list) for w in p if w not in self.words}
        if len(self.words) + len(fresh) > WORD_CACHE:
            self.words.clear()
            fresh = {w for ps in cut for p in ps if isinstance(p, list) for w in p}
        known = self.words
        known.update(self.encode_words(fresh))
        for ps in cut:
            yield b"".join(p if isinstance(p, bytes) else b"".join(map(known.__getitem__, p)) for p in ps)

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids, special tokens included, bad UTF-8 replaced."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_LOADED: dict[str, TrieEncoder] = worker_cache({})


def _encoder(spec) -> TrieEncoder:
    key = hashlib.sha256(spec.value.encode()).hexdigest()
    keep_only(_LOADED)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = TrieEncoder(spec.value)
    return _LOADED[key]


def _spec(df: DataFrame, tokenizer_path: str):
    # the vocabulary file is a fixed few megabytes
    with open(tokenizer_path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           batch_chars: int = 500_000) -> DataFrame:
    """(id, ids array<int>) for every row."""
    spec = _spec(df, tokenizer_path)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    importable(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(spec)
        for ids, texts in _groups(batches, batch_chars):
            data = list(enc.encode_batch(texts))
            lengths = [0]
            for d in data:
                lengths.append(lengths[-1] + len(d) // 4)
            flat = pa.Array.from_buffers(pa.int32(), lengths[-1], [None, pa.py_buffer(b"".join(data))])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), flat)], names=["id", "ids"])

    return rows.mapInArrow(run, "id long, ids array<int>").withColumnsRenamed({"id": id_col})


def decode(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) from arrays of ids; null or empty arrays give the empty text."""
    spec = _spec(df, tokenizer_path)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids"))
    importable(df.sparkSession)

    def run(batches):
        enc = _encoder(spec)
        for b in batches:
            texts = [enc.decode(x or ()) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return rows.mapInArrow(run, "id long, text string").withColumnsRenamed({"id": id_col})


def encode_digests(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   batch_chars: int = 500_000) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encodes, digests the ids,
    decodes these ids and digests the decoded text, in one pass."""
    spec = _spec(df, tokenizer_path)
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    importable(df.sparkSession)

    def run(batches):
        enc = _encoder(spec)
        sha = hashlib.sha256
        for ids, texts in _groups(batches, batch_chars):
            n, a, b = [], [], []
            for data in enc.encode_batch(texts):
                n.append(len(data) // 4)
                a.append(sha(data).hexdigest())
                b.append(sha(enc.decode(memoryview(data).cast("I")).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                                             names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string") \
        .withColumnsRenamed({"id": id_col})


def _groups(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.Array, list[str]]]:
    """Slices of the batches of ``limit`` bytes or so: only theirs are Python strings."""
    for b in batches:
        for i, j in chunked(pc.binary_length(b.column(1)).to_pylist(), limit):
            yield b.column(0).slice(i, j - i), b.column(1).slice(i, j - i).to_pylist()
