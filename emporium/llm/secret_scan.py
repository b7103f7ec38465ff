"""Secret scan: fixed patterns, and a token-efficiency test for the rest.

Base kinds (code-point spans of the whole match, end exclusive):
  assign  a name such as password or api_key, a sign, and a value of 8+ characters
  access  AKIA and capitals or digits, 16+ characters in all
  hex     32+ lower-case hex digits
Matches are leftmost and do not overlap within a kind; those too short are
dropped after matching.

The method adds kind ``token``: strings of 20+ characters of the base64/URL
alphabet whose characters per token under a byte-pair vocabulary stay at or
under ``max_ratio``. Prose and names are made of long tokens, random strings
are not. Known digests (hex of 32, 40, 56, 64, 96 or 128 digits), UUIDs and
numbers are excluded first. A name (its parts are all words or all numbers, or
it has no digit) is a secret only if a run of ``PART``+ letters in it stays at or
under ``NAME_RATIO``: real words are above it, random letters below. Of a string
that base spans cover in part, what they leave over is tested, in pieces of
``REST``+ characters.

A per-row pass over whole texts. Null texts count as empty; empty texts give
zero counts, the digest of the empty string and no spans; null ids are passed
through; repeated rows are scanned each; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import importable, keep_only, worker_cache

#: The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{32,}")  # a run of HEX is as long as can be, so these are its matches of 32+
KINDS = ("assign", "access", "hex", "token")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
DIGEST = re.compile(r"[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128}")
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
IDENTIFIER = re.compile(r"([A-Z]?[a-z]+|[A-Z]+|[0-9]+)([_/=+-]+([A-Z]?[a-z]+|[A-Z]+|[0-9]+))*[_/=+-]*|[A-Za-z]+([A-Z][a-z]+)*[0-9]{0,4}")
LETTERS = re.compile(r"[A-Za-z]+")
MAX_RATIO, NAME_RATIO = 2.3, 2.1
PART, REST = 16, 12

Span = tuple[int, int, int]  # start, kind, end


def base_spans(text: str, longest: int | None = None) -> list[Span]:
    """Spans of the base kinds, by start and kind. ``longest``: the length of
    the longest run without white space, where known."""
    out: list[Span] = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    if longest is None or longest >= 32:
        out += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(out)


class Efficiency:
    """Characters per token under a vocabulary of (bytes, rank) lines."""

    def __init__(self, ranks: bytes, pattern: str):
        lines = (line.split() for line in ranks.splitlines() if line)
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=pattern, special_tokens={},
                                          mergeable_ranks={base64.b64decode(a): int(b) for a, b in lines})

    def ratio(self, s: str) -> float:
        return len(s) / len(self.encoding.encode_ordinary(s))

    def is_random(self, s: str, max_ratio: float) -> bool:
        if s.isdigit() or DIGEST.fullmatch(s) or UUID.fullmatch(s):
            return False
        if IDENTIFIER.fullmatch(s) or not any(map(str.isdigit, s)):
            return any(len(part) >= PART and self.ratio(part) <= min(max_ratio, NAME_RATIO) for part in LETTERS.findall(s))
        return any(map(str.isalpha, s)) and self.ratio(s) <= max_ratio

    def spans(self, text: str, taken: list[Span], max_ratio: float) -> list[Span]:
        out = []
        covered = sorted((a, b) for a, _, b in taken)
        first = 0
        for m in CANDIDATE.finditer(text):
            while first < len(covered) and covered[first][1] <= m.start():
                first += 1
            at, pieces = m.start(), []
            for a, b in itertools.takewhile(lambda c: c[0] < m.end(), covered[first:]):
                pieces.append((at, a))
                at = max(at, b)
            pieces.append((at, m.end()))
            least = REST if len(pieces) > 1 else 0
            out += [(a, 3, b) for a, b in pieces if b - a > 0 and b - a >= least and self.is_random(text[a:b], max_ratio)]
        return out


def find(text: str, efficiency: Efficiency, max_ratio: float = MAX_RATIO) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, of a whole text."""
    longest = max(map(len, text.split()), default=0)
    base = base_spans(text, longest)
    return base, sorted(base + efficiency.spans(text, base, max_ratio)) if longest >= 20 else base


def show(spans: list[Span]) -> str:
    return ",".join([f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans])


_LOADED: dict[int, Efficiency] = worker_cache({})


def _efficiency(sent) -> Efficiency:
    keep_only(_LOADED)
    if sent.id not in _LOADED:
        _LOADED.clear()
        _LOADED[sent.id] = Efficiency(*sent.value)
    return _LOADED[sent.id]


class _Sent:
    """The vocabulary file (a fixed few megabytes) on its way to executors."""

    def __init__(self, df: DataFrame, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as f:
            data = f.read()
        self.id = hash((data, pattern))
        self.box = df.sparkSession.sparkContext.broadcast((data, pattern))

    @property
    def value(self):
        return self.box.value


def scan(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
         max_ratio: float = MAX_RATIO) -> DataFrame:
    """(id, n_assign, n_access, n_hex, n_token, base_sha256, spans) per row."""
    sent = _Sent(df, ranks_path, pattern)
    kind = df.schema[id_col].dataType.simpleString()
    importable(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        eff = _efficiency(sent)
        for b in batches:
            rows = []
            for text in b.column(1).to_pylist():
                base, spans = find(text, eff, max_ratio)
                n = [0, 0, 0, 0]
                for _, k, _ in spans:
                    n[k] += 1
                rows.append((*n, hashlib.sha256(show(base).encode()).hexdigest(), show(spans)))
            cols = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in cols[:4]), *(pa.array(c, pa.string()) for c in cols[4:])],
                names=["id", "n_assign", "n_access", "n_hex", "n_token", "base_sha256", "spans"])

    return (df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .mapInArrow(run, f"id {kind}, n_assign long, n_access long, n_hex long, n_token long, base_sha256 string, spans string")
            .withColumnsRenamed({"id": id_col}))


def masked(text: str, spans: list[Span], mask: str = "[SECRET]") -> str:
    """The text with every stretch covered by spans replaced."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", length_col: str = "n_chars",
           max_ratio: float = MAX_RATIO) -> DataFrame:
    """All rows and columns, secrets masked in the text; ``length_col``, where
    it is an integer column, has the new length in rows that changed."""
    sent = _Sent(df, ranks_path, pattern)
    at = df.columns.index(text_col)
    counted = df.columns.index(length_col) if length_col in df.columns and df.schema[length_col].dataType.typeName() in ("long", "integer") else None
    importable(df.sparkSession)

    def run(batches):
        eff = _efficiency(sent)
        for b in batches:
            old = b.column(at).to_pylist()
            new = [t and masked(t, find(t, eff, max_ratio)[1]) for t in old]
            cols = list(b.columns)
            cols[at] = pa.array(new, b.schema.field(at).type)
            if counted is not None:
                lengths = [n if a == t else len(t) for n, a, t in zip(b.column(counted).to_pylist(), old, new)]
                cols[counted] = pa.array(lengths, b.schema.field(counted).type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return df.mapInArrow(run, df.schema)
