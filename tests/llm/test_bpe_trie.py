import hashlib
import struct

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from emporium.llm import bpe_trie, queries

SF = "/root/testdata/sf0.001"

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def both():
    with open(PATH) as f:
        return bpe_trie.TrieEncoder(f.read()), Tokenizer.from_file(PATH)


def ids(enc, text):
    return list(memoryview(next(enc.encode_batch([text]))).cast("I"))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_equals_the_library(both, text):
    enc, lib = both
    got = ids(enc, text)
    assert got == lib.encode(text, add_special_tokens=False).ids
    assert enc.decode(got) == lib.decode(got, skip_special_tokens=False) == text


@pytest.mark.parametrize("text", ["", "<|endoftext|>", "a<|endoftext|> b", "x" * 50_000, "ab" * 2000, " \n\n\t z  ",
                                  "I'll we've 'S", "日本語 テスト", "½ ² Ⅷ ٣", "é" * 300, "\x1c \x85  "])
def test_odd_texts(both, text):
    enc, lib = both
    assert ids(enc, text) == lib.encode(text, add_special_tokens=False).ids


def test_query_rows(spark):
    lib = Tokenizer.from_file(PATH)
    want = {}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    for r in docs:
        e = lib.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id] = (len(e), hashlib.sha256(struct.pack(f"<{len(e)}I", *e)).hexdigest(),
                          hashlib.sha256(lib.decode(e, skip_special_tokens=False).encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op10_bpe_trie(spark, SF).collect()}
    assert got == want


def test_nulls_ties_empty_tables_and_other_columns(spark):
    schema = "id long, doc_id long, text string, ids string, n_tokens string"
    df = spark.createDataFrame([(9, 1, None, "x", "y"), (9, None, "a b", None, None), (9, 2, "", "", ""), (9, 2, "", "", "")], schema)
    rows = bpe_trie.encode_digests(df, PATH).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in rows) == [(0, 2), (1, 0), (2, 0), (2, 0)]
    assert bpe_trie.encode_digests(df.limit(0), PATH).count() == 0
    back = bpe_trie.decode(bpe_trie.encode(df, PATH), PATH)
    assert sorted(r.text for r in back.collect()) == ["", "", "", "a b"]


def test_a_batch_is_read_in_small_slices():
    """A task holds the strings of one slice, and bounded caches, not a whole batch (the pipeline's executor memory)."""
    texts = ["ü" * 300, "", "x" * 2000, "y" * 10, "z" * 10]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(texts)], names=["id", "text"])
    got = [(ids.to_pylist(), t) for ids, t in bpe_trie._groups(iter([batch]), 700)]
    assert got == [([0, 1], texts[:2]), ([2], texts[2:3]), ([3, 4], texts[3:])]
    assert bpe_trie.WORD_CACHE <= 150_000 and bpe_trie.PAIR_CACHE <= 400_000
