import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from sifter.llm import token_files as tf
from sifter.llm.tokens import WordTable, groups, vocab_path
import pyarrow as pa

TOKENIZER = Tokenizer.from_file(vocab_path())


def plain(text, end):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [end]


def check(rows, source):
    order = sorted(range(len(source)), key=lambda i: (source[i][0] is not None, source[i][0] or 0))
    rows = sorted(rows, key=lambda r: r.start)
    at = 0
    for r, i in zip(rows, order, strict=True):
        ids = plain(source[i][1], 1)
        assert (r.doc_id, r.start, r.n_tokens) == (source[i][0], at, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_whole_table(mid):
    df, source = mid
    check(tf.token_index(df).collect(), source)


def test_edges(edge_docs, no_docs):
    from .conftest import ROWS

    check(tf.token_index(edge_docs).collect(), ROWS)
    assert tf.token_index(no_docs).count() == 0


def test_many_blocks_and_parts(spark, mid, tmp_path):
    df, source = mid
    path = str(tmp_path / "set")
    tf.write_token_files(df, path, block_ids=5000)
    assert spark.read.parquet(path + "/blocks").count() > 50
    check(tf.read_token_index(spark, path).collect(), source)
    texts = dict(source)
    for r in tf.read_token_ids(spark, path).filter("doc_id % 50 = 0").collect():
        assert r.ids == plain(texts[r.doc_id], 1)


def test_damaged_block_is_refused():
    ids = np.arange(100, dtype=np.uint32) % 7
    coder = tf.Coder(np.arange(7), tf.slot_counts(np.arange(7), np.bincount(ids)))
    payload = tf.pack_block(coder, np.array([3]), np.array([False]), np.array([100]), ids)
    keys, nulls, counts, back = tf.unpack_block(coder, payload, zlib.crc32(payload), 1, 100)
    assert (back == ids).all() and keys.tolist() == [3] and counts.tolist() == [100]
    with pytest.raises(ValueError):
        tf.unpack_block(coder, payload[:-1] + b"x", zlib.crc32(payload), 1, 100)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 60000), max_size=3000), st.integers(0, 3))
def test_coder_round_trip(ids, skew):
    ids = np.array(ids * (1 + skew), np.uint32)
    some, n = np.unique(ids, return_counts=True)
    slots = tf.slot_counts(some, n)
    assert slots.sum() in (0, 1 << tf.SLOT_BITS) and (slots > 0).all()
    if len(ids):
        coder = tf.Coder(some, slots)
        state, words = coder.encode(ids)
        assert (coder.decode(len(ids), state, words) == ids).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("abZ.,'é́İΣ \n\t  \x1c\x85-1漢<|endoftext|>"), max_size=40), max_size=6))
def test_word_wise_ids_are_the_library_ids(texts):
    table = WordTable(vocab_path(), max_words=20)
    for first, group in groups(pa.array(texts, pa.string()), 50):
        ids, counts = table.encode(group)
        for text, got in zip(group.to_pylist(), np.split(ids, np.cumsum(counts)[:-1]), strict=True):
            assert got.tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids
