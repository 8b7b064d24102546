"""Token files against whole-text encoding, look-ups, and odd rows."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from showroom.llm import token_files as tf

PATH = public_tokenizers.path("byte_bpe_50k.json")
SPACES = " \t\n\r\x0b\x0c\x1c\x85\xa0     　"


def pieces():
    return tf.Pieces(tf._tokenizer(PATH), np.uint16, tf.END)


def whole(texts):
    return [x.ids + [tf.END] for x in tf._tokenizer(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.one_of(st.sampled_from(SPACES + "aZé×÷ñ's'll9!<|*.,…"), st.characters(codec="utf-8")), max_size=40)), max_size=6))
def test_pieces_encode_as_whole_texts(texts):
    ids, starts = tf.encode(pa.array(texts, pa.string()), pieces())
    assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == whole(texts)


def test_special_strings_are_text():
    texts = ["a<|endoftext|>b", " <|endoftext|>"]
    ids, starts = tf.encode(pa.array(texts), pieces())
    assert 50256 not in ids and [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == whole(texts)


def test_a_forgotten_piece_is_encoded_again(monkeypatch):
    monkeypatch.setattr(tf, "REMEMBERED", 3)
    known = pieces()
    for texts in (["a b c d"], ["c d e f"], ["a b"]):
        ids, _ = tf.encode(pa.array(texts), known)
        assert ids.tolist() == whole(texts)[0]


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).integers(-(2**62), 2**62, n * 2)
    keys = np.unique(keys)[:n]
    index = tf.PerfectHash.build(keys)
    assert sorted(index.find(keys).tolist()) == list(range(n))
    assert len(index.bits) * 64 <= 12 * n + 64 * 64


def expected(rows):
    ids = whole([t for _, t in rows])
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    out, start = [], 0
    for i in order:
        out.append((rows[i][0], start, len(ids[i]), zlib.crc32(np.array(ids[i], "<u4").tobytes())))
        start += len(ids[i])
    return out


def test_files_hold_every_document(spark, make, tmp_path):
    rows = [(i * 7 % 101 - 20, f"text {i} é\n\n of {i % 5}" * (i % 9)) for i in range(101)] + [(500, None), (501, ""), (502, "x " * 300_000)]
    docs = make([(k, t, 1) for k, t in rows], "doc_id bigint, text string, start int")
    out = tf.tokenize(docs, PATH, f"file://{tmp_path}/a", shard_bytes=500)
    assert out.select("shard").distinct().count() > 3
    got = sorted(map(tuple, out.drop("shard").collect()))
    assert got == sorted(expected(rows))


def test_equal_keys_missing_keys_and_unknown_keys(spark, make, tmp_path):
    rows = [(3, "c"), (1, "a"), (1, "b b"), (1, "a"), (None, "n"), (None, None), (2, "")]
    shards = tf.write(make(rows, "doc_id bigint, text string"), PATH, str(tmp_path))
    assert [tuple(r) for r in shards.collect()] == [(0, 7, sum(len(x) for x in whole([t for _, t in rows])))]
    shard = tf.Shard(str(tmp_path), 0)
    place, copies = shard.find(np.array([1, 2, 3, 0, 99, -5]))
    assert copies.tolist() == [3, 1, 1, 0, 0, 0] and place[3:].tolist() == [-1, -1, -1]
    assert shard.ids(place[2]).tolist() == whole(["c"])[0]
    got = sorted(map(str, (tuple(r)[:1] + tuple(r)[2:4] for r in tf.read(spark, str(tmp_path), shards).collect())))
    assert got == sorted(str((k, len(i), zlib.crc32(np.array(i, "<u4").tobytes()))) for (k, _), i in zip(rows, whole([t for _, t in rows])))


def test_lookup_over_all_files(spark, make, tmp_path):
    """Rows of one key that lie in several files are all found, with the places that read() gives."""
    rows = [(i, f"text {i}") for i in range(40)] + [(20, f"same key, other text {i} " * 9) for i in range(200)] + [(None, "n"), (50, "")]
    shards = tf.write(make(rows, "doc_id bigint, text string"), PATH, str(tmp_path), shard_bytes=2_000)
    read = tf.read(spark, str(tmp_path), shards).collect()
    assert len({r.shard for r in read if r.doc_id == 20}) > 1
    keys = make([(20, 1), (20, 2), (3, 3), (50, 4), (77, 5), (-1, 6), (None, 7)], "k bigint, ids int")
    got = tf.lookup(keys, str(tmp_path), "k").collect()
    want = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32, r.shard) for r in read if r.doc_id in (20, 3, 50)]
    assert sorted((r.doc_id, r.start, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()), r.shard) for r in got) == sorted(want)
    assert sorted(r.ids for r in got) == sorted(whole([t for k, t in rows if k in (20, 3, 50)]))
    assert tf.lookup(keys.limit(0), str(tmp_path), "k").count() == 0


def test_no_documents(spark, make):
    assert tf.tokenize(make([], "doc_id bigint, text string"), PATH).count() == 0
