import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from postweave.llm import pfor, token_files
from postweave.llm.batches import file_uri
from postweave.llm.token_files import FileReader, PieceEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=1)
def piece_encoder():
    return PieceEncoder(PATH)


@lru_cache(maxsize=1)
def library():
    """The plain library: a special token's name in a text is that token."""
    return Tokenizer.from_file(PATH)


def plain(texts, end=2):
    tokenizer = library()
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [end] for t in texts]


def expected(rows):
    out, start = [], 0
    for (doc_id, _), ids in zip(rows, plain([t for _, t in rows])):
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
@pytest.mark.parametrize("top", [0, 1, 50_000, 2**32 - 1])
def test_blocks_round_trip(n, top):
    values = np.random.default_rng(n).integers(0, top + 1, n, dtype=np.uint64).astype(np.uint32)
    values[::37] = top
    heads, body = pfor.pack(values)
    assert (pfor.unpack(heads, body)[:n] == values).all()


def test_outliers_become_exceptions():
    values = np.full(256, 1000, np.uint32)
    values[:8] = 4_000_000_000
    heads, body = pfor.pack(values)
    assert heads["width"][0] == 0 and heads["exceptions"][0] == 8 and len(body) == 40
    assert (pfor.unpack(heads, body) == values).all()


spaced = st.lists(st.sampled_from([" ", "  ", "\n", "\t ", " \n", " ", " ", "a", "it's", "Zé", "12", "!?", "\0", "<|endoftext|>", "\x1c"]))


@settings(max_examples=300, deadline=None)
@given(st.lists(spaced.map("".join), max_size=4))
def test_pieces_give_the_ids_of_whole_texts(texts):
    ids, counts = piece_encoder().encode(pa.array(texts, pa.string()))
    assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])][: len(texts)] == plain(texts)


def test_memory_of_pieces_is_bounded():
    encoder = PieceEncoder(PATH, memory=10)
    for text in ("one two three four five six seven", "a b c d e f g h i j k l m", "one two three"):
        assert encoder.encode(pa.array([text]))[0].tolist() == plain([text])[0]


def test_whole_table(spark, small):
    rows = sorted((r.doc_id, r.text) for r in small.collect())
    found = token_files.tokenized(small, PATH)
    assert sorted(tuple(r) for r in found.collect()) == expected(rows)


def test_awkward_rows(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    found = [tuple(r) for r in token_files.tokenized(awkward, PATH).collect()]
    assert len(found) == len(rows)
    sizes = sorted((r[0] is not None, r[0] or 0, n) for r, n in zip(rows, map(len, plain([t for _, t in rows]))))
    assert sorted((f[0] is not None, f[0] or 0, f[2]) for f in found) == sizes
    by_start = sorted(found, key=lambda f: f[1])
    assert [f[1] for f in by_start] == [sum(x[2] for x in by_start[:k]) for k in range(len(by_start))]
    assert [f[0] for f in by_start] == sorted((f[0] for f in found), key=lambda d: (d is not None, d or 0))


def test_no_rows(nothing):
    assert token_files.tokenized(nothing, PATH).collect() == []


def test_random_access(spark, documents, tmp_path):
    rows = [(k, f"text number {k} " * (k % 50)) for k in range(300)]
    manifest = token_files.write_token_files(documents(rows).coalesce(1), PATH, str(tmp_path)).collect()
    ids = dict(zip((d for d, _ in rows), plain([t for _, t in rows])))
    for m in manifest:
        reader = FileReader(m.file)
        docs = reader.docs.to_pylist()
        for d in docs[::7]:
            assert reader.ids(d["first"], d["count"]).tolist() == ids[d["doc_id"]]


@pytest.mark.parametrize("special_as_text", [False, True])
def test_names_of_special_tokens(special_as_text):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = special_as_text
    texts = ["<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>b c", "x  <|endoftext|>  y", "<|endoftext|> <|endoftext|>", "no <|end of|> it"]
    ids, counts = PieceEncoder(PATH, special_as_text=special_as_text).encode(pa.array(texts))
    expected = [e.ids + [2] for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == list(map(len, expected)) and ids.tolist() == sum(expected, [])


def test_folders_of_tasks_are_those_of_spark(spark):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    try:
        conf.set("fs.defaultFS", "hdfs://names:8020")
        assert file_uri(spark, "/ckpt/a b") == "hdfs://names:8020/ckpt/a b"
        conf.set("fs.defaultFS", "file:///")
        assert file_uri(spark, "/ckpt/x") == "file:///ckpt/x"
    finally:
        conf.set("fs.defaultFS", before)
    assert file_uri(spark, "file:/ckpt/x") == file_uri(spark, "file:///ckpt/x") == "file:///ckpt/x"
    assert file_uri(spark, "s3a://bucket/x") == "s3://bucket/x"
    with pytest.raises(ValueError):
        file_uri(spark, "wasb://c/x")
