"""Token output: ids against whole-text encoding, round trip, random access, odd rows."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from playtally.llm import op07_token_output as op
from playtally.llm.queries import QUERIES
from playtally.session import scratch_dir

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def encoder():
    return op.Encoder.load(op.default_tokenizer())


def whole(encoder, text):
    ids = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [op.END_ID]
    return np.array(ids, dtype="<u4").tobytes()


PARTS = st.sampled_from([" ", "\n", "  ", "\n\n", "\t", "\r\n", " ", " ", "a", "The", "don't", "é", "漢字", "1234",
                         "!!", "...", "<|endoftext|>", "\x1c", "\x85", "x" * 70, "\U0001f600", ""])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=9).map("".join), min_size=1, max_size=5))
def test_ids_equal_whole_text_encoding(texts):
    encoder = op.Encoder.load(op.default_tokenizer())
    assert encoder.encode(pa.array(texts, pa.string())) == [whole(encoder, t) for t in texts]


def expected(encoder, rows):
    start, out = 0, []
    for doc_id, text in rows:
        ids = whole(encoder, text)
        out.append((doc_id, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    return out


def test_query_matches_brute_force(spark, encoder):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r[c] for c in ("doc_id", "start", "n_tokens", "ids_crc32"))
                 for r in QUERIES["op7_token_output"](spark, SF).collect())
    assert got == expected(encoder, sorted((r.doc_id, r.text) for r in docs))


def test_odd_rows_small_blocks_and_random_access(spark, encoder):
    rows = [(3, None, "x"), (None, "null id", "x"), (1, "", "x"), (2, "word " * 5000, "x"), (7, "same", "x"), (7, "same", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part string").repartition(3)
    path = op.write_tokens(docs, scratch_dir(spark, "t7"), block_bytes=16)
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in op.read_tokens(spark, path).collect()),
                 key=lambda r: r[1])
    assert got == expected(encoder, sorted(((r[0], r[1]) for r in rows), key=lambda r: -1 if r[0] is None else r[0]))
    same = np.frombuffer(whole(encoder, "same"), dtype="<u4").tolist()
    assert op.read_document(spark, path, 7) == [same, same]
    assert op.read_document(spark, path, 99) == []


def test_pieces_are_remembered_and_replaced(encoder, monkeypatch):
    """More different pieces than the memory holds, over several batches: ids stay those of whole texts."""
    monkeypatch.setattr(op, "CACHE_PIECES", 50)
    for k in range(8):
        texts = [" ".join(f"w{j}x{j * k}\nl{j % 7}" for j in range(k, k + 30)), f"same words {k}", "é" * 70]
        assert encoder.encode(pa.array(texts)) == [whole(encoder, t) for t in texts]
        assert len(encoder.keys) == len(encoder.starts) == len(encoder.sizes) <= 50


def test_a_document_is_read_from_one_row_group(spark):
    import glob

    import pyarrow.parquet as pq

    docs = spark.createDataFrame([(i, " ".join(f"w{i * j % 99_991}" for j in range(60))) for i in range(300)],
                                 "doc_id long, text string")
    path = op.write_tokens(docs, scratch_dir(spark, "t7g"), block_bytes=2000)
    groups = []
    for name in glob.glob(f"{path.replace('file:', '')}/blocks/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = {meta.schema.column(c).path: c for c in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            low, high = (meta.row_group(g).column(at[c]).statistics for c in ("min_id", "max_id"))
            groups.append((low.min, high.max))
    assert len(groups) > 5 and sum(low <= 150 <= high for low, high in groups) == 1
    blocks = spark.read.schema(op.BLOCK_SCHEMA).parquet(f"{path}/blocks").filter("min_id <= 150 and max_id >= 150")
    assert "GreaterThanOrEqual(max_id,150)" in blocks._jdf.queryExecution().executedPlan().toString()
    assert len(op.read_document(spark, path, 150)) == 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert op.token_output(docs).collect() == []


def test_wrong_dictionary_is_refused(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    path = op.write_tokens(docs, scratch_dir(spark, "t7d"))
    spark.createDataFrame([("0" * 64, bytearray(b"x"))], "dict_sha256 string, dictionary binary") \
        .write.mode("overwrite").parquet(f"{path}/dictionary")
    with pytest.raises(ValueError):
        op.read_tokens(spark, path)
