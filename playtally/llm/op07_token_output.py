"""Token ids in a compressed binary format with short-document access.

Format, one folder:

* ``dictionary`` (Parquet, one row): the shared zstandard dictionary and its
  SHA-256;
* ``blocks`` (Parquet): documents in ascending doc_id order. A row is a block of
  about ``block_bytes``, in a row group of its own: ``part, block`` (the order),
  ``min_id, max_id`` (of its documents), ``data`` (one zstandard
  frame per document, end to end; a frame holds the document's ids as
  little-endian unsigned 32-bit integers), the offset index ``doc_ids, offsets,
  n_tokens`` (frame ``i`` is ``data[offsets[i]:offsets[i + 1]]``), ``start_in_part``
  (ids of the part before the block) and ``dict_sha256``.

``read_document`` opens the row groups whose ``min_id`` and ``max_id`` statistics
allow the doc_id and decompresses one frame. ``read_tokens`` reads everything back.

Steps. The dictionary is trained on a bounded sample (``DICT_DOCS`` documents
chosen by id hash, the first ``DICT_DOC_BYTES`` of each id array); it is a
compression aid only, every document is encoded whole. Rows are range
partitioned on (doc_id, text hash) with an explicit count, so a part is a
contiguous doc_id range, and one task writes a part's blocks in order. Ids
before a part come from a running sum over one row per part.

Encoding repeats no work per word: a batch is split at single spaces and line
breaks, where this byte-level vocabulary always starts a new token, distinct
pieces are encoded once, and id arrays are put together by array gathers. Texts
with other runs of white space (where a token may span the split) or with special
tokens' strings are encoded whole by the same tokenizer, so ids always equal those of the whole text.

Defined results: null and empty texts hold the end id alone. Documents order by
doc_id, nulls first, repeated ids by text hash. Extra columns are not read. An
empty table gives an empty file set and no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playtally.llm.common import share_package, shuffle_width
from playtally.session import scratch_dir

END_ID = 2
DICT_BYTES = 64 * 1024
DICT_DOCS = 1024            # documents the dictionary is trained on, at most about
DICT_DOC_BYTES = 64 * 1024  # of each such document's id array
LEVEL = 3
BLOCK_BYTES = 1 << 20
SLICE_BYTES = 6 << 20       # text handled at once inside a task
CACHE_PIECES = 600_000      # pieces whose ids a Python worker remembers

# White space at the start or before a split point, other than the one safe pattern ("\n\n").
_SPACE = r"\t-\r \x1c-\x1f\x{85}\p{Z}"
_UNSAFE = rf"\A[{_SPACE}]|[{_SPACE}] |[\t\x0b-\r \x1c-\x1f\x{{85}}\p{{Z}}]\n|\n\n[{_SPACE}]|\n\n\z"
# A piece with white space at an edge (but for the line break that it may start with), or nothing else.
_RAGGED = rf"\A\n?\z|\A\n[{_SPACE}]|\A[\t\x0b-\r \x1c-\x1f\x{{85}}\p{{Z}}]|[{_SPACE}]\z"

BLOCK_SCHEMA = ("part int, block int, min_id bigint, max_id bigint, start_in_part bigint, doc_ids array<bigint>, offsets array<bigint>, "
                "n_tokens array<bigint>, data binary, dict_sha256 string")
TOKEN_SCHEMA = "part int, doc_id bigint, start_in_part bigint, n_tokens bigint, ids_crc32 bigint"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Texts to serialized id arrays (little-endian unsigned 32-bit, end id last)."""

    _loaded: dict[str, Encoder] = {}

    @classmethod
    def load(cls, path: str) -> Encoder:
        """One per worker process and vocabulary file, so remembered pieces outlive a task."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Remembered pieces, and their ids: where they begin in ``flat`` and how many they are.
        self.keys = pa.array([], pa.string())
        self.flat, self.starts, self.sizes = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.newline = self._whole("\n")
        # Added tokens cut a text before white space is looked at: such texts go whole, too.
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.unsafe = "|".join([_UNSAFE, *added])

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of every text plus the end id. ``texts`` has no nulls."""
        end = np.array([END_ID], dtype="<u4").tobytes()
        unsafe = np.asarray(pc.match_substring_regex(texts, self.unsafe).to_numpy(zero_copy_only=False), dtype=bool)
        out: list[bytes] = [b""] * len(texts)
        for i in np.flatnonzero(unsafe):
            out[i] = self._whole(texts[int(i)].as_py()) + end
        plain = np.flatnonzero(~unsafe)
        if len(plain):
            for i, ids in zip(plain, self._by_piece(texts.take(pa.array(plain))), strict=True):
                out[i] = ids + end
        return out

    def _by_piece(self, texts: pa.Array) -> list[bytes]:
        # "\n" + text, with a space before each line break: pieces then start at a space
        # (dropped by the split) or at a line break, the first with one that is not the text's.
        marked = pc.binary_join_element_wise(
            pa.scalar("\n"), pc.replace_substring(texts, pattern="\n", replacement=" \n"), "")
        lists = pc.split_pattern(marked, " ")
        bounds = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        which = coded.indices.to_numpy()
        flat, starts, sizes = self._pieces(coded.dictionary)
        n = sizes[which]
        ends = np.cumsum(n)
        gather = np.repeat(starts[which] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
        ids = flat[gather]
        first = len(self.newline) // 4
        edges = np.concatenate(([0], ends))[bounds]
        return [ids[a + first:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of different pieces: an array of ids, and where each piece's begin in it and how many
        they are. Known pieces are looked up, the others encoded and remembered; when there are too
        many, only those of this batch stay."""
        at = pc.fill_null(pc.index_in(pieces, value_set=self.keys), -1).to_numpy()
        new = np.flatnonzero(at < 0)
        flat, starts, sizes = self._encode_new(pieces.take(pa.array(new)))
        all_starts = np.empty(len(pieces), np.int64)
        all_sizes = np.empty(len(pieces), np.int64)
        held = np.flatnonzero(at >= 0)
        all_starts[held], all_sizes[held] = self.starts[at[held]], self.sizes[at[held]]
        all_starts[new], all_sizes[new] = starts + len(self.flat), sizes
        ids = np.concatenate((self.flat, flat))
        short = pc.less(pc.binary_length(pieces), 64).to_numpy(zero_copy_only=False)
        if len(self.keys) + len(new) <= CACHE_PIECES:
            more, keys = new[short[new]], [self.keys]
            self.starts, self.sizes = [np.concatenate((x, y[more])) for x, y in ((self.starts, all_starts), (self.sizes, all_sizes))]
            self.flat = ids
        else:
            more, keys = np.flatnonzero(short)[:CACHE_PIECES], []
            n = all_sizes[more]
            ends = np.cumsum(n)
            self.flat = ids[np.repeat(all_starts[more] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
            self.starts, self.sizes = ends - n, n
        self.keys = pa.concat_arrays([*keys, pieces.take(pa.array(more))])
        return ids, all_starts, all_sizes

    def _encode_new(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As :meth:`_pieces`, each piece's ids as inside a text. One call encodes many, a line break
        after each: the break is one token there and occurs inside a piece's ids only where the piece
        starts with it. A piece that has white space at an edge would run into its neighbours'
        breaks: alone."""
        starts, sizes = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        parts, used = [np.zeros(0, "<u4")], 0
        lone = pc.match_substring_regex(pieces, _RAGGED).to_numpy(zero_copy_only=False).astype(bool)
        breaks_own = pc.starts_with(pieces, "\n").to_numpy(zero_copy_only=False).astype(np.int64)
        lead = pc.if_else(pc.starts_with(pieces, "\n"), "", " ")
        inside = pc.binary_join_element_wise(lead, pieces, "")
        rest = np.flatnonzero(~lone)
        alone = np.flatnonzero(lone).tolist()
        for at in range(0, len(rest), 4096):
            some = rest[at:at + 4096]
            joined = "\n".join([*inside.take(pa.array(some)).to_pylist(), ""])
            flat = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype="<u4")
            breaks = np.flatnonzero(flat == np.frombuffer(self.newline, dtype="<u4")[0])
            own = breaks_own[some]
            if len(self.newline) != 4 or len(breaks) != own.sum() + len(some):
                alone.extend(some.tolist())
                continue
            stops = breaks[np.cumsum(own + 1) - 1]
            begins = np.concatenate(([0], stops[:-1] + 1))
            starts[some], sizes[some] = begins + used, stops - begins
            parts.append(flat)
            used += len(flat)
        for i in alone:
            flat = np.frombuffer(self._whole(inside[i].as_py()), dtype="<u4")
            starts[i], sizes[i] = used, len(flat)
            parts.append(flat)
            used += len(flat)
        return np.concatenate(parts), starts, sizes


def _slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive parts of ``texts`` of about SLICE_BYTES."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        base = sizes[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(sizes, base + SLICE_BYTES, side="right")))
        yield at, texts.slice(at, stop - at)
        at = stop


def train_dictionary(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> bytes:
    """The shared dictionary, from a bounded sample of documents chosen by id hash."""
    share_package(docs.sparkSession)
    n = docs.count()
    if not n:
        return b""
    share = min(1.0, DICT_DOCS / n)
    key = F.xxhash64(F.col(doc_id)).bitwiseAND(F.lit((1 << 40) - 1))
    sample = docs.filter(key < int(share * (1 << 40))).select(F.col(text).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.load(path)
        for batch in batches:
            for _, texts in _slices(pc.fill_null(batch["text"], "")):
                ids = [x[:DICT_DOC_BYTES] for x in encoder.encode(texts)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], names=["ids"])

    samples = sorted(r.ids for r in sample.mapInArrow(encode, "ids binary").limit(2 * DICT_DOCS).collect())
    samples = [bytes(x) for x in samples]
    size = min(DICT_BYTES, sum(map(len, samples)) // 8)
    if len(samples) >= 16 and size >= 1024:
        return zstandard.train_dictionary(size, samples).as_bytes()
    return b"".join(samples)[:DICT_BYTES]  # too little to train on: raw content


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, doc_id: str = "doc_id",
                 text: str = "text", block_bytes: int = BLOCK_BYTES) -> str:
    """Encode ``docs`` and write the format's files below ``path``."""
    spark = docs.sparkSession
    vocabulary = tokenizer or default_tokenizer()
    raw = train_dictionary(docs, vocabulary, doc_id, text)
    digest = hashlib.sha256(raw).hexdigest()
    spark.createDataFrame([(digest, bytearray(raw))], "dict_sha256 string, dictionary binary") \
        .coalesce(1).write.parquet(f"{path}/dictionary")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, words = Encoder.load(vocabulary), _dictionary(raw)
        compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=words).compress
        part = TaskContext.get().partitionId()
        block, start, ids, frames, counts, held = 0, 0, [], [], [], 0

        def flush() -> pa.RecordBatch:
            offsets = np.concatenate(([0], np.cumsum([len(f) for f in frames]))).astype(np.int64)
            named = [i for i in ids if i is not None]
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int32()),
                "min_id": pa.array([min(named, default=None)], pa.int64()),
                "max_id": pa.array([max(named, default=None)], pa.int64()),
                "start_in_part": pa.array([start], pa.int64()), "doc_ids": pa.array([ids], pa.list_(pa.int64())),
                "offsets": pa.array([offsets], pa.list_(pa.int64())),
                "n_tokens": pa.array([counts], pa.list_(pa.int64())),
                "data": pa.array([b"".join(frames)], pa.binary()), "dict_sha256": pa.array([digest])})

        for batch in batches:
            names = batch["doc_id"].to_pylist()
            for at, texts in _slices(pc.fill_null(batch["text"], "")):
                for name, serial in zip(names[at:at + len(texts)], encoder.encode(texts), strict=True):
                    frame = compress(serial)
                    ids.append(name)
                    frames.append(frame)
                    counts.append(len(serial) // 4)
                    held += len(frame)
                    if held >= block_bytes:
                        yield flush()
                        start, block, ids, frames, counts, held = start + sum(counts), block + 1, [], [], [], 0
        if ids:
            yield flush()

    slim = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    (slim.repartitionByRange(shuffle_width(spark), F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
     .mapInArrow(pack, BLOCK_SCHEMA)
     # A row group for each block, so that a reader of one document opens one.
     .write.option("compression", "uncompressed").option("parquet.block.row.count.limit", 1)
     .parquet(f"{path}/blocks"))
    return path


def _dictionary_of(spark: SparkSession, path: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    raw = bytes(row.dictionary)
    if hashlib.sha256(raw).hexdigest() != row.dict_sha256:
        raise ValueError("the dictionary does not match its hash")
    return row.dict_sha256, raw


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document, from the files."""
    digest, raw = _dictionary_of(spark, path)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = zstandard.ZstdDecompressor(dict_data=_dictionary(raw)).decompress
        for batch in batches:
            for row in batch.to_pylist():
                if row["dict_sha256"] != digest:
                    raise ValueError(f"block {row['part']}/{row['block']} needs another dictionary")
                data, offsets = memoryview(row["data"]), row["offsets"]
                serial = [decompress(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                counts = np.array([len(x) // 4 for x in serial], dtype=np.int64)
                if counts.tolist() != row["n_tokens"]:
                    raise ValueError(f"block {row['part']}/{row['block']} does not match its index")
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([row["part"]] * len(counts), pa.int32()),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "start_in_part": pa.array(row["start_in_part"] + np.cumsum(counts) - counts, pa.int64()),
                    "n_tokens": pa.array(counts), "ids_crc32": pa.array([zlib.crc32(x) for x in serial], pa.int64())})

    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    # One row per part: as many as the write had tasks.
    parts = blocks.groupBy("part").agg(
        F.sum(F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("_n"))
    before = parts.select("part", F.coalesce(F.sum("_n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return (blocks.mapInArrow(unpack, TOKEN_SCHEMA).join(before, "part")
            .select("doc_id", (F.col("_before") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32"))


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """Ids of the rows with this doc_id: the blocks whose id range holds it are read, and only its
    frames decompressed."""
    _, raw = _dictionary_of(spark, path)
    decompress = zstandard.ZstdDecompressor(dict_data=_dictionary(raw)).decompress
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks").filter(
        (F.col("min_id") <= doc_id) & (F.col("max_id") >= doc_id))
    hits = blocks.select("part", "block", F.posexplode("doc_ids").alias("i", "id"), "offsets", "data") \
        .filter(F.col("id") == doc_id).select(
            "part", "block", "i", F.expr("substring(data, cast(offsets[i] + 1 as int), "
                                         "cast(offsets[i + 1] - offsets[i] as int))").alias("frame"))
    return [np.frombuffer(decompress(bytes(r.frame)), dtype="<u4").tolist()
            for r in hits.orderBy("part", "block", "i").collect()]


def token_output(docs: DataFrame, tokenizer: str | None = None, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Write ``docs`` to a fresh folder in the shared store and read the files back."""
    spark = docs.sparkSession
    return read_tokens(spark, write_tokens(docs, scratch_dir(spark, "tokens"), tokenizer, doc_id, text))
