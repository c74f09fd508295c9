"""Cross-tokenizer alignment: which tokens of one tokenizer cover which of another.

Tokenizer A encodes a space and the text, B the text (it adds the space itself), so both
cut the same bytes. Per batch of texts, ``pandas.merge_asof`` keyed by document finds for
each token start the other side's covering token (the last one that starts at or before
it). The union of both directions is the set of overlapping token pairs; byte offsets
where tokens of both sides end cut the document into groups.

A pair of ids counts in how many documents it is linked, and each link is compared with
the highest count of its A id, so a document's row needs counts of the whole corpus:

1. Tasks encode and align their documents once and write them, as *parts* of about
   ``PART_BYTES`` of text: per batch the documents' figures and their distinct pairs with
   multiplicities (as numbers into the part's own list of pairs), and that list, cut into
   buckets by pair hash, with the documents that hold each. A part's name is its task's
   number in that write, so what was committed is consistent whichever attempt wrote it.
2. A bucket's task adds the parts' counts and answers each part. A pair that every
   document holds costs one entry a part. The highest count of each A id is a table of
   one row an id: the vocabulary bounds it, and it goes to all tasks.
3. A part's batches meet its answers and give the documents' rows. Texts are encoded once
   and never shuffled.

Tokenizer A runs in tiktoken on the vocabulary of the JSON file where its merges stand in
id order (then both give the same ids), else in the tokenizers library.

Defined results: null, empty and undecodable texts (the joined bytes of A or B are not
those of space and text) have no tokens: zeros, and an empty ``groups`` text, whose digest
column is empty, too. Each row is aligned and counted by itself: repeated rows and equal
ids count as documents of their own. A null doc_id stays null. Special tokens' strings in
a text are plain text. Extra columns are not read. Empty table: no rows.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtally.llm.common import share_package, shuffle_width
from playtally.llm.textscan import mix, shards
from playtally.session import materialize

BATCH_BYTES = 2 << 20    # text aligned at once inside a task
PART_BYTES = 32 << 20    # text of a part, about
BUCKET_BYTES = 1 << 30   # corpus text for each pair bucket

_ID_BITS = 20            # ids below a million
_PAIR_BITS = 2 * _ID_BITS
_FIGURES = ("n_a", "n_b", "n_groups", "n_links")

PART_SCHEMA = ("part bigint, bucket int, doc_ids array<bigint>, " + ", ".join(f"{c} array<bigint>" for c in _FIGURES)
               + ", groups_sha256 array<string>, groups array<string>, held array<bigint>, numbers binary, "
               "times binary, pairs binary, docs binary")
ANSWER_SCHEMA = "part bigint, pairs binary, docs binary"
ROW_SCHEMA = ("doc_id bigint, " + ", ".join(f"{c} bigint" for c in _FIGURES)
              + ", n_best bigint, count_sum bigint, groups_sha256 string, groups string")


def squeeze(values: np.ndarray) -> bytes:
    """Non-negative integers, small: bytes of equal weight side by side, under zstandard."""
    raw = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(len(values), 8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(raw.T).tobytes())


def expand(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<u8").reshape(-1).astype(np.int64)


def _byte_of_letter() -> dict[str, int]:
    """The byte-level alphabet: printable bytes are themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    _loaded: dict[tuple[str, str], Tokenizers] = {}

    @classmethod
    def load(cls, paths: tuple[str, str]) -> Tokenizers:
        """One a worker process and pair of files."""
        if paths not in cls._loaded:
            cls._loaded[paths] = cls(*paths)
        return cls._loaded[paths]

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path_a)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        letters = _byte_of_letter()
        with open(path_a, encoding="utf-8") as file:
            model = json.load(file)["model"]
        special = {t.content for t in self.library.get_added_tokens_decoder().values()}
        ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        tokens_a = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            tokens_a[i] = token
        self.bytes_a = pa.array(tokens_a, pa.large_binary())
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        self.fast = None
        if merged == sorted(merged):
            import public_tokenizers

            self.fast = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = pa.array([self._piece(i) for i in range(self.sp.get_piece_size())], pa.large_binary())
        size = max(len(self.bytes_a), len(self.bytes_b))
        if size > 1 << _ID_BITS:
            raise ValueError("vocabularies are limited to a million ids")
        # An id's decimal text before a comma, a bar, a semicolon, and nothing.
        self.decimal = pa.array([f"{i}{end}".encode() for end in (",", "|", ";", "") for i in range(size)], pa.large_binary())
        self.size = size

    def _piece(self, i: int) -> bytes:
        piece = self.sp.id_to_piece(i)
        if self.sp.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        # Control and unknown pieces stand for no bytes of a text: a byte that UTF-8 never has.
        return b"\xff" if self.sp.is_control(i) or self.sp.is_unknown(i) else piece.replace("▁", " ").encode()

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        if self.fast is not None:
            return [self.fast.encode_ordinary(" " + t) for t in texts]
        return [e.ids for e in self.library.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        return self.sp.encode(texts, num_threads=1)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    edges = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64)
    return np.concatenate([np.zeros(0, np.int64), *(np.array(x, np.int64) for x in lists)]), edges


def _starts(table: pa.Array, ids: np.ndarray) -> tuple[np.ndarray, memoryview]:
    """Byte offsets of consecutive tokens (one entry more), and their joined bytes."""
    taken = table.take(pa.array(ids))
    offsets = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset:taken.offset + len(taken) + 1]
    data = memoryview(taken.buffers()[2]).cast("B") if len(taken) and taken.buffers()[2] is not None else memoryview(b"")
    return offsets, data


def _covering(left: pd.DataFrame, right: pd.DataFrame) -> np.ndarray:
    """For each token of ``left``, the number of the token of ``right`` that covers its start."""
    return pd.merge_asof(left[["start", "doc"]], right, on="start", by="doc")["number"].to_numpy()


class Aligned:
    """One batch of texts: per-document figures, distinct pairs and canonical group texts."""

    def __init__(self, texts: list[str], tok: Tokenizers):
        n = len(texts)
        lists_a, lists_b = tok.encode_a(texts), tok.encode_b(texts)
        (ids_a, cut_a), (ids_b, cut_b) = _flat(lists_a), _flat(lists_b)
        raw_a, raw_b = _starts(tok.bytes_a, ids_a), _starts(tok.bytes_b, ids_b)
        good = np.zeros(n, bool)
        for i, text in enumerate(texts):
            want = b" " + text.encode()
            good[i] = bool(text) and all(
                data[offsets[cut[i]]:offsets[cut[i + 1]]] == want for (offsets, data), cut in ((raw_a, cut_a), (raw_b, cut_b)))
        size = np.where(good, np.diff(raw_a[0][cut_a]), 0)
        base = np.cumsum(size) - size
        sides = []
        for ids, cut, (offsets, _) in ((ids_a, cut_a, raw_a), (ids_b, cut_b, raw_b)):
            doc = np.repeat(np.arange(n), np.diff(cut))
            keep = good[doc]
            start = (offsets[:-1] - offsets[cut[:-1]][doc] + base[doc])[keep] if len(doc) else np.zeros(0, np.int64)
            end = (offsets[1:] - offsets[cut[:-1]][doc] + base[doc])[keep] if len(doc) else np.zeros(0, np.int64)
            sides.append((ids[keep], doc[keep], start, end))
        (self.a, doc_a, start_a, end_a), (self.b, doc_b, start_b, end_b) = sides
        frame_a = pd.DataFrame({"start": start_a, "doc": doc_a, "number": np.arange(len(self.a))})
        frame_b = pd.DataFrame({"start": start_b, "doc": doc_b, "number": np.arange(len(self.b))})
        over_a = _covering(frame_a, frame_b).astype(np.int64)          # each A token's start lies in this B token
        over_b = _covering(frame_b, frame_a).astype(np.int64)
        new = start_a[over_b] != start_b                               # equal starts were found from A's side
        self.link_a = np.concatenate((np.arange(len(self.a)), over_b[new]))
        self.link_b = np.concatenate((over_a, np.flatnonzero(new)))
        link_doc = np.concatenate((doc_a, doc_b[new]))
        self.n_a, self.n_b = np.bincount(doc_a, minlength=n), np.bincount(doc_b, minlength=n)
        self.n_links = np.bincount(link_doc, minlength=n)
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        is_cut = end_a == cuts[group_a] if len(cuts) else np.zeros(0, bool)
        self.n_groups = np.bincount(doc_a[is_cut], minlength=n)
        self.texts = self._group_texts(tok, group_a, group_b, doc_a, doc_b, good)
        # Distinct pairs of each document and how often each is linked.
        key = np.sort((link_doc << _PAIR_BITS) | (self.a[self.link_a] << _ID_BITS) | self.b[self.link_b])
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        self.times = np.diff(np.append(first, len(key)))
        self.pairs = key[first] & ((1 << _PAIR_BITS) - 1)
        self.held = np.bincount(key[first] >> _PAIR_BITS, minlength=n)

    def compact(self, keep_groups: bool) -> Aligned:
        """Without what a part does not need of its batches (all its tokens and texts)."""
        self.digests = [hashlib.sha256(t).hexdigest() if t else "" for t in self.texts]
        del self.link_a, self.link_b, self.a, self.b
        if not keep_groups:
            del self.texts
        self.times = self.times.astype(np.int32)
        return self

    def _group_texts(self, tok, group_a, group_b, doc_a, doc_b, good) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of every document (empty without tokens)."""
        total = len(self.a) + len(self.b)
        code, doc = np.zeros(total, np.int64), np.zeros(total, np.int64)
        at_a = np.arange(len(self.a)) + np.searchsorted(group_b, group_a, side="left")
        at_b = np.arange(len(self.b)) + np.searchsorted(group_a, group_b, side="right")
        end_a = np.append(group_a[1:] != group_a[:-1], True)[:len(self.a)]
        end_b = np.append(group_b[1:] != group_b[:-1], True)[:len(self.b)]
        last_b = np.append(doc_b[1:] != doc_b[:-1], True)[:len(self.b)]
        code[at_a] = self.a + tok.size * end_a
        code[at_b] = self.b + tok.size * np.where(last_b, 3, 2 * end_b)
        doc[at_a], doc[at_b] = doc_a, doc_b
        offsets, data = _starts(tok.decimal, code)
        edges = offsets[np.searchsorted(doc, np.arange(len(good) + 1))]
        return [bytes(data[edges[i]:edges[i + 1]]) for i in range(len(good))]


def _bucket(pairs: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(pairs.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _batch(columns: dict, rows: int) -> pa.RecordBatch:
    """``PART_SCHEMA`` rows from some of its columns; the others are null."""
    arrays, types = [], {
        "part": pa.int64(), "bucket": pa.int32(), "doc_ids": pa.list_(pa.int64()), **{c: pa.list_(pa.int64()) for c in _FIGURES},
        "groups_sha256": pa.list_(pa.string()), "groups": pa.list_(pa.string()), "held": pa.list_(pa.int64()),
        "numbers": pa.binary(), "times": pa.binary(), "pairs": pa.binary(), "docs": pa.binary()}
    for name, kind in types.items():
        arrays.append(pa.array(columns[name], kind) if name in columns else pa.nulls(rows, kind))
    return pa.RecordBatch.from_arrays(arrays, names=list(types))


def _write_parts(paths: tuple[str, str], buckets: int, keep_groups: bool, part_bytes: int, batch_bytes: int) -> Callable:
    """``doc_id, text`` to PART_SCHEMA: batches of documents (bucket null) and the part's pair lists."""

    def finish(part: int, done: list) -> Iterator[pa.RecordBatch]:
        every, docs = np.unique(np.concatenate([a.pairs for _, a in done]), return_counts=True)
        for ids, a in done:
            row = {"part": [part], "doc_ids": [ids], "held": [a.held], "numbers": [squeeze(np.searchsorted(every, a.pairs))],
                   "times": [squeeze(a.times)], "groups_sha256": [a.digests], **{c: [getattr(a, c)] for c in _FIGURES}}
            if keep_groups:
                row["groups"] = [[t.decode() for t in a.texts]]
            yield _batch(row, 1)
        bucket = _bucket(every, buckets)
        by = np.argsort(bucket, kind="stable")
        held, first = np.unique(bucket[by], return_index=True)
        cells = np.split(by, first[1:]) if len(by) else []
        if cells:
            yield _batch({"part": [part] * len(held), "bucket": held, "pairs": [squeeze(every[c]) for c in cells],
                          "docs": [squeeze(docs[c]) for c in cells]}, len(held))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = Tokenizers.load(paths)
        part, size, done = TaskContext.get().partitionId() << 32, 0, []
        for batch in batches:
            ids, texts, at = batch["doc_id"], pc.fill_null(batch["text"], ""), 0
            for piece in shards(texts, batch_bytes):
                done.append((ids.slice(at, len(piece)), Aligned(piece.to_pylist(), tok).compact(keep_groups)))
                at += len(piece)
                size += pc.sum(pc.binary_length(piece)).as_py() or 0
                if size >= part_bytes:
                    yield from finish(part, done)
                    part, size, done = part + 1, 0, []
        if done:
            yield from finish(part, done)

    return write


def _count(table: pa.Table) -> pa.Table:
    """A bucket's counts over all parts: one answer a part, and at part -1 each A id's highest."""
    pairs = [expand(v) for v in table["pairs"].to_pylist()]
    docs = np.concatenate([expand(v) for v in table["docs"].to_pylist()])
    every, number = np.unique(np.concatenate(pairs), return_inverse=True)
    total = np.zeros(len(every), np.int64)
    np.add.at(total, number, docs)
    edges = np.cumsum([len(p) for p in pairs])[:-1]
    answers = [squeeze(total[n]) for n in np.split(number, edges)]
    ids, first = np.unique(every >> _ID_BITS, return_index=True)
    best = np.maximum.reduceat(total, first)
    return pa.table({
        "part": pa.array([*table["part"].to_pylist(), -1], pa.int64()),
        "pairs": pa.array([*table["pairs"].to_pylist(), squeeze(ids)], pa.binary()),
        "docs": pa.array([*answers, squeeze(best)], pa.binary())})


def _decode_answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, docs in zip(batch["pairs"].to_pylist(), batch["docs"].to_pylist(), strict=True):
            yield pa.RecordBatch.from_pydict({"id": pa.array(expand(ids)), "docs": pa.array(expand(docs))})


def _score(best: np.ndarray) -> Callable:
    """A part's batches and its answers to ROW_SCHEMA."""

    def score(batches: pa.Table, answers: pa.Table) -> pa.Table:
        pairs = np.concatenate([np.zeros(0, np.int64), *(expand(v) for v in answers["pairs"].to_pylist())])
        total = np.concatenate([np.zeros(0, np.int64), *(expand(v) for v in answers["docs"].to_pylist())])
        by = np.argsort(pairs)
        pairs, total = pairs[by], total[by]
        is_best = total == best[pairs >> _ID_BITS]
        out: dict[str, list] = {name: [] for name in (*_FIGURES, "doc_id", "groups_sha256", "groups", "n_best", "count_sum")}
        for row in batches.select(["doc_ids", *_FIGURES, "groups_sha256", "groups", "held", "numbers", "times"]).to_pylist():
            number, times = expand(row["numbers"]), expand(row["times"])
            edges = np.concatenate(([0], np.cumsum(row["held"]))).astype(np.int64)
            for name, value in (("n_best", times * is_best[number]), ("count_sum", times * total[number])):
                out[name].extend(np.diff(np.concatenate(([0], np.cumsum(value)))[edges]).tolist())
            out["doc_id"].extend(row["doc_ids"])
            for name in (*_FIGURES, "groups_sha256"):
                out[name].extend(row[name])
            out["groups"].extend(row["groups"] or [None] * len(row["doc_ids"]))
        kinds = {"groups_sha256": pa.string(), "groups": pa.string()}
        names = [c.split()[0] for c in ROW_SCHEMA.split(", ")]
        return pa.table({name: pa.array(out[name], kinds.get(name, pa.int64())) for name in names})

    return score


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def write_parts(docs: DataFrame, paths: tuple[str, str] | None = None, keep_groups: bool = False,
                part_bytes: int = PART_BYTES, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Encode and align every document once; the stored parts (PART_SCHEMA)."""
    spark = docs.sparkSession
    share_package(spark)
    text_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(shuffle_width(spark), -(-text_bytes // BUCKET_BYTES))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return materialize(rows.mapInArrow(_write_parts(paths or default_paths(), buckets, keep_groups, part_bytes, batch_bytes),
                                       PART_SCHEMA), "alignment-parts")


def pair_counts(parts: DataFrame) -> DataFrame:
    """``part, pairs, docs`` answers of every bucket (stored): corpus-wide document counts of the
    parts' pairs, and at part -1 the highest counts of A ids."""
    lists = parts.filter("bucket is not null").select("part", "bucket", "pairs", "docs")
    return materialize(lists.groupBy("bucket").applyInArrow(_count, ANSWER_SCHEMA), "pair-counts")


def align(docs: DataFrame, paths: tuple[str, str] | None = None, keep_groups: bool = False,
          part_bytes: int = PART_BYTES, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """ROW_SCHEMA, one row per document; ``groups`` is null unless ``keep_groups``."""
    parts = write_parts(docs, paths, keep_groups, part_bytes, batch_bytes)
    answers = pair_counts(parts)
    # One row an A id, so the vocabulary (a million ids at most) bounds what is collected.
    highest = (answers.filter("part = -1").mapInArrow(_decode_answers, "id bigint, docs bigint")
               .groupBy("id").agg(F.max("docs").alias("docs")).collect())
    best = np.zeros(max((r["id"] for r in highest), default=0) + 1, np.int64)
    for r in highest:
        best[r["id"]] = r["docs"]
    batches = parts.filter("bucket is null").drop("bucket", "pairs", "docs")
    return (batches.groupBy("part").cogroup(answers.filter("part >= 0").groupBy("part"))
            .applyInArrow(_score(best), ROW_SCHEMA))
