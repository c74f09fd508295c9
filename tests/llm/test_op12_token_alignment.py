"""Alignment: against a brute-force version over all token pairs, odd texts, small parts."""

import hashlib
from collections import Counter

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fixtures import no_documents, odd_documents
from playtally.llm import op12_token_alignment as op
from playtally.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
PATH_A, PATH_B = op.default_paths()
A = Tokenizer.from_file(PATH_A)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
LETTERS = op._byte_of_letter()


def tokens(text):
    """``(id, bytes)`` of both sides, straight from the libraries, or two empty lists."""
    a = A.encode(" " + text, add_special_tokens=False).ids if text else []
    b = B.encode(text) if text else []
    a = [(i, bytes(LETTERS[c] for c in A.id_to_token(i))) for i in a]
    b = [(i, bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode())
         for i in b]
    want = b" " + text.encode() if text else b""
    if not text or any(b"".join(t for _, t in side) != want for side in (a, b)):
        return [], []
    return a, b


def links_and_groups(a, b):
    def spans(side):
        at, out = 0, []
        for i, t in side:
            out.append((i, at, at + len(t)))
            at += len(t)
        return out

    a, b = spans(a), spans(b)
    links, first = [], 0
    for i, s, e in a:
        while first < len(b) and b[first][2] <= s:
            first += 1
        j = first
        while j < len(b) and b[j][1] < e:
            links.append((i, b[j][0]))
            j += 1
    groups, x, y = [], 0, 0
    for cut in sorted({e for *_, e in a} & {e for *_, e in b}):
        left, right = [], []
        while x < len(a) and a[x][2] <= cut:
            left.append(str(a[x][0]))
            x += 1
        while y < len(b) and b[y][2] <= cut:
            right.append(str(b[y][0]))
            y += 1
        groups.append(",".join(left) + "|" + ",".join(right))
    return links, groups


def brute(rows):
    found, count = [], Counter()
    for doc_id, text in rows:
        a, b = tokens(text)
        links, groups = links_and_groups(a, b)
        count.update(set(links))
        found.append((doc_id, len(a), len(b), links, groups))
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    return sorted(((d, na, nb, len(g), len(k), sum(count[p] == best[p[0]] for p in k), sum(count[p] for p in k),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for d, na, nb, k, g in found), key=repr)


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op12_token_alignment"](spark, SF)
    assert got.columns == COLUMNS
    assert rows_of(got) == brute([(r.doc_id, r.text) for r in docs])


def test_odd_rows_over_small_parts(spark):
    docs = odd_documents(spark)
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    for part_bytes, batch_bytes in ((1, 1), (600, 300), (1 << 20, 1 << 20)):
        got = op.align(docs, part_bytes=part_bytes, batch_bytes=batch_bytes)
        assert rows_of(got.select(COLUMNS)) == want


def test_groups_as_text(spark):
    docs = spark.createDataFrame([(1, "Unbelievable tokenization!")], "doc_id long, text string")
    row = op.align(docs, keep_groups=True).first()
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256
    assert row.groups == ";".join(links_and_groups(*tokens("Unbelievable tokenization!"))[1])


def test_empty_table(spark):
    assert op.align(no_documents(spark)).collect() == []
    lone = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert rows_of(op.align(lone).select(COLUMNS)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


PIECES = st.sampled_from([" ", "  ", "\n", "\t", "\r\n", " ", "▁", "<0x41>", "<s>", "<unk>", "<|endoftext|>", "é", "漢字",
                          "\U0001f600", "\x00", "\x1c", "ﬁ", "é", "don't", "The", "1234", "...", "x" * 60, "﻿", ""])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=8).map("".join), min_size=1, max_size=4))
def test_alignment_of_odd_texts(texts):
    aligned = op.Aligned(texts, op.Tokenizers.load((PATH_A, PATH_B)))
    at = 0
    for k, text in enumerate(texts):
        a, b = tokens(text)
        links, groups = links_and_groups(a, b)
        assert (aligned.n_a[k], aligned.n_b[k], aligned.n_groups[k], aligned.n_links[k]) == (len(a), len(b), len(groups), len(links))
        assert aligned.texts[k].decode() == ";".join(groups)
        held = slice(at, at + aligned.held[k])
        got = {(int(p) >> 20, int(p) & 0xFFFFF): int(t) for p, t in zip(aligned.pairs[held], aligned.times[held], strict=True)}
        assert got == Counter(links)
        at += aligned.held[k]


@pytest.mark.parametrize("text", ["a" * 300_000, " " * 300_000, "é\n" * 100_000])
def test_long_runs(text):
    aligned = op.Aligned([text, "x"], op.Tokenizers.load((PATH_A, PATH_B)))
    a, b = tokens(text)
    assert (aligned.n_a[0], aligned.n_b[0]) == (len(a), len(b)) and aligned.n_a[1] == 1
