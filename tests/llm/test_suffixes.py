"""Suffix arrays and common prefixes against sorting."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from playtally.llm import suffixes


def check(pieces):
    joined = b"\x01".join(pieces) + b"\x01\x00"
    text = np.frombuffer(joined, np.uint8)
    order = suffixes.suffix_array(text)
    assert order.tolist() == sorted(range(len(joined)), key=lambda i: joined[i:])
    ends = np.flatnonzero(text == 1)
    room = np.append(ends[np.searchsorted(ends, np.arange(len(text) - 1))], len(text) - 1) - np.arange(len(text))
    got = suffixes.permuted_lcp(text, order, room)
    for a, b in zip(order[:-1], order[1:], strict=True):
        n = 0
        while joined[a + n] == joined[b + n]:
            n += 1
        assert got[b] == min(n, room[b])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.binary(max_size=30).map(lambda b: bytes(2 + x % 3 for x in b)), min_size=1, max_size=6))
def test_few_letters(pieces):
    check(pieces)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=60).map(lambda t: bytes(b + 2 for b in t.encode())), min_size=1, max_size=4))
def test_texts(pieces):
    check(pieces)


@pytest.mark.parametrize("piece", [b"", b"a", b"a" * 700, b"ab" * 350, b"abc" * 200 + b"abd" * 50, b"ba" * 300 + b"a" * 90])
def test_runs_and_periods(piece):
    check([piece])
    check([piece, piece, piece[1:]])


def test_recursion_over_many_names():
    rng = np.random.default_rng(5)
    words = [bytes(rng.integers(97, 123, rng.integers(2, 9)).tolist()) for _ in range(300)]
    some = b" ".join(words[k] for k in rng.integers(0, 300, 3000))
    check([some, some[500:4000], some[::-1]])
