"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

A suffix is S-type if it is smaller than the next one, else L-type; an S-type suffix after
an L-type one is a *leftmost* S suffix. Those are sorted first: their substrings (up to the
next one) are put in order by one induction, equal ones share a name, and where names
repeat the shorter string of names is sorted the same way. One more induction then places
every suffix from the sorted leftmost ones, L-types from the left, S-types from the right.

An induction scans an order that it fills ahead of itself. Here it scans in batches, each up
to the first place that is still open: what a batch induces is one stable sort of its
preceding letters, and runs of equal letters follow in closed form. Over a byte alphabet
the batches are the buckets; over the wide alphabet of names they grow with the square
root of the places scanned.

Common prefixes with the suffix next in order are computed in text order. Where the
letters before both suffixes agree the value is the last one less one, so only the other
positions are compared, eight letters at a time.
"""

from __future__ import annotations

import numpy as np

_FEW_LETTERS = 1024


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes of ``text``: small non-negative integers, of which the last is 0 and
    the only 0."""
    return _sort(text, int(text.max()) + 1)


def _sort(text: np.ndarray, letters: int) -> np.ndarray:
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    change = np.flatnonzero(text[:-1] != text[1:])           # the last of each run of equal letters
    length = np.diff(change, prepend=-1)
    s_type = np.append(np.repeat(text[change] < text[change + 1], length), True)
    run = np.append(np.repeat(change - length + 1, length), n - 1)
    leftmost = np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1
    sizes = np.bincount(text, minlength=letters)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    if letters <= _FEW_LETTERS or letters * 400 < n:
        l_sizes = np.bincount(text[~s_type], minlength=letters)

        def induce(seeds: np.ndarray) -> np.ndarray:
            return _induce_buckets(text, starts, l_sizes, run, seeds)
    else:
        l_sizes = np.bincount(text[~s_type], minlength=letters)

        def induce(seeds: np.ndarray) -> np.ndarray:
            return _induce_batches(text, starts, l_sizes, run, seeds, change)

    is_leftmost = np.zeros(n, bool)
    is_leftmost[leftmost] = True
    order = induce(leftmost)
    order = order[is_leftmost[order]]
    rank = np.empty(n, np.int64)
    rank[order] = _names(text, order, leftmost)
    names = rank[leftmost]
    kinds = int(names.max()) + 1
    if kinds < len(leftmost):
        order = leftmost[_sort(names, kinds)]
    return induce(order)


def _names(text: np.ndarray, order: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """A number for each sorted leftmost substring, equal ones the same."""
    size = np.empty(len(text), np.int64)
    size[leftmost] = np.diff(leftmost, append=len(text) - 1) + 1
    size[leftmost[-1]] = 1
    a, b = order[:-1], order[1:]
    same = size[a] == size[b]
    open_, at = np.flatnonzero(same), 0
    while len(open_):
        open_ = open_[at < size[a[open_]]]
        differ = text[a[open_] + at] != text[b[open_] + at]
        same[open_[differ]] = False
        open_, at = open_[~differ], at + 1
    return np.concatenate(([0], np.cumsum(~same)))


def _run_members(last: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Positions before ``last`` in their runs of equal letters: all nearest ones first, each round
    in the order of ``last``."""
    depth = last - run[last]
    total = int(depth.sum())
    if not total:
        return last[:0]
    number = np.repeat(np.arange(len(last)), depth)
    back = np.arange(total) - np.repeat(np.cumsum(depth) - depth, depth) + 1
    by = np.argsort(back, kind="stable")
    return last[number[by]] - back[by]


def _induce_buckets(text, starts, l_sizes, run, seeds) -> np.ndarray:
    letters = len(l_sizes)
    out = np.empty(len(text), np.int64)
    by = np.argsort(text[seeds], kind="stable")
    seeds = seeds[by]
    seed_at = np.searchsorted(text[seeds], np.arange(letters + 1))
    present = np.flatnonzero(np.diff(starts)).tolist()
    put = starts[:-1].copy()
    for c in present:
        done = out[starts[c]:put[c]]
        more = _run_members(done, run)
        out[put[c]:put[c] + len(more)] = more
        before = np.concatenate((done, more, seeds[seed_at[c]:seed_at[c + 1]])) - 1
        before = before[before >= 0]
        letter = text[before]
        held = letter > c
        before, letter = before[held], letter[held]
        by = np.argsort(letter, kind="stable")
        count = np.bincount(letter, minlength=letters)
        letter = letter[by]
        out[(put - (np.cumsum(count) - count))[letter] + np.arange(len(by))] = before[by]
        put += count
    put = starts[1:].copy()
    out[0] = len(text) - 1
    put[0] = 0
    for c in reversed(present[1:]):
        done = out[put[c]:starts[c + 1]][::-1]
        more = _run_members(done, run)
        out[put[c] - len(more):put[c]] = more[::-1]
        before = np.concatenate((done, more, out[starts[c]:starts[c] + l_sizes[c]][::-1])) - 1
        before = before[before >= 0]
        letter = text[before]
        held = letter < c
        before, letter = before[held], letter[held]
        by = np.argsort(letter, kind="stable")
        count = np.bincount(letter, minlength=letters)
        letter = letter[by]
        out[(put + (np.cumsum(count) - count))[letter] - 1 - np.arange(len(by))] = before[by]
        put -= count
    return out


def _next_open(put: np.ndarray, end: np.ndarray, first: int, step: int) -> int:
    """The next bucket from ``first`` on, going by ``step``, with open places; beyond the last if
    there is none. Looks at growing windows."""
    width = 256
    while 0 <= first < len(put):
        window = slice(first, first + width) if step > 0 else slice(max(0, first - width + 1), first + 1)
        hit = np.flatnonzero(put[window] != end[window])
        if len(hit):
            return first + int(hit[0]) if step > 0 else window.start + int(hit[-1])
        first = min(first + width, len(put)) if step > 0 else window.start - 1
        width *= 4
    return first


def _induce_batches(text, starts, l_sizes, run, seeds, change) -> np.ndarray:
    n, letters = len(text), len(l_sizes)
    l_end = starts[:-1] + l_sizes
    falls = text[change] > text[change + 1]
    # Members of runs of equal letters that the next letter places; the others follow from those.
    l_first = np.bincount(text[change[falls]], minlength=letters)
    s_first = np.bincount(text[change[~falls]], minlength=letters)
    out = np.full(n, -1, np.int64)
    by = np.argsort(text[seeds], kind="stable")
    letter = text[seeds[by]]
    out[starts[letter + 1] - np.searchsorted(letter, letter, side="right") + np.arange(len(by))] = seeds[by]

    def place(before: np.ndarray, put: np.ndarray, step: int) -> np.ndarray:
        """The letters that got suffixes."""
        letter = text[before]
        by = np.argsort(letter, kind="stable")
        letter = letter[by]
        head = np.flatnonzero(np.concatenate(([True], letter[1:] != letter[:-1])))
        count = np.diff(head, append=len(by))
        rank = np.arange(len(by)) - np.repeat(head, count)
        out[put[letter] + step * rank if step > 0 else put[letter] - 1 - rank] = before[by]
        put[letter[head]] += step * count
        return letter[head]

    put, at, bucket = starts[:-1].copy(), 0, 0
    while at < n:
        bucket = _next_open(put, l_end, bucket, 1)
        stop = int(put[bucket]) if bucket < letters else n
        before = out[at:stop]
        before = before[before > 0]
        before = before[text[before - 1] > text[before]] - 1
        at = stop
        if len(before):
            got = place(before, put, 1)
            for c in got[(put[got] == starts[got] + l_first[got]) & (l_sizes[got] > l_first[got])].tolist():
                more = _run_members(out[starts[c]:put[c]], run)
                out[put[c]:put[c] + len(more)] = more
                put[c] += len(more)
    put, at, bucket = starts[1:].copy(), n, letters - 1
    out[0], put[0] = n - 1, 0
    while at > 0:
        bucket = _next_open(put, l_end, bucket, -1)
        stop = int(put[bucket]) if bucket >= 0 else 0
        before = out[stop:at][::-1]
        before = before[before > 0]
        before = before[text[before - 1] < text[before]] - 1
        at = stop
        if len(before):
            got = place(before, put, -1)
            ends = starts[got + 1]
            for c in got[(put[got] == ends - s_first[got]) & (ends - l_end[got] > s_first[got])].tolist():
                more = _run_members(out[put[c]:starts[c + 1]][::-1], run)
                out[put[c] - len(more):put[c]] = more[::-1]
                put[c] -= len(more)
    return out


def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes that start at each position, as one integer (zeros beyond the end)."""
    data = text.tobytes() + bytes(16)
    out = np.empty(len(text), np.uint64)
    for k in range(8):
        part = out[k::8]
        part[:] = np.frombuffer(data, "<u8", count=len(part), offset=k)
    return out


def permuted_lcp(text: np.ndarray, order: np.ndarray, room: np.ndarray) -> np.ndarray:
    """For each position of the bytes ``text``, how long a prefix its suffix shares with the one
    before it in ``order``, at most ``room`` (the letters up to the end of its own piece, so
    ``room`` falls by one from each position to the next inside a piece)."""
    n = len(text)
    near = np.empty(n, np.int64)
    near[order[1:]] = order[:-1]
    near[order[0]] = -1
    direct = (near <= 0)
    direct[0] = True
    inside = np.flatnonzero(~direct)
    direct[inside] = (text[inside - 1] != text[near[inside] - 1]) | (room[inside - 1] != room[inside] + 1)
    value = np.zeros(n, np.int64)
    words = words_at(text)
    at = np.flatnonzero(direct & (near >= 0))
    same = 0
    while len(at):
        x = words[at + same] ^ words[near[at] + same]
        low = np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)) >> 3     # equal bytes, 8 if all are
        value[at] += np.where(x == 0, 8, low)
        at = at[(x == 0) & (value[at] < room[at])]
        same += 8
    last = np.maximum.accumulate(np.where(direct, np.arange(n), 0))
    return np.minimum(value[last] - (np.arange(n) - last), room)
