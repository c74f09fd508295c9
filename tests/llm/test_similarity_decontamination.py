"""Jaccard join and decontamination against brute force, and odd rows."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from fixtures import no_documents, odd_documents

from playtally.llm import graph
from playtally.llm import op03_jaccard_join as join
from playtally.llm import op04_decontamination as leaks
from playtally.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def brute_components(rows, width=4, percent=85):
    """(doc_id, set size, smallest reachable doc_id) per row, over all pairs."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        sets.append({tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    node = list(range(len(rows)))

    def find(i):
        while node[i] != i:
            i = node[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            same_id = rows[i][0] is not None and rows[i][0] == rows[j][0]
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) or same_id:
                node[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return Counter((rows[i][0], len(sets[i]), least.get(find(i)) if sets[i] else rows[i][0]) for i in range(len(rows)))


def components_of(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def near_copies():
    """Families of near copies, chains, a passage shared by many, short texts around the threshold."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 6)))
    rows, passage = [], [word() for _ in range(40)]
    for family in range(12):
        text = [word() for _ in range(rng.choice([6, 7, 8, 20, 60, 150]))]
        if family % 3 == 0:
            text = text[:10] + passage + text[10:]
        for _ in range(14):
            copy = list(text)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy).title() if rng.random() < 0.2 else "\n".join(copy))
            if rng.random() < 0.3:
                text = copy  # a chain: copies of copies
    rng.shuffle(rows)
    return [(3 * i + 1, t) for i, t in enumerate(rows)]


def test_components_equal_all_pairs(spark):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert components_of(join.similar_documents(docs)) == brute_components(rows)


def test_query_on_the_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert components_of(QUERIES["op3_jaccard_join"](spark, SF)) == brute_components(rows)


def test_join_odd_rows(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert components_of(join.similar_documents(docs)) == brute_components(rows)
    kept = join.keep_one_per_component(docs)
    assert kept.columns == docs.columns
    got = Counter(r.doc_id for r in kept.collect())
    assert got == Counter({1: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1, 9: 1, 11: 1, 12: 1, 13: 1, None: 2})
    assert join.similar_documents(no_documents(spark)).collect() == []


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100)}


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def brute_hits(text, items, window=10):
    w, hit, found, longest = bench_words(text), set(), set(), 0
    for name, item in items:
        b = bench_words(item)
        n = min(window, len(b))
        for j in range(len(b) - n + 1 if n else 0):
            for i in range(len(w) - n + 1):
                if w[i:i + n] == b[j:j + n]:
                    hit |= set(range(i, i + n))
                    found.add(name)
                    k = n
                    while i + k < len(w) and j + k < len(b) and w[i + k] == b[j + k]:
                        k += 1
                    longest = max(longest, k)
    return len(w), len(hit), sorted(x for x in found if x is not None), longest


def leak_rows():
    rng = random.Random(9)
    word = lambda: rng.choice(["the", "of", "é", "x1", "Zoë", "word", "漢字", "b", "cc"])
    items = [(str(i), " ".join(word() for _ in range(n))) for i, n in enumerate([40, 10, 12, 9, 3, 0, 25])]
    items += [("7", items[0][1][:80]), ("0", "again other words here"), (None, " ".join(word() for _ in range(11)))]
    texts = [" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(40)]
    for _ in range(25):
        w = items[rng.randrange(len(items))][1].split()
        a = rng.randint(0, 3)
        texts.append(f"{word()}, {' - '.join(w[a:a + rng.randint(5, 40)]).upper() if rng.random() < .5 else ' '.join(w)}! {word()}")
    return [*texts, None, "", "  ", "plain " * 400], items


def test_matches_equal_brute_force_in_any_blocks(spark):
    texts, items = leak_rows()
    docs = spark.createDataFrame([(i, t, 3) for i, t in enumerate(texts)], "doc_id long, text string, n_words long")
    bench = spark.createDataFrame([(n, t, "x") for n, t in items], "item_id string, text string, match string")
    for block_bytes in (1 << 20, 60):
        found = leaks.match_documents(docs.repartition(3), bench, block_bytes=block_bytes)
        for r in found.select("doc.doc_id", "doc.text", "match.*").collect():
            assert (r.n_words, r.n_hit, list(r["items"]), r.longest) == brute_hits(r.text, items), r.doc_id
            if r.longest:
                w, b = bench_words(r.text), [x for x in items if x[0] == r.longest_item]
                part = w[r.longest_start:r.longest_start + r.longest]
                assert any(part == bench_words(t)[j:j + r.longest] for _, t in b for j in range(len(bench_words(t))))


def test_leaks_odd_rows_and_empty_tables(spark):
    docs = odd_documents(spark)
    bench = spark.createDataFrame([(1, "beta gamma delta epsilon zeta eta theta iota kappa lambda"), (2, None), (3, "")],
                                  "item_id long, text string")
    kept = leaks.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([4, 5, 6, 7, 8, 9, 11, 12, 13, None])
    assert leaks.remove_contaminated(docs, bench.limit(0)).count() == docs.count()
    assert leaks.contamination(no_documents(spark), bench).collect() == []


def test_suffix_array_is_sorted_to_its_depth():
    rng = np.random.default_rng(3)
    ids, edges = rng.integers(0, 3, 300).astype(np.uint64), np.array([0, 0, 100, 101, 300])
    order, ends = leaks.suffix_array(ids, edges)
    keys = [tuple(ids[i:min(i + leaks.DEPTH, ends[i])]) for i in order]
    assert keys == sorted(keys)


def test_small_shards_cover_every_text(spark):
    texts = pa.array(["a b", "", "c" * 50, "d"], pa.string())
    from playtally.llm.textscan import shards
    assert [x for s in shards(texts, 4) for x in s.to_pylist()] == texts.to_pylist()


def test_links_inside_a_family_are_all_counted(spark, monkeypatch):
    """A family of near copies: every member's links against all pairs, with one block and with many."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(25):
        own = list(words)
        for at in rng.choice(120, 1 + i % 3, replace=False):
            own[at] = f"x{i}y{at}"
        rows.append((i, " ".join(own)))
    rows.append((99, rows[3][1]))
    sets = {t: {tuple(t.split()[k:k + 4]) for k in range(117)} for _, t in rows}
    want = {i: sum(t != u and 100 * len(sets[t] & sets[u]) >= 85 * len(sets[t] | sets[u]) for u in sets) for i, t in rows}
    assert sum(want.values()) > 100
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for size in (2048, 4):
        monkeypatch.setattr(join, "BLOCK_SETS", size)
        assert {r.doc_id: r.n_links for r in join.similar_documents(table).collect()} == want


def test_shared_windows_and_repeats_do_not_multiply():
    """3,000 items with one instruction against a text that repeats it 10,000 times, in one process
    of its own: time, memory and result."""
    import json
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
import json, resource, sys, time
sys.path.insert(0, {root!r})
import pyarrow as pa
from playtally.llm import op04_decontamination as op
instruction = "answer the question below with one of the four given letters only"
items = op.Benchmark([str(i) for i in range(3000)], [f"{{instruction}} item{{i}} asks number{{i}}" for i in range(3000)])
text = f"{{instruction}} " * 10_000 + f"{{instruction}} item7 asks another thing"
before, start = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.process_time()
row = items.matches(pa.array([text, "nothing here"]), [None, None]).to_pylist()
print(json.dumps([time.process_time() - start, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024,
                  len(row[0]["items"]), row[0]["n_hit"], row[0]["n_words"], row[0]["longest"], row[0]["longest_item"],
                  row[0]["spans"], row[1]["n_hit"]]))
"""
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    seconds, mb, *got = json.loads(said.stdout)
    assert got == [3000, 120_014, 120_016, 14, "7", [0, 120_014], 0]
    assert seconds < 6 and mb < 500


def test_word_ids_do_not_depend_on_the_step(monkeypatch):
    """Ids by running sums over small and large steps, words longer than a step, against a plain sum."""
    from playtally.llm import textscan

    rng = random.Random(9)
    texts = ["", "a", " a", "a ", "x" * 700 + " y", "  "] + [
        "".join(rng.choices("aB \n\té", k=rng.randint(0, 40))) for _ in range(300)]
    want, power = [], [[pow(int(b), i, 1 << 64) for i in range(701)] for b in textscan._BASES]
    for word in re.findall(r"[^\x20\x09-\x0D]+", lower("\n".join(texts))):
        value, raw = 0, word.encode()
        for table in power:
            total = sum((byte + 1) * table[i] for i, byte in enumerate(raw)) % (1 << 64)
            value = (int(textscan.mix(np.array([value ^ total], np.uint64))[0]) + len(raw)) % (1 << 64)
        want.append(value)
    for step in (1 << 17, 64):
        monkeypatch.setattr(textscan, "_STEP", step)
        textscan._powers.cache_clear()
        ids, edges = textscan.scan_words(pa.array(texts), textscan.NOT_SPACE)
        assert ids.tolist() == want and edges[-1] == len(want)
    textscan._powers.cache_clear()


def test_cells_hold_many_shingles():
    """A part's rows of packed shingles with the part counts of 30 GB and of 1 TB of text."""
    rng = np.random.default_rng(4)
    size = join.PART_BYTES // 4
    letters = rng.integers(97, 123, size, dtype=np.uint8)
    letters[rng.random(size) < 1 / 5.5] = 32
    texts = [letters[i:i + 4000].tobytes().decode() for i in range(0, size, 4000)]
    part = pa.table({"doc_id": range(len(texts)), "text": texts, "part": [3] * len(texts)})
    for parts in (1280, 42_000):
        rows = join._blobs(parts, 4)([pa.scalar(3)], part)
        shingles = sum(len(x.as_py()) for x in rows["low"]) // 4
        assert rows["bucket"].to_pylist() == sorted(set(rows["bucket"].to_pylist()))
        assert shingles / len(rows) * 4 >= 85  # a quarter of a part
    # Each once, or twice where several texts hold it.
    twice = pa.table({"doc_id": [1, 2, 3, 4], "text": ["a b c d", "a b c d", "a b c d e", None], "part": [0] * 4})
    rows = join._blobs(2, 4)([pa.scalar(0)], twice)
    assert sum(len(x.as_py()) for x in rows["low"]) // 4 == 3


def test_a_family_beside_one_more_text(spark):
    """Second meeting: a stray set that shares shingles with a large family, and families that meet
    over a hub that links with neither, against all pairs."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(40):
        own = list(base)
        own[rng.randrange(60)] = f"x{i}"
        rows.append((i + 10, " ".join(own)))
    rows.append((1, " ".join(base[:12])))                                   # shares shingles, links with none
    rows.append((2, " ".join(base[:56] + [f"y{k}" for k in range(4)])))     # links with some
    rows += [(100 + i, " ".join(base[:50] + [f"z{k}" for k in range(10)] + [f"q{i}"])) for i in range(10)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert components_of(join.similar_documents(table)) == brute_components(rows)


def test_large_components_are_salted(spark, monkeypatch):
    monkeypatch.setattr(join, "HOT_COMPONENT", 3)
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert components_of(join.similar_documents(docs)) == brute_components(rows)
