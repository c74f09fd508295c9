"""Quality rules, mixing and the WARC archive: SQL or brute force, and odd rows."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from fixtures import no_documents, odd_documents
from oracle_check import compare, duck

from playtally.llm import op02_quality_rules as rules
from playtally.llm import op05_warc as warc
from playtally.llm import op08_mixing as mixing
from playtally.llm.queries import ORACLES, QUERIES
from playtally.session import scratch_dir

SF = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    ok, n, _, detail = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert ok, detail
    assert n > 0


def measured(text):
    text = text or ""
    words, lines = re.findall(WORD, text), [x for x in text.split("\n") if re.search(WORD, x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    cover = {p for i, w in enumerate(windows) if w in often for p in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(cover))


def test_ledger_measures_odd_rows(spark):
    docs = odd_documents(spark)
    got = Counter((r.doc_id, *(r[m] for m in rules.MEASURES[:5]), r.base_failed)
                  for r in rules.apply_policy(rules.ledger(docs)).collect())
    want = Counter()
    for r in docs.collect():
        m = measured(r.text)
        want[(r.doc_id, *m, m[0] < 50 or 100 * m[4] > 50 * m[0])] += 1
    assert got == want
    assert rules.ledger(no_documents(spark)).collect() == []


def test_keep_documents_returns_the_rows_a_policy_keeps(spark):
    docs = odd_documents(spark)
    open_policy = rules.Policy("no_symbols", 1, ("symbol_density",))
    kept = rules.keep_documents(docs, open_policy)
    assert kept.columns == docs.columns
    base_ok = {r.doc_id for r in rules.apply_policy(rules.ledger(docs), open_policy).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == base_ok


def test_ablation_equals_counting_rows(spark):
    book = rules.ledger(spark.read.parquet(f"{SF}/documents.parquet"))
    masks = [r.failures for r in book.collect()]
    got = {r.rule: (r.n_failed, r.n_only) for r in rules.ablation(book).collect()}
    for i, rule in enumerate(rules.RULES):
        assert got[rule] == (sum(bool(m & (1 << i)) for m in masks), sum(m == 1 << i for m in masks))


def filled(sizes, weights, most=3):
    """Iterated resharing of the excess."""
    total, target, open_ = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    rest = float(total)
    while open_:
        share = rest / sum(weights[i] for i in open_)
        over = {i for i in open_ if most * sizes[i] < weights[i] * share}
        if not over:
            for i in open_:
                target[i] = weights[i] * share
            break
        for i in over:
            target[i] = float(most * sizes[i])
            rest -= target[i]
        open_ -= over
    return target


def check_mix(docs, tolerance):
    rows = docs.collect()
    mix = mixing.plan_mix(docs, block_words=300, shard_words=1500)
    got = mixing.taken_words(mix).collect()
    size = lambda t: len(re.findall(WORD, t or ""))
    per = defaultdict(int)
    for r in rows:
        per[r.source] += size(r.text)
    names = sorted(per, key=lambda s: (s is None, s or ""))
    targets = dict(zip(names, filled([per[s] for s in names], [(1, 2, 3)[i % 3] for i in range(len(names))]), strict=True))
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((r.doc_id, size(r.text)) for r in rows)
    assert all(r.taken <= 3 * r["size"] for r in got)
    by_target = defaultdict(int)
    for r in got:
        by_target[round(r.target, 6)] += r.taken
    want = defaultdict(float)
    for s in names:
        want[round(targets[s], 6)] += targets[s]
    assert set(by_target) == set(want)
    for t, n in want.items():
        assert abs(by_target[t] - n) <= tolerance, (t, n, by_target[t])
    assert mix.draws.count() == mix.draws.select("source", "pass", "block").distinct().count()
    assert mix.draws.count() == (mix.sources.agg({"quota": "sum"}).first()[0] or 0)
    out = mixing.mixed_documents(docs, mix)
    assert out.columns == docs.columns
    assert out.count() == sum(r.copies for r in got)
    again = mixing.taken_words(mixing.plan_mix(docs, block_words=300, shard_words=1500)).collect()
    assert Counter(got) == Counter(again)


def test_mix_of_a_table(spark):
    check_mix(spark.read.parquet(f"{SF}/documents.parquet"), 700)


def test_mix_of_odd_rows(spark):
    check_mix(odd_documents(spark), 30_000)
    assert mixing.mix_documents(no_documents(spark)).collect() == []


def test_quotas_add_up_and_follow_the_hypergeometric_mean(spark):
    quotas = spark.createDataFrame([("a", 3000), ("b", 1000), (None, 40), ("z", 0)], "source string, quota long")
    rows = mixing.split_quotas(quotas, 7).collect()
    total = defaultdict(int)
    for r in rows:
        total[r.source] += r.past - r.first
        if r.source == "a":
            assert abs((r.past - r.first) - 3000 / 7) < 60
    assert dict(total) == {"a": 3000, "b": 1000, None: 40, "z": 0}
    shards = defaultdict(int)
    for r in rows:
        shards[r.shard] += r.past - r.first
    assert max(shards.values()) - min(shards.values()) <= 3


PAGES = [(4, "http://x/4", "<p>" + "same " * 40), (2, "http://x/2", "<p>" + "same " * 40), (9, None, "short"),
         (8, "u\r\nInjected: 1", "short"), (5, "http://x/5", None), (None, "http://x/n", "<p>" + "same " * 40),
         (2, "http://x/2", "<p>" + "same " * 40), (7, "http://x/7", "é\r\n\r\n" * 50), (6, "http://x/6", "")]


def test_archive_records_are_exact(spark):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, digest string")
    path = warc.write_archive(pages, scratch_dir(spark, "warc"))
    got = Counter(tuple(r) for r in warc.read_archive(spark, path).collect())
    want = Counter()
    for i, _, h in PAGES:
        raw = (h or "").encode()
        first = min((j for j, _, g in PAGES if (g or "") == (h or "") and j is not None), default=None)
        response = len(raw) < 100 or i == first
        want[(i, len(raw), hashlib.sha256(raw).hexdigest(), "response" if response else "revisit",
              None if response else first)] += 1
    assert got == want
    assert spark.read.parquet(f"{path}/payloads").count() == len({h or "" for _, _, h in PAGES})
    for r in warc.records(spark, path).collect():
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and block.endswith(b"\r\n\r\n")
        assert len(block) - 4 == int(fields["Content-Length"])
        http, _, payload = block[:-4].partition(b"\r\n\r\n")
        assert payload == (bytes(r.payload) if fields["WARC-Type"] == "response" else b"")
        assert fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(bytes(r.payload)).hexdigest()
        assert "Injected" not in fields


def test_archive_refuses_changed_payloads_and_takes_no_pages(spark):
    pages = spark.createDataFrame(PAGES[:2], "page_id long, url string, html string")
    path = warc.write_archive(pages, scratch_dir(spark, "warc"))
    changed = spark.createDataFrame([(r.digest, bytearray(b"other"), r.first_id) for r in
                                     spark.read.parquet(f"{path}/payloads").collect()],
                                    "digest string, payload binary, first_id long")
    changed.write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="does not match"):
        warc.read_archive(spark, path).collect()
    assert warc.archive_round_trip(pages.limit(0)).collect() == []
