"""Classifier, page extraction, license scan, line templates, pipeline: accuracy, brute force, odd rows."""

import html
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from fixtures import no_documents, odd_documents

import __spark_entry__ as entry
from playtally.llm import op01_quality_gam as gam
from playtally.llm import op06_html_extraction as pages
from playtally.llm import op09_license_scan as licenses
from playtally.llm import op10_line_dedup as lines
from playtally.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SF_MORE = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_folds(spark):
    import zlib

    got = {r.doc_id: r for r in QUERIES["op1_quality_gam"](spark, SF_MORE).collect()}
    labels = spark.read.parquet(f"{SF_MORE}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{SF_MORE}/documents.parquet").count()
    for r in got.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(got[x.doc_id].predicted, x.quality) for x in labels if got[x.doc_id].held_out]
    assert len(held) > 30 and sum(p == q for p, q in held) / len(held) > 0.9


def test_held_out_labels_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", gam.F.when(gam.held_out(gam.F.col("doc_id")), 1 - gam.F.col("quality"))
                                .otherwise(gam.F.col("quality")))
    one, two = (sorted((r.doc_id, r.score) for r in gam.classify(docs, x).collect()) for x in (labels, flipped))
    assert one == two


def test_classifier_odd_rows(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (11, 0), (None, 1), (9, None), (3, 7)], "doc_id long, quality int")
    got = gam.classify(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    none = gam.classify(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert gam.classify(no_documents(spark), labels).collect() == []


def test_additive_model_learns_a_pair():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.fit_gam(x, y)
    assert ((model.score(x) > 0.5) == y).mean() > 0.95
    assert {p[:2] for p in model.pairs} >= {(0, 1)}


def test_pages_of_the_table_give_their_article(spark):
    source = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in QUERIES["op6_html_extraction"](spark, SF).collect():
        article = source[r.page_id].partition("<article>")[2].partition("</article>")[0]
        article = re.sub(r"</?b>", "", article)
        blocks = (" ".join(html.unescape(x).split()) for x in re.split(r"<[^>]*>", article))
        assert r.text == "\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)


PAGE = ('<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header>Acme site</header>'
        '<ul class="menu"><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul>'
        '<div class="sidebar"><p>Side words stand here. More of them, too.</p></div>'
        '<div class="cookie-notice">We use cookies. Accept them now, please.</div>'
        '<main><h1>The &amp; title</h1><p>First paragraph,\n with <a href=/c>a link</a> in it. And<br>more.</p>'
        '<script>var x = "<p>no</p>";</script><!-- <p>no</p> --><div class="advertisement">Buy this great thing now.</div>'
        '<p>Second one, unclosed.<p>Third &lt;one&gt;.<form><label>Name</label><button>Send</button></form></main>'
        '<div class="comments"><h3>Comments</h3><p>I like it a lot. Thank you for it.</p></div>'
        '<footer>All rights. Words.</footer></body></html>')


def test_page_parts_are_told_apart(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<p"), (5, "u", PAGE[:700]), (5, "u", PAGE[:700]),
            (None, "u", "</div><li><td>&#x41;&bogus;"), (6, "u", "<article><p>" + "long words, here. " * 20_000)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in pages.extract_pages(table).collect()}
    assert got[1].text == ("The & title\nFirst paragraph, with a link in it. And more.\nSecond one, unclosed.\nThird <one>.")
    assert got[2].text == got[3].text == got[4].text == "" and got[2].n_chars == 0
    assert got[5].text.startswith("The & title")
    assert got[6].n_chars == len("long words, here. " * 20_000) - 1
    assert pages.extract_pages(table).count() == len(rows)
    assert pages.extract_pages(table.limit(0)).collect() == []


@pytest.mark.parametrize(("extra", "text"), [
    ("<p>Here <math><mi>E</mi><mo>=</mo><mi>m</mi></math> is the formula, as said.</p>", "Here E=m is the formula, as said."),
    ("<p>A drawing: <svg><path d='M0 0'/><g><circle r=1 /></g><text>its label</text></svg> stands here.</p>",
     "A drawing: its label stands here."),
    ("<p>An object <object data=/x><param name=a>with its words</object> stands here.</p>",
     "An object with its words stands here."),
    ("<noscript><p>Words without any script, here.</p></noscript>", "Words without any script, here."),
    ("<object data='/x'>", ""), ("<object data='/x'/>", ""), ("<noscript>", ""), ("<math><mi>", ""), ("<svg viewBox='0'>", ""),
    ("<iframe src='/x'/>", ""), ("<iframe allowfullscreen/>", ""), ("<svg/>", ""),
])
def test_page_elements_that_are_no_raw_text(extra, text):
    page = PAGE.replace("<p>Second one", extra + "<p>Second one")
    want = ["The & title", "First paragraph, with a link in it. And more.", text, "Second one, unclosed.", "Third <one>."]
    assert pages.extract([pages.parse(page)], pages.train_model()) == ["\n".join(x for x in want if x)]


@pytest.mark.parametrize("page", ["<font>" * 170_000, "<li><b>" * 140_000, "<div><p>x" * 110_000, "</i><i>" * 140_000,
                                  "<svg><g a=b/>" + "<path/>" * 140_000, "<ul>" + "<font>" * 80_000 + "<li>x" * 80_000])
def test_deep_pages_take_linear_time(page):
    import time

    model, start = pages.train_model(), time.process_time()
    pages.extract([pages.parse(page)], model)
    assert time.process_time() - start < 10     # about 3 s alone; the work was quadratic (minutes) before


def test_narrow_levels_equal_wide_ones(monkeypatch):
    """A chain with side branches: messages one by one and as arrays."""
    trees = pages.forest([pages.parse("<div><p>some text here, and more.</p><a>link</a>" * 30), pages.parse("<b>" * 40 + "x")])
    model = pages.train_model()
    one = model.marginals(trees)
    monkeypatch.setattr(pages, "_FEW", 0)
    assert np.abs(one - model.marginals(trees)).max() < 1e-9


def test_marginals_equal_enumeration():
    """Sum-product against summing over all labelings of a small tree."""
    from itertools import product

    page = pages.parse('<div id="content"><p>Some words, here.</p><ul class="menu"><li><a>x</a></li></ul></div>')
    trees, model = pages.forest([page]), pages.train_model()
    local = sum(t[:, v].T for t, v in zip(model.evidence, trees.evidence, strict=True))
    weight = np.zeros((len(page.tags), 2))
    for labels in product((0, 1), repeat=len(page.tags)):
        log = model.prior[labels[0]] + sum(local[i, x] for i, x in enumerate(labels)) + sum(
            model.tie[trees.kind[i], labels[page.parents[i]], labels[i]] for i in range(1, len(labels)))
        for i, x in enumerate(labels):
            weight[i, x] += np.exp(log)
    assert np.allclose(model.marginals(trees), weight[:, 1] / weight.sum(1))


@pytest.mark.parametrize(("text", "found"), [
    ("Licensed under the Apache License, Version 2.0.", ["Apache-2.0"]),
    ("LICENSED under the  apache license version 2.0", ["Apache-2.0"]),
    ("This work is licensed under the GNU General Public License, version 2.", ["GPL-2.0"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"]),
    ("This work is licensed under the GNU General Public License, version 9.", []),
    ("Licensed under CC BY-SA 4.0. And: All rights reserved.", ["CC-BY-SA-4.0", "LicenseRef-all-rights-reserved"]),
    ("the licensed driver went home", []),
    ("x\n" + licenses.TEMPLATES["MIT"][2].replace(", ", ",\n") + "\ny", ["MIT"]),
])
def test_license_wordings(text, found):
    assert sorted({f["license"] for f in licenses.scan_text(text, {})}) == found


BSD = ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the "
       "following\nconditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list "
       "of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright "
       "notice, this list of conditions and the following disclaimer in the documentation.\n")
THIRD = ("3. Neither the name of Acme nor the names of its contributors may be used to endorse or promote products derived "
         "from this software without specific prior written permission.\n")


@pytest.mark.parametrize(("text", "found"), [
    ("License\n" + BSD + THIRD, [("BSD-3-Clause", 1)]),
    ("License\n\n" + BSD + "THIS SOFTWARE IS PROVIDED AS IS", [("BSD-2-Clause", 2)]),
    (BSD + "\n" + BSD + THIRD, [("BSD-2-Clause", 0), ("BSD-3-Clause", 6)]),
    ("All rights reserved. Some words. All rights reserved.", [("LicenseRef-all-rights-reserved", 0)] * 2),
    ("Released under the MIT License. Also: Licensed under the MIT License.\nAll\nrights reserved",
     [("MIT", 0), ("MIT", 0), ("LicenseRef-all-rights-reserved", 1)]),
    ("// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0 */\nint x;",
     [("MIT", 0), ("Apache-2.0", 0), ("GPL-2.0-only", 0)]),
    (licenses.TEMPLATES["GPL-3.0"][1].replace("General", "Affero General"), [("AGPL-3.0", 0)]),
    ("Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby\ngranted, "
     "provided that the above copyright notice and this permission notice appear in all copies.", [("ISC", 0)]),
])
def test_license_notices_over_lines_repeats_and_tags(text, found):
    assert [(f["license"], f["line"]) for f in licenses.scan_text(text, {})] == found


def test_compression_decides_between_licenses(monkeypatch):
    """Of templates that all fit the wording, the gain picks; without it another one wins."""
    text = "This work is licensed under the GNU General Public License, version 3."
    assert [f["license"] for f in licenses.scan_text(text, {})] == ["GPL-3.0"]
    monkeypatch.setattr(licenses, "_gain", lambda template, block: 0)
    assert [f["license"] for f in licenses.scan_text(text, {})] != ["GPL-3.0"]


def test_bsd_clauses_far_behind_the_opening():
    opening = licenses.TEMPLATES["BSD-3-Clause"][1]
    far = " ".join(["conditions"] * 900)
    two = f"{opening}: {far} redistributions in binary form must reproduce the above copyright notice"
    three = f"{two} {far} nor the names of its contributors may be used to endorse or promote products"
    assert [f["license"] for f in licenses.scan_text(two, {})] == ["BSD-2-Clause"]
    assert [f["license"] for f in licenses.scan_text(three, {})] == ["BSD-3-Clause"]
    assert [f["license"] for f in licenses.scan_text(f"{two}\n{three}", {})] == ["BSD-2-Clause", "BSD-3-Clause"]


def test_license_notices_in_lines_of_any_length(spark):
    """Each notice planted once in a line of 10 to 10,000 words, held against an exact word search."""
    rng = np.random.default_rng(9)
    pool = " ".join(r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect() if r.text)
    pool = [w for w in pool.split() if not licenses._TRIGGER.search(w)]
    lost = []
    for n in (10, 100, 300, 1000, 10_000):
        for name, texts in licenses.TEMPLATES.items():
            for notice in texts:
                at, cut = int(rng.integers(len(pool) - n)), int(rng.integers(n + 1))
                own = pool[at:at + n]
                line = " ".join([*own[:cut], notice, *own[cut:]])
                assert f" {' '.join(licenses._split(notice.lower())[0])} " in f" {' '.join(licenses._split(line.lower())[0])} "
                if name not in {f["license"] for f in licenses.scan_text("x\n" + line, {}) if f["line"] == 1}:
                    lost.append((n, notice[:40]))
    assert lost == []


def test_license_scan_finds_every_template_line(spark):
    short = {t: n for n, texts in licenses.TEMPLATES.items() for t in texts if len(t) < 100}
    for r in spark.read.parquet(f"{SF_MORE}/documents.parquet").join(
            QUERIES["op9_license_scan"](spark, SF_MORE), "doc_id").collect():
        want = {(short[x], i) for i, x in enumerate(r.text.split("\n")) if x in short}
        assert {(f.license, f.line) for f in r.findings} == want
    docs = odd_documents(spark)
    assert licenses.scan_licenses(docs).filter("n_findings > 0").count() == 0
    assert licenses.scan_licenses(docs).count() == docs.count()
    assert licenses.scan_licenses(no_documents(spark)).collect() == []


def test_templates_generalise_variable_fields(spark):
    rng = np.random.default_rng(2)
    names = ["ann", "bob", "cyd", "dee", "eve", "fay"]
    notice = "Your order number {n} was shipped to our valued customer {who} by the usual carrier and will arrive within three days"
    rows = [(i, f"own words of text {chr(97 + i) * 3} that nobody else has\n" + notice.format(n=rng.integers(9999), who=names[i])
             + f"\nlast {chr(97 + i)}") for i in range(6)]
    got = lines.clean_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r in got:
        assert r.n_lines == 3 and r.n_dropped == 1 and "order" not in r.text and r.text.count("\n") == 1


def test_templates_beside_other_lines_of_their_leaf(spark):
    """An unrelated line and a second template with the same length and first five tokens switch nothing off."""
    names = ["ann", "bob", "cyd", "dee", "eve", "fay"]
    head = "Your order number 12 was "
    one = head + "shipped to our valued customer {who} by the usual carrier and will arrive within three days"
    two = head + "refused by the bank of {who} so please call our helpful office before this week ends"
    other = head + "never seen though nine old neighbours swear that it fell off some truck near your quiet little house"
    short = "We thank our friend {who} for a gift to this site"
    assert len({len(x.split()) for x in (one, two)}) == 1
    other = " ".join(other.split()[:len(one.split())])
    rows = [(i, f"own {chr(97 + i) * 3} words\n{one.format(who=w)}\n{two.format(who=w)}\n{short.format(who=w)}")
            for i, w in enumerate(names)] + [(9, other)]
    got = {r.doc_id: r for r in lines.clean_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[9].text == other
    for i, w in enumerate(names):
        assert got[i].text == f"own {chr(97 + i) * 3} words\n{short.format(who=w)}" and got[i].n_dropped == 2


def test_lines_of_numbers_are_compared_as_they_stand(spark):
    """Years, prices and table rows that differ stay; the same row in enough documents goes."""
    rng = np.random.default_rng(3)
    row = lambda n: " ".join(f"{x:.2f}" for x in rng.random(n))
    same, rows = row(24), []
    for i in range(12):
        own = [f"{1990 + i}", f"EUR {i}.50", f"{i} May {2000 + i}", row(7), row(30), "Total sum " + row(20)]
        rows.append((i, "\n".join([*own, same, f"Read all {i} answers of this thread"])))
    for r in lines.clean_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert r.text == "\n".join(rows[r.doc_id][1].split("\n")[:6])


def brute_lines(texts):
    """Kept text of each of ``texts``: the rule of op10 over all lines and choices, in plain Python."""
    holders, parsed = defaultdict(set), []
    for copy, text in enumerate(texts):
        copy = texts.index(text)
        for line in (text or "").split("\n"):
            words = re.findall(r"[^\x20\x09-\x0D]+", line)
            if not words:
                parsed.append([])
                continue
            masked = ["<*>" if re.search("[0-9]", w) else w for w in words]
            n, constant = len(words), sum(w != "<*>" for w in masked)
            general = constant >= 3 and 2 * constant >= n
            keys = [("exact", general, tuple(masked if general else words))]
            cut = [masked[n * k // 6:n * (k + 1) // 6] for k in range(6)]
            for some in combinations(range(6), 4):
                if general and sum(w != "<*>" for k in some for w in cut[k]) >= 3:
                    keys.append((n, tuple(masked[:5]), some, tuple(tuple(cut[k]) for k in some)))
            need = lines.LONG_DOCS if n >= lines.LONG_TOKENS else lines.SHORT_DOCS
            parsed.append([(key, need) for key in keys])
            for key in keys:
                holders[key].add(copy)
    at, out = 0, []
    for text in texts:
        own = (text or "").split("\n")
        kept = [line for i, line in enumerate(own) if not any(len(holders[k]) >= need for k, need in parsed[at + i])]
        at += len(own)
        out.append("\n".join(kept) if text else text)
    return out


def test_line_dedup_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: r.text for r in QUERIES["op10_line_dedup"](spark, SF).collect()}
    assert [got[r.doc_id] for r in docs] == brute_lines([r.text for r in docs])


def test_copies_of_a_text_keep_it(spark):
    """Copies count once: neither two nor many of them drop their lines, long or short."""
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)]
    text = "\n".join(" ".join(words[k:k + 30]) for k in range(0, 120, 30)) + "\nshort line of five words"
    near = text + "\nand one line more"
    rows = [(i, text) for i in range(40)] + [(50, near)]
    got = lines.clean_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.text) for r in got} == set(rows) and {r.n_dropped for r in got} == {0}


def test_line_dedup_odd_rows(spark):
    docs = odd_documents(spark)
    got = lines.clean_documents(docs)
    assert got.count() == docs.count()
    by_id = {r.doc_id: r for r in got.collect()}
    assert by_id[4].text is None and by_id[4].n_lines == 0 and by_id[5].text == "" and by_id[6].text == " \n\t "
    assert by_id[9].n_dropped == 0
    assert lines.clean_documents(no_documents(spark)).collect() == []


def test_pipeline_equals_its_stages_by_brute_force(spark):
    """Each stage's effect on the table, recomputed on plain Python values."""
    import corpus_pipeline
    from test_similarity_decontamination import brute_components, brute_hits
    from test_rules_mixing_archive import measured

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ruled = corpus_pipeline.quality_rules(spark, docs, SF).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    base = {d for d, t in texts.items() if not ((m := measured(t))[0] < 50 or 100 * m[4] > 50 * m[0])}
    assert {r.doc_id for r in ruled} <= base
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    assert base & good <= {r.doc_id for r in ruled}
    one = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(ruled, docs.schema), SF).collect()
    comps = brute_components([(r.doc_id, r.text) for r in ruled])
    assert {r.doc_id for r in one} == {c for _, _, c in comps}
    clean = corpus_pipeline.decontamination(spark, spark.createDataFrame(one, docs.schema), SF).collect()
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {r.doc_id for r in clean} == {r.doc_id for r in one if not brute_hits(r.text, items)[1]}
    mixed = corpus_pipeline.mixing(spark, spark.createDataFrame(clean, docs.schema), SF)
    assert mixed.columns == docs.columns
    times = Counter(r.doc_id for r in mixed.collect())
    assert max(times.values()) <= 3 and set(times) <= {r.doc_id for r in clean}
    result = entry.queries()["pipeline"](spark, SF).collect()
    assert Counter(r.doc_id for r in result) == times
    ends = sorted((r.start, r.start + r.n_tokens) for r in result)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:], strict=False))


def test_all_dealt_operators_are_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
