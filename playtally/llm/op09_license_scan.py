"""License scan by conditional compression.

Every trigger term of a text opens a block around it, long enough for every notice template
that holds the same term. Blocks overlap and none is skipped; they do not end at lines. A
template whose words are missing from the block, more than may be, cannot fit. For the
others the block is compressed by zstandard with the template as raw dictionary, and the
template with the block as raw dictionary: the sizes that both save are the template's
*gain*. Gains rank all candidates of a text, and the ranking decides: from the highest
on, a candidate is confirmed by its exact wording (missing plus extra words within
``tolerance`` of the template, no difference in a number: versions decide between
licenses), and takes its words from the candidates after it. ``coverage`` is what the
template saves on the words that fit, relative to its own compressed size.

Spark picks the candidate texts by one regular expression inside the JVM; only
those reach Python, as whole texts. No shuffle, no collected state.

Defined results: null and empty texts, and texts without a notice, have no
findings. Of templates that fit overlapping words, the one with the highest gain
wins, of equal ones the longer, then the first by name. ``line`` is the line
of the notice's first word; each occurrence is a finding. Repeated rows repeat.
Extra columns are not read. Empty table: no rows.

BSD-2 and BSD-3 open alike and are told apart by the clauses that follow: with a
clause on endorsement BSD-3, with the clause on binary forms only BSD-2; an
opening whose clauses are not in the text counts as BSD-3. The identifiers of an
SPDX-License-Identifier tag are findings as they are written.
"""

from __future__ import annotations

import difflib
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtally.llm.common import share_package

LEVEL = 19
TOLERANCE = 0.1

# Notice wordings, by SPDX identifier.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    "MIT": (
        "Released under the MIT License.", "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so"),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."),
    "LGPL-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version."),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version."),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0."),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.",),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0-1.0": ("This work has been dedicated to the public domain under CC0 1.0.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "LicenseRef-all-rights-reserved": ("All rights reserved.",),
}
# Every template holds one of these terms, each a group of its own.
TRIGGER = (r"(?i)(licen[cs]e)|(all[\W_]+rights[\W_]+reserved)|(public[\W_]+domain)"
           r"|(permission[\W_]+is[\W_]+hereby[\W_]+granted)|(free[\W_]+software)|(redistribution[\W_]+and[\W_]+use)"
           r"|(permission[\W_]+to[\W_]+use)")

FINDINGS = "array<struct<license: string, line: int, coverage: double, missing: int, extra: int>>"
_FINDINGS = pa.list_(pa.struct([("license", pa.string()), ("line", pa.int32()), ("coverage", pa.float64()),
                                ("missing", pa.int32()), ("extra", pa.int32())]))
_WORD = re.compile(r"[^\W_]+(?:[.'][^\W_]+)*")
_TRIGGER = re.compile(TRIGGER)
_SPDX = re.compile(r"SPDX-License-Identifier:([^\n]*)", re.I)
_OPENING = 6              # the trigger of the BSD notices


def _split(text: str) -> tuple[list[str], list[int], list[tuple[int, int]]]:
    """Words of a lower-case text, where they begin, and its triggers: term, word."""
    found = list(_WORD.finditer(text))
    starts = [m.start() for m in found]
    triggers = [(m.lastindex, max(0, bisect_right(starts, m.start()) - 1)) for m in _TRIGGER.finditer(text)]
    return [m[0] for m in found], starts, triggers


def _compressor(dictionary: bytes | None = None) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if dictionary else None
    params = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=params)


@dataclass
class Template:
    name: str
    words: list[str]
    raw: bytes
    counts: Counter
    triggers: list[tuple[int, int]]
    size: int
    compressor: zstandard.ZstdCompressor


@cache
def _templates() -> list[Template]:
    plain = _compressor()
    rows = []
    for name, texts in TEMPLATES.items():
        for text in texts:
            words, _, triggers = _split(text.lower())
            raw = " ".join(words).encode()
            rows.append(Template(name, words, raw, Counter(words), triggers, len(plain.compress(raw)), _compressor(raw)))
    return rows


def _differences(template: list[str], block: list[str]) -> tuple[int, int, int, int, bool]:
    """Missing and extra words of the best alignment, its span in the block, numbers equal."""
    runs = [m for m in difflib.SequenceMatcher(None, template, block, autojunk=False).get_matching_blocks() if m.size]
    if not runs:
        return len(template), 0, 0, 0, False
    begin, end = runs[0].b, runs[-1].b + runs[-1].size
    used_t = {m.a + i for m in runs for i in range(m.size)}
    used_b = {m.b + i for m in runs for i in range(m.size)}
    missing = [w for i, w in enumerate(template) if i not in used_t]
    extra = [block[i] for i in range(begin, end) if i not in used_b]
    numbers = not any(c.isdigit() for w in missing + extra for c in w)
    return len(missing), len(extra), begin, end, numbers


@cache
def _reach() -> dict[int, tuple[int, int]]:
    """How many words before and after a trigger term its templates may take, slack included."""
    out: dict[int, tuple[int, int]] = {}
    for t in _templates():
        slack = int(TOLERANCE * len(t.words))
        for term, offset in t.triggers:
            before, after = out.get(term, (0, 0))
            out[term] = (max(before, offset + slack), max(after, len(t.words) - offset + slack))
    return out


def _gain(template: Template, block: bytes) -> int:
    """Bytes that the template saves on the block and the block on the template."""
    saved = len(_compressor().compress(block)) - len(template.compressor.compress(block))
    return saved + template.size - len(_compressor(block).compress(template.raw))


def _coverage(template: Template, stretch: list[str]) -> float:
    raw = " ".join(stretch).encode()
    return round(min(1.0, (len(_compressor().compress(raw)) - len(template.compressor.compress(raw))) / template.size), 3)


def _bsd(words: list[str]) -> str:
    """The BSD license whose clauses stand in the words after the opening."""
    clauses = " ".join(words)
    if "to endorse or promote products" in clauses or "redistributions in binary form" not in clauses:
        return "BSD-3-Clause"
    return "BSD-2-Clause"


def _tagged(text: str) -> list[tuple[str, int]]:
    """Identifiers in SPDX tags and their lines; exceptions after WITH are no licenses."""
    out = []
    for tag in _SPDX.finditer(text):
        before = "OR"
        for word in re.findall(r"[A-Za-z0-9][\w.+:-]*", tag[1]):
            joint = word.upper() in ("AND", "OR", "WITH")
            if joint == (before in ("AND", "OR", "WITH")):
                break
            if before in ("AND", "OR"):
                out.append((word.rstrip(".:-"), text.count("\n", 0, tag.start())))
            before = word.upper() if joint else ""
    return out


def match_words(words: list[str], triggers: list[tuple[int, int]], seen: dict[tuple, tuple],
                tolerance: float = TOLERANCE) -> list[tuple[str, float, int, int, int]]:
    """``(license, coverage, missing, extra, first word)`` of every notice among the words.
    ``seen`` remembers what was compressed or aligned before."""
    held, ranked = Counter(words), set()
    near = [(i, t) for i, t in enumerate(_templates())
            if (t.counts - held).total() <= int(tolerance * len(t.words))]
    for term, at in triggers:
        before, after = _reach().get(term, (0, 0))
        block = words[max(0, at - before):at + after]
        count, raw = Counter(block), " ".join(block).encode()
        for i, template in near:
            size = len(template.words)
            slack = int(tolerance * size)
            offsets = [offset for t, offset in template.triggers if t == term]
            if not offsets or (template.counts - count).total() > slack:
                continue
            if (i, raw) not in seen:
                seen[i, raw] = _gain(template, raw)
            for begin in {at - offset for offset in offsets}:
                low, high = max(0, begin - slack), max(0, begin + size + slack)
                ranked.add((-seen[i, raw], -size, template.name, low, high, i))
    taken, found = bytearray(len(words)), []
    openings = [at for term, at in triggers if term == _OPENING]
    for _, _, name, low, high, i in sorted(ranked):
        template, window = _templates()[i], words[low:high]
        slack = int(tolerance * len(template.words))
        if (template.counts - Counter(window)).total() > slack:
            continue
        if (i, *window) not in seen:
            seen[i, *window] = _differences(template.words, window)
        missing, extra, first, last, numbers = seen[i, *window]
        first, last = low + first, low + last
        if not numbers or missing + extra > slack or any(taken[first:last]):
            continue
        taken[first:last] = b"\1" * (last - first)
        if template.words[0] == "redistribution":
            # The clauses stand before the next opening.
            after = bisect_left(openings, last)
            name = _bsd(words[last:openings[after] if after < len(openings) else len(words)])
        found.append((name, _coverage(template, words[first:last]), missing, extra, first))
    return sorted(found, key=lambda f: f[4])


def scan_text(text: str, seen: dict[tuple, tuple]) -> list[dict]:
    """Findings of one text. ``seen`` remembers windows that were aligned before."""
    tags = [{"license": name, "line": line, "coverage": 1.0, "missing": 0, "extra": 0} for name, line in _tagged(text)]
    text = text.lower()
    words, starts, triggers = _split(text)
    out, line, at = [], 0, 0
    for name, coverage, missing, extra, first in match_words(words, triggers, seen):
        line, at = line + text.count("\n", at, starts[first]), starts[first]
        out.append({"license": name, "line": line, "coverage": coverage, "missing": missing, "extra": extra})
    return sorted(out + tags, key=lambda f: f["line"])


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, licenses, n_findings, findings`` for every row of ``docs``."""

    @F.arrow_udf(FINDINGS)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            seen: dict[tuple, tuple] = {}
            yield pa.array([scan_text(t.as_py(), seen) if t.is_valid else [] for t in batch], _FINDINGS)

    share_package(docs.sparkSession)
    candidate = F.when(F.col(text).rlike(TRIGGER), F.col(text))
    found = docs.select(F.col(doc_id).alias("doc_id"), scan(candidate).alias("findings"))
    return found.select("doc_id", F.array_sort(F.array_distinct("findings.license")).alias("licenses"),
                        F.size("findings").cast("bigint").alias("n_findings"), "findings")
