"""License scan by conditional compression (operator 3).

Blocks of text with license wording are found by parts of the templates: a
passage within k edits of a template holds one of any k + 1 parts of it word
for word, so no notice lies outside the blocks, however its lines are wrapped.
Blocks are compressed twice: alone, and with a license template as raw
Zstandard dictionary.  The more a template says of the
block, the more bytes it saves; templates are ranked by that reduction.  The
best are then confirmed by their exact wording: the fewest word insertions,
deletions and replacements that turn the template into some passage of the
block.  A few changed words are allowed, but none that carries a digit or is a
key word of the license, since those tell licenses and versions apart.

Whole texts are scanned; a row comes back for each document.

The sentence that all BSD licenses share is reported as ``BSD``; with the clause
on names the text is ``BSD-3-Clause`` too, with the disclaimer right after the
second clause ``BSD-2-Clause``.

Edge cases: null, empty and cue-less texts have no findings; of templates with
equal reduction and differences the id that sorts first wins; repeated rows
give repeated results; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabstack.llm.common import map_batches

MIN_REDUCTION = 0.2     # bytes saved by the template, as a share of the block alone
MAX_DIFFERENCES = 0.1   # changed words, as a share of the template's
COUNTED = 64            # characters of a word that count in the reduction
BARRED = 1 << 20        # cost of an edit that is never allowed

#: Notices of public licenses.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    # the sentence above is common to the family: the clause on names makes three clauses, its absence before the disclaimer two
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("BSD-2-Clause", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\""),
)
#: Words that tell licenses apart.
KEY_WORDS = frozenset("apache mit gnu gpl lesser affero general mozilla bsd cc by nc sa nd creative commons attribution "
                      "sharealike noncommercial noderivatives unencumbered public".split())

_WORD = re.compile(r"[^\W_]+(?:\.\d+)*")


def folded(text: str) -> str:
    """Lower case, character by character where ``lower`` would move places."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def tokens(text: str) -> list[str]:
    return _WORD.findall(folded(text))


def parts(own: list[str], max_differences: float = MAX_DIFFERENCES) -> list[tuple[int, list[str]]]:
    """A template in one part more than it may have edits, each with its place: a passage within the edits holds one unchanged."""
    n = int(max_differences * len(own)) + 1
    cuts = [k * len(own) // n for k in range(n + 1)]
    return [(a, own[a:b]) for a, b in zip(cuts, cuts[1:])]


def cue(templates=TEMPLATES, max_differences: float = MAX_DIFFERENCES) -> str:
    """Expression, for lower case, that is found in every text with a part of a template (and in some without)."""
    def wording(words):
        return "".join(re.escape(w) + (r"[\W_]*" if "." in w else r"[\W_]+") for w in words[:-1]) + re.escape(words[-1])
    return "(?<![a-z])(?:" + "|".join(sorted({wording(p) for _, t in templates for _, p in parts(tokens(t), max_differences)})) + ")"


_CUE = re.compile(cue(), re.I)


def stretches(words: list[str], own: list[str], max_differences: float = MAX_DIFFERENCES) -> list[tuple[int, int]]:
    """Spans of ``words``, each at most the template and its edits long, one of which holds any passage within the edits."""
    line = " " + " ".join(words) + " "
    edits, found = int(max_differences * len(own)), []
    for place, part in parts(own, max_differences):
        key = " " + " ".join(part) + " "
        at = line.find(key)
        while at >= 0:
            found.append((at, place))
            at = line.find(key, at + 1)
    if not found:
        return []
    at, place = np.array(found).T
    starts = np.cumsum([0] + [len(w) + 1 for w in words[:-1]])
    first = np.unique(np.searchsorted(starts, at) - place)
    return [(max(0, f - edits), min(len(words), f + len(own) + edits)) for f in first.tolist()]


def blocks(text: str, templates=TEMPLATES, max_differences: float = MAX_DIFFERENCES) -> list[tuple[int, int]]:
    """Spans of ``text`` outside which no passage is a template within the edits: its stretches, joined where they meet."""
    where = [m.span() for m in _WORD.finditer(folded(text))]
    words, spans = tokens(text), []
    for a, b in sorted({x for _, t in templates for x in stretches(words, tokens(t), max_differences)}):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    return [(where[a][0], where[b - 1][1]) for a, b in spans]


def fixed(word: str) -> bool:
    """Words that no edit may touch."""
    return word in KEY_WORDS or any(c.isdigit() for c in word)


def differences(template: list[str], block: list[str], barred=None) -> tuple[int, set[str]]:
    """Fewest word edits that turn ``template`` into some passage of ``block``, and the words they touch.

    An edit of a word for which ``barred`` holds costs ``BARRED``, so another passage is not hidden behind it.
    """
    rows, cols = len(template), len(block)
    gone, new = (np.array([BARRED if barred and barred(w) else 1 for w in ws], np.int64) for ws in (template, block))
    cost = np.zeros((rows + 1, cols + 1), np.int64)
    cost[1:, 0] = np.cumsum(gone)
    same = np.array([[a == b for b in block] for a in template], bool).reshape(rows, cols)
    swap = np.where(same, 0, np.maximum(gone[:, None], new[None, :]))
    added = np.concatenate([[0], np.cumsum(new)])
    for i in range(1, rows + 1):
        line = np.minimum(cost[i - 1, :-1] + swap[i - 1], cost[i - 1, 1:] + gone[i - 1])
        # an insertion extends the cell to the left: running minimum of cost minus the insertions up to it
        line = np.concatenate([[cost[i, 0]], line]) - added
        cost[i] = np.minimum.accumulate(line) + added
    i, j = rows, int(np.argmin(cost[rows]))
    total, touched = int(cost[rows, j]), set()
    while i and total:
        if j and cost[i, j] == cost[i - 1, j - 1] + swap[i - 1, j - 1]:
            if not same[i - 1, j - 1]:
                touched |= {template[i - 1], block[j - 1]}
            i, j = i - 1, j - 1
        elif cost[i, j] == cost[i - 1, j] + gone[i - 1]:
            touched.add(template[i - 1])
            i -= 1
        else:
            touched.add(block[j - 1])
            j -= 1
    return total, touched


def allowed(edits: int, touched: set[str], size: int, max_differences: float = MAX_DIFFERENCES) -> bool:
    return edits <= max_differences * size and not any(map(fixed, touched))


def wire(words: list[str]) -> bytes:
    """Words as they are compressed; a very long one next to a notice would hide what the template saves."""
    return " ".join(w[:COUNTED] for w in words).encode("utf-8", "replace")


class Scanner:
    def __init__(self, templates=TEMPLATES, min_reduction: float = MIN_REDUCTION, max_differences: float = MAX_DIFFERENCES):
        self.notices, self.min_reduction, self.max_differences = templates, min_reduction, max_differences
        self.alone = zstandard.ZstdCompressor(level=9, write_content_size=False)
        self.templates = []
        for name, text in templates:
            held = zstandard.ZstdCompressionDict(wire(tokens(text)), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.templates.append((name, tokens(text), zstandard.ZstdCompressor(level=9, dict_data=held, write_content_size=False)))

    def ranked(self, words: list[str]) -> list[tuple[float, str, list[str], list[str]]]:
        """Stretches of the block with the template that may stand there, by how much it shortens them, the best first."""
        out = []
        for name, own, packer in self.templates:
            # a stretch is as long as the template and its edits: a long block would hide what the template saves
            for a, b in stretches(words, own, self.max_differences):
                raw = wire(words[a:b])
                out.append((1 - len(packer.compress(raw)) / len(self.alone.compress(raw)), name, own, words[a:b]))
        return sorted(out, key=lambda x: (-x[0], x[1]))

    def block(self, text: str) -> list[dict]:
        """Confirmed licenses of one block: of each license the wording with the fewest differences."""
        found: dict[str, dict] = {}
        for gain, name, own, words in self.ranked(tokens(text)):
            if gain * len(wire(words)) < self.min_reduction * len(wire(own)):
                continue
            edits, touched = differences(own, words, fixed)
            if allowed(edits, touched, len(own), self.max_differences) and (name not in found or (edits, -gain) < (found[name]["differences"], -found[name]["reduction"])):
                found[name] = {"license": name, "reduction": gain, "differences": edits}
        return [found[k] for k in sorted(found)]

    def scan(self, text: str | None) -> list[dict]:
        out = []
        for a, b in blocks(text or "", self.notices, self.max_differences):
            out += [{**f, "start": a, "length": b - a} for f in self.block(text[a:b])]
        return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES,
         min_reduction: float = MIN_REDUCTION, max_differences: float = MAX_DIFFERENCES) -> DataFrame:
    """``id_col``, ``licenses`` (sorted ids) and ``findings`` (spans in code points) of every row."""
    hint = F.lower(text_col).rlike(cue(templates, max_differences))
    src = docs.select(F.col(id_col).alias("id"), F.when(hint, F.col(text_col)).alias("text"))   # other texts need not leave the JVM
    id_type = docs.schema[id_col].dataType.simpleString()
    kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("length", pa.int64()),
                               ("reduction", pa.float64()), ("differences", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, min_reduction, max_differences)
        for b in batches:
            found = [scanner.scan(t.as_py()) if t.is_valid else [] for t in b.column(1)]
            names = [sorted({f["license"] for f in fs}) for fs in found]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.list_(pa.string())), pa.array(found, kind)], names=["id", "licenses", "findings"])

    schema = f"id {id_type}, licenses array<string>, findings array<struct<license:string,start:bigint,length:bigint,reduction:double,differences:bigint>>"
    return map_batches(src, run, schema).withColumnRenamed("id", id_col)
