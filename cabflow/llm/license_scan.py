"""License scans by patience alignment.

A text and a license template are compared as words.  Words that occur once in
both are anchors; the longest chain of anchors in the same order on both sides
is kept, and the gaps between them are aligned again in the same way, where
more words are unique.  Matched template words over all template words is the
coverage.

A text may hold a license more than once, or far from its start, so alignment
is done around places: runs of the text in which the template's distinctive
words follow each other closely, and, as copies one after the other leave no
word unique in such a run, windows inside it.  A word that the template holds
once tells where a copy it belongs to begins; where the words of one copy agree
on that to within a few words is a window.  All places of a text are returned.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.llm.common import arrow_map, emit, slices

#: Notices and grants of common licenses.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE "
        "SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution."),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission."),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
        "this software for any purpose, including commercial applications, and to alter it and redistribute it "
        "freely, subject to the following restrictions:"),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means."),
    "BSL-1.0-notice": "Distributed under the Boost Software License, Version 1.0.",
}
#: A table of templates beyond this size is refused rather than sent to the tasks.
MAX_TEMPLATE_BYTES = 16 << 20


def read_templates(table: DataFrame) -> dict[str, str]:
    """Templates from a table (name, text): null and wordless ones are left
    out, the rows of one name must agree, and all together must be within
    ``MAX_TEMPLATE_BYTES``."""
    rows = table.select(F.col("name").cast("string"), F.col("text").cast("string")).dropna().distinct()
    if (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) > MAX_TEMPLATE_BYTES:
        raise ValueError("templates are too large")
    out: dict[str, str] = {}
    for r in rows.collect():
        if words_of(r["text"]) and out.setdefault(r["name"], r["text"]) != r["text"]:
            raise ValueError(f"template {r['name']!r} has several texts")
    return out


#: A template is found when this share of its words is matched.
LEAST_COVERAGE = 0.8
#: Words too common to mark a place.
_PLAIN = frozenset("a an and any as at be by for in is it may no not of on or that the this to under with you".split())

_word = re.compile(r"[a-z0-9]+")


def words_of(text: str) -> list[str]:
    """Runs of a-z and 0-9 of the lower-cased text."""
    return _word.findall(text.lower())


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence of distinct values: patience
    piles, each card with a pointer to the pile on its left."""
    tops: list[int] = []
    pile: list[int] = []
    back = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        back[i] = pile[k - 1] if k else -1
        if k == len(tops):
            tops.append(v)
            pile.append(i)
        else:
            tops[k], pile[k] = v, i
    out = []
    i = pile[-1] if pile else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def _once(words: list[str], lo: int, hi: int) -> dict[str, int]:
    found: dict[str, int] = {}
    for i in range(lo, hi):
        w = words[i]
        found[w] = -1 if w in found else i
    return {w: i for w, i in found.items() if i >= 0}


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched positions (in a, in b), in order: anchors and, between them,
    the gaps' own; equal words at the ends of a gap match first."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        ua, ub = _once(a, a0, a1), _once(b, b0, b1)
        common = sorted((i, ub[w]) for w, i in ua.items() if w in ub)
        if not common:
            continue
        keep = [common[k] for k in increasing([j for _, j in common])]
        la, lb = a0, b0
        for i, j in [*keep, (a1, b1)]:
            todo.append((la, i, lb, j))
            la, lb = i + 1, j + 1
        out += keep
    return sorted(out)


class Template:
    def __init__(self, name: str, text: str):
        self.name, self.words = name, words_of(text)
        self.marks = frozenset(self.words) - _PLAIN or frozenset(self.words)
        #: marks that the template holds once, with their places in it
        self.once = {w: i for w, i in _once(self.words, 0, len(self.words)).items() if w in self.marks}
        #: words by which the beginnings that a copy's marks tell may differ
        self.slack = max(2, len(self.words) // 8)

    def places(self, words: list[str], at: list[int]) -> list[tuple[int, int]]:
        """Runs of the text around close marks (positions ``at``), widened to
        both sides by the template's length; runs that touch are one."""
        near = len(self.words)
        need = max(1, len(self.marks) // 2)
        runs, seen, start, last = [], set(), None, None
        for i in [*at, None]:
            if start is not None and (i is None or i - last > near):
                if len(seen) >= need:
                    runs.append((max(0, start - near), min(len(words), last + near + 1)))
                start, seen = None, set()
            if i is not None:
                start = i if start is None else start
                seen.add(words[i])
                last = i
        return runs

    def windows(self, words: list[str], at: list[int]) -> list[tuple[int, int]]:
        """Stretches of a copy's length where enough different marks tell
        nearly the same beginning."""
        told = sorted((i - self.once[words[i]], words[i]) for i in at if words[i] in self.once)
        need = max(1, 2 * len(self.once) // 5)
        out: list[tuple[int, int]] = []
        held: dict[str, int] = {}
        lo, taken = 0, None
        for hi, (begin, w) in enumerate(told):
            held[w] = held.get(w, 0) + 1
            while begin - told[lo][0] > self.slack:
                old = told[lo][1]
                held[old] -= 1
                if not held[old]:
                    del held[old]
                lo += 1
            # the fullest window of a copy: take it when the next beginning leaves it
            leaves = hi + 1 == len(told) or told[hi + 1][0] - told[lo][0] > self.slack
            if leaves and len(held) >= need and (taken is None or told[lo][0] > taken):
                taken = begin
                out.append((max(0, told[lo][0]), min(len(words), begin + len(self.words))))
        return out

    def found(self, words: list[str], at: list[int], least: float) -> list[tuple[float, int, int]]:
        """(coverage, first word, end word) of the places covered to at least
        ``least``, in text order; of places that share more words than the
        slack the best one, of equally good ones the shortest.  A run counts where no window does: it
        may have borrowed from two copies."""
        kept: list[tuple[float, int, int]] = []
        for stretches in (self.windows(words, at), self.places(words, at)):
            tried = []
            for lo, hi in stretches:
                pairs = align(words[lo:hi], self.words)
                if pairs and len(pairs) / len(self.words) >= least:
                    tried.append((len(pairs) / len(self.words), lo + pairs[0][0], lo + pairs[-1][0] + 1))
            for place in sorted(tried, key=lambda x: (-x[0], x[2] - x[1], x[1])):
                if all(min(place[2], e) - max(place[1], s) <= self.slack for _, s, e in kept):
                    kept.append(place)
        return sorted(kept, key=lambda x: x[1])


class Scanner:
    def __init__(self, templates: dict[str, str]):
        self.templates = [Template(n, t) for n, t in sorted(templates.items())]
        self.marks = frozenset().union(*[t.marks for t in self.templates]) if templates else frozenset()

    def scan(self, text: str | None, least: float) -> list[tuple[str, float, int, int]]:
        """(template, coverage, first word, end word) of each place found, by
        template name and then in text order."""
        words = words_of(text) if text else []
        marked = [(i, w) for i, w in enumerate(words) if w in self.marks]
        out = []
        for t in self.templates if marked else ():
            at = [i for i, w in marked if w in t.marks]
            if at:
                out += [(t.name, *place) for place in t.found(words, at, least)]
        return out


_OUT = pa.schema([("doc_id", pa.int64()), ("found", pa.list_(pa.struct([
    ("license", pa.string()), ("coverage", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64())])))])


def license_spans(docs: DataFrame, templates: dict[str, str] | None = None,
                  least: float = LEAST_COVERAGE) -> DataFrame:
    """doc_id, found: for every row (doc_id, text) the places where a template
    is covered to at least ``least``, each with its coverage and the words it
    spans, by name and then in text order.

    Defined cases: null and empty texts, and texts without a word, hold none
    (an empty list); every row gives one row, repeated rows and null doc_ids
    included; of places of one template that overlap the best counts, then the
    shortest, then the first; a very long text is held whole as words (about
    100 times its bytes in a worker); other columns are not read; an empty
    table gives an empty result.
    """
    known = dict(TEMPLATES if templates is None else templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(known)
        for b in slices(batches, "text"):
            found = [[dict(zip(("license", "coverage", "first_word", "end_word"), f, strict=True))
                      for f in scanner.scan(t, least)] for t in b.column(1).to_pylist()]
            yield emit(_OUT, doc_id=b.column(0), found=found)

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                     "doc_id long, found array<struct<license:string,coverage:double,first_word:long,end_word:long>>")
