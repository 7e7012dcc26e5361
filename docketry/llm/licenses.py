"""License scans by conditional compression: candidate blocks are compressed with each template as a zstandard raw
dictionary, size reductions rank the templates, and the winners are confirmed by exact wording differences."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Usual wordings of licence notices, with an identifier each.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Proprietary", "All rights reserved."),
]
#: A block needs one of these, in any case.
TRIGGER = r"licen[sc]e|copyright|spdx-|all rights reserved|permission is hereby|redistribution and use|creative commons|subject to the terms"
#: Least share of a block's compressed size that a template takes away; largest share of a template's words that may
#: differ; words kept on each side of a trigger (more if a template is longer).
LEAST_GAIN, TOLERANCE, AROUND = 0.2, 0.1, 40
#: Words at either end of a template without a trigger that become triggers of its own.
OWN_WORDS = 2

_word = re.compile(r"[^\W_]+(?:[.\-'][^\W_]+)*")
_rest = re.compile(r"[^\W_]*")
#: A line end, with the marks of a comment's next line.
_wrap = re.compile(r"\s*\n[\s#*/;%!>|]*")


class Finding(NamedTuple):
    license: str
    template: int
    start: int
    end: int
    plain_size: int
    given_size: int
    gain: float
    differences: list[str]


def triggers(templates: list[tuple[str, str]]) -> str:
    """TRIGGER, and for each template that it misses the words at the template's ends (either may be the ones that differ)."""
    own = []
    for _, text in templates:
        if not re.search(TRIGGER, text, re.IGNORECASE):
            words = [re.escape(w) for w in _word.findall(text)]
            own += [r"[^0-9A-Za-z]+".join(x) for x in (words[:OWN_WORDS], words[-OWN_WORDS:]) if x]
    return "|".join([TRIGGER, *dict.fromkeys(own)])


class Scanner:
    def __init__(self, templates: list[tuple[str, str]], tolerance: float = TOLERANCE):
        self.templates, self.tolerance = templates, tolerance
        self.trigger = re.compile(triggers(templates), re.IGNORECASE)
        self.words = [[w.lower() for w in _word.findall(t)] for _, t in templates]
        self.bags = [Counter(w) for w in self.words]
        self.reach = max([AROUND, *(int(len(re.findall(r"[^\W_]+", t)) * (1 + tolerance)) + 1 for _, t in templates)])
        options = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.plain = zstandard.ZstdCompressor(level=3, **options)
        self.given = []
        for _, text in templates:
            d = zstandard.ZstdCompressionDict(text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=3)
            self.given.append(zstandard.ZstdCompressor(dict_data=d, **options))

    def _around(self, text: str, at: int, edge: int, step: int) -> int:
        """`reach` words before or after a place, over line ends, up to a line without words."""
        n, inside, filled = 0, True, True
        while at != edge:
            c = text[at - 1 if step < 0 else at]
            if c.isalnum():
                n += not inside
                if n > self.reach:
                    break
                inside = filled = True
            else:
                inside = False
                if c == "\n":
                    if not filled:
                        break
                    filled = False
            at += step
        return at

    def scan(self, text: str) -> list[Finding]:
        """Every trigger's surroundings, then what a confirmed notice leaves of them, until no template is confirmed."""
        out, floor, at = [], 0, 0
        while m := self.trigger.search(text, at):
            a, b = self._around(text, m.start(), floor, -1), self._around(text, m.end(), len(text), 1)
            best = self._best(text, a, b)
            if best is None:  # the line alone, where the words around it hide a notice
                line, end = max(text.rfind("\n", a, m.start()) + 1, a), text.find("\n", m.end(), b)
                if line > a or end >= 0:
                    best = self._best(text, line, b if end < 0 else end)
            if best is None:
                at = _rest.match(text, m.end()).end()
                continue
            out += [*self._all(text, a, best.start), best]
            floor, at = best.end, max(m.start(), best.end)
        return out

    def _all(self, text: str, a: int, b: int) -> list[Finding]:
        best = self._best(text, a, b) if self.trigger.search(text, a, b) else None
        return [*self._all(text, a, best.start), best, *self._all(text, best.end, b)] if best else []

    def _best(self, text: str, a: int, b: int) -> Finding | None:
        """Of a block, the template that compresses it best among those whose wording is confirmed: the templates are tried
        in the order of their size reductions, equal ones as listed, until one is confirmed."""
        block = text[a:b]
        words = [(m[0].lower(), m.start(), m.end()) for m in _word.finditer(block)]
        bag = Counter(w[0] for w in words)
        possible = [i for i, t in enumerate(self.bags) if (t - bag).total() <= self.tolerance * t.total()]  # no other can be confirmed
        if not possible:
            return None
        data = _wrap.sub(" ", block).lower().encode("utf-8", "replace")  # wording in any case, however it is wrapped
        plain = len(self.plain.compress(data))
        sizes = {i: len(self.given[i].compress(data)) for i in possible}
        for i in sorted(possible, key=lambda i: (sizes[i], i)):
            gain = (plain - sizes[i]) / plain
            if gain < LEAST_GAIN * min(1, len(self.templates[i][1]) / len(block)):
                continue
            found = self._differences(words, self.words[i])
            if found and len(found[0]) <= self.tolerance * len(self.words[i]):
                return Finding(self.templates[i][0], i, a + found[1], a + found[2], plain, sizes[i], gain, found[0])
        return None

    @staticmethod
    def _differences(words: list, template: list[str]) -> tuple[list[str], int, int] | None:
        """Words missing (-) and added (+) in the run of common words with the fewest; where its first and last stand."""
        same = SequenceMatcher(None, [w[0] for w in words], template, autojunk=False).get_matching_blocks()[:-1]
        best = None
        for k in range(len(same)):
            cost, end = len(template), same[k].a
            for n in range(k, len(same)):
                cost += same[n].a - end - same[n].size
                end = same[n].a + same[n].size
                if best is None or cost < best[0]:
                    best = cost, k, n
        if best is None:
            return None
        run, out = same[best[1] : best[2] + 1], []
        for x, y in zip([None, *run], [*run, None], strict=True):
            out += [f"-{w}" for w in template[x.b + x.size if x else 0 : y.b if y else len(template)]]
            if x and y:
                out += [f"+{w[0]}" for w in words[x.a + x.size : y.a]]
        return out, words[run[0].a][1], words[run[-1].a + run[-1].size - 1][2]


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(doc_id, license, template, start, end, plain_size, given_size, gain, differences), one row a confirmed notice.

    start and end are characters of the text; differences are the words that a notice lacks (-) or adds (+).
    Notices may run over line ends, up to a blank line, and several may stand in one line.  Whole texts are searched for
    triggers, however long; templates of one's own are found by TRIGGER or by the words at their ends.  Null and empty
    texts have no blocks; repeated documents repeat their rows; equal gains go to the template listed first; other
    columns are not read."""
    schema = "doc_id long, license string, template int, start int, end int, plain_size int, given_size int, gain double, differences array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            rows = [(i, *f) for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for f in scanner.scan(t.as_py())]
            columns = list(zip(*rows, strict=True)) or [[]] * 9
            kinds = [pa.int64(), pa.string(), *[pa.int32()] * 5, pa.float64(), pa.list_(pa.string())]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "license", "template", "start", "end", "plain_size", "given_size", "gain", "differences"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").rlike(f"(?iu){triggers(templates)}")).mapInArrow(run, schema)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
