"""Operator 8: license notices by conditional compression.

The hints of a template are so many of its longest words that no wording of MATCH can lack them all. At each place of
a hint, blocks start at every word where the template may then start, with up to SLACK words put in or the missing ones
left out before it. Every block is compressed plainly and with its template as a raw-content zstandard dictionary, and
the blocks of all templates are ranked by the bytes that the dictionary saves. In that order each is confirmed by its
exact wording, unless it overlaps a notice that stands already: the words of block and template are aligned, and the
template is reported if the share of its words that stand in order is MATCH at least, with the differences (words
missing and words put in). So of several templates whose wording fits, the one that compresses the block best is it.

The whole text is searched, across line breaks and at any place of a line; line is the line of the notice's first word.
Null and empty texts hold nothing. Repeated rows each give their rows; equal notices in one document are separate rows.
Other columns are left out.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Notices and texts of public licenses. A parameter; callers pass others the same way.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "ISC": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "MIT-text": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "all-rights-reserved": "All rights reserved.",
}
MATCH, SLACK = 0.85, 2
SCHEMA = "doc_id long, line int, template string, saved int, matched double, differences array<string>"
WORD = re.compile(r"[\w.-]*\w")


def words(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


def least(own: list[str]) -> int:
    """Words of a template that must stand in order."""
    return math.ceil(MATCH * len(own) - 1e-9)


def hints(own: list[str]) -> list[int]:
    """Places of the template's longest words, one more than may be missing."""
    return sorted(range(len(own)), key=lambda i: (-len(own[i]), i))[: len(own) - least(own) + 1]


def hint_pattern(templates: dict[str, str]) -> str:
    """A text without this holds none of the templates."""
    return "(?i)" + "|".join(sorted({re.escape(own[i]) for own in map(words, templates.values()) for i in hints(own)}))


class Scanner:
    def __init__(self, templates: dict[str, str]):
        import zstandard as z

        self.words = {k: words(t) for k, t in templates.items()}
        self.bags = {k: Counter(w) for k, w in self.words.items()}
        self.plain = z.ZstdCompressor(level=3)
        self.given = {k: z.ZstdCompressor(level=3, dict_data=z.ZstdCompressionDict(t.encode(), dict_type=z.DICT_TYPE_RAWCONTENT)) for k, t in templates.items()}
        self.hints: dict[str, list[tuple[str, int]]] = defaultdict(list)
        for k, own in self.words.items():
            for i in hints(own):
                self.hints[own[i]].append((k, i))

    def starts(self, said: list[str]) -> set[tuple[str, int]]:
        """(template, word): where a template may start, by the hints of the text."""
        out = set()
        for at, word in enumerate(said):
            for name, i in self.hints.get(word, ()):
                missing = len(self.words[name]) - least(self.words[name])
                out.update((name, s) for s in range(max(0, at - i - SLACK), min(at, at - i + missing) + 1))
        return out

    def saved(self, name: str, block: str) -> int:
        """Bytes by which the template as a dictionary shrinks the block."""
        raw = " ".join(block.split()).encode("utf-8", "surrogatepass")
        return len(self.plain.compress(raw)) - len(self.given[name].compress(raw))

    def confirmed(self, name: str, got: list[str]) -> tuple | None:
        """(share, differences, first and last aligned word) where a block has the template's wording."""
        own, bag = self.words[name], Counter(got)
        if sum(min(n, bag[w]) for w, n in self.bags[name].items()) < least(own):
            return None
        match = SequenceMatcher(None, own, got, autojunk=False)
        runs = match.get_matching_blocks()[:-1]
        count = sum(m.size for m in runs)
        if count < least(own):
            return None
        diff = []
        for op, i, j, k, m in match.get_opcodes():
            if op in ("delete", "replace"):
                diff += [f"-{w}" for w in own[i:j]]
            # What stands before the first word or behind the last one is not the notice's.
            if op == "replace" and i == 0:
                diff += [f"+{w}" for w in got[max(k, m - j) : m]]
            elif op == "replace" or op == "insert" and 0 < i < len(own):
                diff += [f"+{w}" for w in got[k : min(m, k + (j - i))] or got[k:m]]
        return count / len(own), diff, runs[0].b, runs[-1].b + runs[-1].size

    def scan(self, text: str) -> Iterator[tuple[int, str, int, float, list[str]]]:
        spans = [m.span() for m in WORD.finditer(text)]
        said = [text[i:j].lower() for i, j in spans]
        ranked = []
        for name, s in self.starts(said):
            e = min(len(said), s + len(self.words[name]) + SLACK)
            gain = self.saved(name, text[spans[s][0] : spans[e - 1][1]])
            if gain > 0:
                ranked.append((-gain, s, name, e))
        blocks, tried, taken, out = defaultdict(dict), {}, set(), []
        for gain, s, name, e in ranked:
            blocks[name][s] = (gain, e)
        for _, s, name, _ in sorted(ranked):
            # The template is chosen by its best block; its place, by the wording of its blocks around there.
            near = [k for k in range(s - len(self.words[name]), s + len(self.words[name]) + 1) if k in blocks[name]]
            tried |= {(name, k): self.confirmed(name, said[k : blocks[name][k][1]]) for k in near if (name, k) not in tried}
            fits = [(-f[0], len(f[1]), k, f) for k in near if (f := tried[name, k]) and taken.isdisjoint(range(k + f[2], k + f[3]))]
            if tried[name, s] and fits:
                share, _, k, (_, diff, first, last) = min(fits, key=lambda x: x[:3])
                taken.update(range(k + first, k + last))
                out.append((spans[k + first][0], name, -blocks[name][k][0], -share, diff))
        for at, *rest in sorted(out):
            yield (text.count("\n", 0, at), *rest)


def licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, line, template, saved, matched, differences per notice."""
    use = templates or TEMPLATES
    hint = hint_pattern(use)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(use)
        for batch in batches:
            # Arrow's search takes all hints in one pass over the bytes.
            batch = batch.filter(pc.match_substring_regex(batch.column(1), hint))
            rows = [(doc.as_py(), *hit) for doc, text in zip(batch.column(0), batch.column(1), strict=True) for hit in scanner.scan(text.as_py())]
            if rows:
                d, line, name, saved, share, diff = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(line, pa.int32()), pa.array(name), pa.array(saved, pa.int32()), pa.array(share, pa.float64()), pa.array(diff, pa.list_(pa.string()))], ["doc_id", "line", "template", "saved", "matched", "differences"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").where("text is not null").mapInArrow(run, SCHEMA)
