"""Licence scan: normalised text against templates by Dice coefficient.

Texts are normalised to lower-case words (runs of ASCII letters and digits and
of other non-ASCII characters); a window's and a template's sets of word bigrams
are compared by the Dice coefficient, twice the shared over the sum of sizes.
Windows are all runs of words, across lines and paragraphs, that begin with one
of the template's bigrams and have at most (2 - t) / t times as many bigrams as
it, repeats counted, t being the least coefficient.  A window's score is its coefficient times
the bigrams shared, so that a whole licence goes before a notice inside it and
the right version before its siblings.  The places of a text are chosen by
score: the best window, then the best that does not overlap it, and so on.
``TEMPLATES`` are notices, headers and the whole texts in ``templates/``.

Besides, ``found`` judges fixed units: every line, every paragraph of several
lines, and a text of several paragraphs as a whole.

Three bounds prune without loss: a coefficient of t needs sizes within a factor
of (2 - t) / t and t / (2 - t) of the template's bigrams shared, so that a text
without any of its rarest few is no match (all words of a batch are hashed and
tested in numpy), nor is one that holds too few of them in all.

Defined results: null and empty texts have no match; a window of one word has no
bigram; equal scores are ordered by place, licence name and length, equal best
matches of a document by licence name; repeated rows are each judged; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_left, bisect_right
from importlib.resources import files

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WordHasher, mix, steps, table, text_hash

THRESHOLD = 0.8

_WHOLE = {"Apache-2.0": "Apache-2.0", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}


def _file(name: str) -> str:
    return files(__package__).joinpath("templates", f"{name}.txt").read_text()


def _affero() -> str:
    """GPL-3 under the other name and with the AGPL's section 13; the preamble
    is that of the GPL."""
    text = re.sub(r"GNU\s+General\s+Public\s+License", "GNU Affero General Public License", _file("GPL-3"))
    text = text.replace("GNU GENERAL PUBLIC LICENSE", "GNU AFFERO GENERAL PUBLIC LICENSE")
    first, last = re.search(r"  13\. Use with", text).start(), re.search(r"  14\. Revised Versions", text).start()
    return text[:first] + _REMOTE + text[last:]


_REMOTE = """  13. Remote Network Interaction; Use with the GNU General Public License.

  Notwithstanding any other provision of this License, if you modify the Program, your modified version must prominently offer all users interacting with it remotely through a computer network (if your version supports such interaction) an opportunity to receive the Corresponding Source of your version by providing access to the Corresponding Source from a network server at no charge, through some standard or customary means of facilitating copying of software.  This Corresponding Source shall include the Corresponding Source for any work covered by version 3 of the GNU General Public License that is incorporated pursuant to the following paragraph.

  Notwithstanding any other provision of this License, you have permission to link or combine any covered work with a work licensed under version 3 of the GNU General Public License into a single combined work, and to convey the resulting work.  The terms of this License will continue to apply to the part which is the covered work, but the work with which it is combined will remain governed by version 3 of the GNU General Public License.

"""

_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
_MIT = _GRANT + """ The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
%sTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ENDORSE = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_FREE = "you can redistribute it and/or modify it under the terms of the GNU %s as published by the Free Software Foundation, either version %s of the License, or (at your option) any later version."

#: Customary licence notices and whole texts, (name, text).
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    *((name, f"This work is licensed under the GNU {title} License, version {v}") for name, title, v in (
        ("GPL-2.0", "General Public", "2"), ("LGPL-2.1", "Lesser General Public", "2.1"), ("LGPL-3.0", "Lesser General Public", "3"), ("AGPL-3.0", "Affero General Public", "3"))),
    *((name, f"This {what} is free software: " + _FREE % (title, v)) for name, what, title, v in (
        ("GPL-2.0", "program", "General Public License", "2"), ("LGPL-2.1", "library", "Lesser General Public License", "2.1"),
        ("LGPL-3.0", "program", "Lesser General Public License", "3"), ("AGPL-3.0", "program", "Affero General Public License", "3"))),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0"),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("MIT", _MIT),
    ("BSD-2-Clause", _BSD % ""),
    ("BSD-3-Clause", _BSD % _ENDORSE),
    ("ISC", _ISC + " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    *((name, _file(stem)) for stem, name in _WHOLE.items()),
    ("AGPL-3.0", _affero()),
]
_PLAIN = frozenset(b"a all and any are as at be by for from if in is it may not of on or that the this to use with work you your".split())

_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAPS = re.compile(rb"\n[ \t\r]*\n\s*")


def bigrams(text: bytes) -> set[tuple[bytes, bytes]]:
    words = _WORDS.findall(text.lower())
    return set(zip(words, words[1:], strict=False))


def units(text: bytes):
    """(first line, lines, text) of every line, paragraph and whole text."""
    start = 0
    lines = text.split(b"\n")
    for n, line in enumerate(lines):
        yield n, 1, line
    begun, paragraphs = 0, []
    for gap in [*_GAPS.finditer(text), None]:
        part = text[start : gap.start() if gap else len(text)]
        paragraphs.append((begun, part))
        if gap:
            begun += part.count(b"\n") + gap.group().count(b"\n")
            start = gap.end()
    for first, part in paragraphs:
        if b"\n" in part:
            yield first, part.count(b"\n") + 1, part
    if len(paragraphs) > 1:
        yield 0, len(lines), text


class Scanner:
    def __init__(self, templates: list[tuple[str, str]], threshold: float) -> None:
        self.hasher, self.threshold = WordHasher(), threshold
        # A template without a bigram matches nothing.
        self.templates = [(name, pairs) for name, text in templates if (pairs := bigrams(text.encode()))]
        known = sorted(set().union(*(pairs for _, pairs in self.templates)))
        hashes = self._pairs(self.hasher([b" ".join(pair) for pair in known])[0])[::2] if known else np.zeros(0, np.uint64)
        self.known, of = np.unique(hashes, return_inverse=True)
        self.member = np.zeros((len(self.known), len(self.templates)), bool)
        place = dict(zip(known, of.tolist(), strict=True))
        for t, (_, pairs) in enumerate(self.templates):
            self.member[[place[p] for p in pairs], t] = True
        self.sizes = self.member.sum(0)
        self.longest = [int((2 - threshold) / threshold * (len(_WORDS.findall(text.lower().encode())) - 1) + 1e-9) for _, text in templates if bigrams(text.encode())]
        # A coefficient of t needs t / (2 - t) of the template's bigrams.
        self.need = np.array([math.ceil(threshold * n / (2 - threshold) - 1e-9) for n in self.sizes.tolist()], np.int64)
        shares, self.hint = self.member.sum(1), np.zeros(1 << 18, bool)
        for (_, pairs), n, need in zip(self.templates, self.sizes.tolist(), self.need.tolist(), strict=True):
            # All but need - 1 of them, the rarest first: a match has one.
            rare = sorted(pairs, key=lambda p: (sum(w in _PLAIN for w in p), shares[place[p]], -len(p[0] + p[1]), p))[: n - need + 1]
            self.hint[self._slot(self.known[[place[p] for p in rare]])] = True

    @staticmethod
    def _pairs(words: np.ndarray) -> np.ndarray:
        return mix(words[:-1] ^ mix(words[1:]))

    @staticmethod
    def _slot(pairs: np.ndarray) -> np.ndarray:
        return (pairs & np.uint64(0x3FFFF)).astype(np.int64)

    def candidates(self, texts: list[bytes | None]):
        """Per text (hashes of its bigrams, templates of which it holds enough
        bigrams), or None; no text that has a match is missed."""
        out: list = [None] * len(texts)
        for a, b in steps(texts):
            words, counts = self.hasher(texts[a:b])
            if len(words) < 2 or not self.templates:
                continue
            pairs, ends = self._pairs(words), np.cumsum(counts)
            hit = np.flatnonzero(self.hint[self._slot(pairs)])
            for i in np.unique(np.searchsorted(ends, hit, "right")).tolist():
                own = pairs[ends[i] - counts[i] : max(ends[i] - 1, 0)]
                held = np.isin(self.known, own)
                fits = np.flatnonzero(self.member[held].sum(0) >= self.need)
                if len(fits):
                    out[a + i] = own, fits.tolist()
        return out

    def scan(self, text: bytes, fits: list[int]) -> list[tuple[str, int, int, float]]:
        """(licence, first line, lines, Dice) of every matching unit: its best
        template."""
        out = []
        templates = [self.templates[t] for t in fits]
        for first, lines, unit in units(text):
            have = bigrams(unit)
            if not have:
                continue
            best = None
            for name, pairs in templates:
                total = len(pairs) + len(have)
                # Shared bigrams are at most the smaller size.
                if 2 * min(len(pairs), len(have)) >= self.threshold * total:
                    dice = 2 * len(pairs & have) / total
                    if dice >= self.threshold and (best is None or (-dice, name) < (-best[3], best[0])):
                        best = (name, first, lines, dice)
            if best:
                out.append(best)
        return out

    def windows(self, pairs: np.ndarray, fits: list[int]) -> list[tuple[int, int, str, float]]:
        """(first bigram, end, licence, Dice) of the places chosen by score, in
        text order."""
        m = len(pairs)
        order = np.argsort(pairs, kind="stable")
        again = np.flatnonzero(pairs[order[1:]] == pairs[order[:-1]])
        before = np.full(m, -1, np.int64)  # the last place with the same bigram
        before[order[again + 1]] = order[again]
        at = np.searchsorted(self.known, pairs)
        at[at == len(self.known)] = 0
        at[self.known[at] != pairs] = -1
        rows, waiting = {}, []

        def best(start: int, t: int, end: int):
            """The best window of a template from a place, not beyond ``end``."""
            end = min(end, start + self.longest[t])
            fresh = before[start:end] < start
            size, shared = np.cumsum(fresh), np.cumsum(fresh & rows[t][start:end])
            dice = 2 * shared / (size + int(self.sizes[t]))
            score = np.where(dice >= self.threshold, shared * dice, 0.0)
            k = int(score.argmax())
            if score[k] > 0:
                heapq.heappush(waiting, (-float(score[k]), start, self.templates[t][0], start + k + 1, t, float(dice[k])))

        for t in fits:
            rows[t] = (at >= 0) & self.member[at, t]
            upto = np.concatenate([[0], np.cumsum(rows[t])])
            starts = np.flatnonzero(rows[t])
            for start in starts[upto[np.minimum(starts + self.longest[t], m)] - upto[starts] >= self.need[t]].tolist():
                best(start, t, m)
        begins, ends, out = [], [], []
        while waiting:
            _, start, name, end, t, dice = heapq.heappop(waiting)
            k = bisect_right(begins, start)
            if k and ends[k - 1] > start:
                continue
            limit = begins[k] if k < len(begins) else m
            if end > limit:
                best(start, t, limit)
                continue
            begins.insert(k, start)
            ends.insert(k, end)
            out.append((start, end, name, dice))
        return sorted(out)

    def places(self, text: bytes, pairs: np.ndarray, fits: list[int]) -> list[tuple[str, int, int, float]]:
        """(licence, first line, lines, Dice) of the places chosen by score."""
        chosen = self.windows(pairs, fits)
        if not chosen:
            return []
        words = [w.start() for w in _WORDS.finditer(text.lower())]
        breaks = [b.start() for b in re.finditer(rb"\n", text)]
        out = []
        for start, end, name, dice in chosen:
            first = bisect_left(breaks, words[start])
            out.append((name, first, bisect_left(breaks, words[end]) - first + 1, dice))
        return out


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``id``, ``hash``, ``found``, its matching units, and
    ``places``, its matching windows, in text order (licence, first_line,
    n_lines, dice)."""
    rows = docs.select(docs[id_col].alias("id"), text_hash(docs[text_col]).alias("hash"), docs[text_col].alias("text"))
    found = "array<struct<licence:string,first_line:int,n_lines:int,dice:double>>"
    schema = T.StructType([rows.schema["id"], rows.schema["hash"], *(T.StructField(c, T._parse_datatype_string(found)) for c in ("found", "places"))])

    def task(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        def listed(matches):
            return [dict(zip(("licence", "first_line", "n_lines", "dice"), m, strict=True)) for m in matches]

        scanner, kinds = Scanner(templates, threshold), to_arrow_schema(schema)
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            found, places = [], []
            for text, held in zip(texts, scanner.candidates(texts), strict=True):
                found.append(listed(scanner.scan(text, held[1])) if held else [])
                places.append(listed(scanner.places(text, *held)) if held else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, kinds.field("found").type), pa.array(places, kinds.field("places").type)], schema=kinds)

    return rows.mapInArrow(task, schema)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = F.array_min(F.transform("places", lambda m: F.struct((-m["dice"]).alias("d"), m["licence"].alias("l"))))
    # Matching units, and the places that no unit holds.
    held = lambda p: F.exists("found", lambda u: (u["first_line"] <= p["first_line"]) & (p["first_line"] + p["n_lines"] <= u["first_line"] + u["n_lines"]))
    apart = F.filter("places", lambda p: ~held(p))
    return scan(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), best["l"].alias("licence"), (-best["d"]).alias("dice"), (F.size("found") + F.size(apart)).cast("bigint").alias("n_units"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("places", lambda m: m["licence"]))), ",").alias("licences"),
    )
