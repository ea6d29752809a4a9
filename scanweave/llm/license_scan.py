"""Licence notices and texts in documents, by Dice coefficient over word bigrams."""

import math
from bisect import bisect_left
from collections import Counter, defaultdict
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# Licence notices and texts by SPDX identifier.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY "
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
        "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright to this work."),
)

_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. "
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
    "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
    "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)


def _gnu(work: str, name: str, version: str) -> str:
    return (
        f"{work} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as "
        f"published by the Free Software Foundation, either version {version} of the License, or (at your option) any "
        f"later version. {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        f"even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more "
        f"details. You should have received a copy of the GNU {name} along with this program. If not, see "
        "<https://www.gnu.org/licenses/>."
    )


# Texts of several paragraphs, looked for by windows only.
BODIES = (
    ("BSD-3-Clause", _BSD + _BSD_THIRD + _BSD_END),
    ("BSD-2-Clause", _BSD + _BSD_END),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("GPL-3.0", _gnu("This program", "General Public License", "3")),
    ("GPL-2.0", _gnu("This program", "General Public License", "2")),
    ("LGPL-3.0", _gnu("This library", "Lesser General Public License", "3")),
    ("AGPL-3.0", _gnu("This program", "Affero General Public License", "3")),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
)


_WORD = r"[\p{L}\p{N}]+"
_FOUND = "array<struct<license:string,score:double,segment:string>>"


class LicenseFinder:
    """Segments of texts whose word bigrams are close to a template, by the Dice coefficient of multisets, 2 * shared / (m + n).

    A segment of m bigrams can reach a coefficient d with a template of n only if 2 min(m, n) >= d (m + n), so m
    lies between n d / (2 - d) and n (2 - d) / d: templates of other sizes are never compared with it.
    """

    def __init__(self, templates, least: float):
        import regex

        self.least = least
        self.words_of = regex.compile(_WORD).findall
        self.templates, self.holders = [], defaultdict(list)
        for name, body in templates:
            words = self.words_of(body.lower())
            times = Counter(zip(words, words[1:]))
            n = sum(times.values())
            low, high = math.ceil(n * least / (2 - least) - 1e-9), math.floor(n * (2 - least) / least + 1e-9)
            for bigram, count in times.items():
                self.holders[bigram].append((len(self.templates), count))
            self.templates.append((name, n, low, high, times))
        self.lowest = min((low for _, _, low, _, _ in self.templates), default=0)

    def split(self, text: str) -> tuple[list[str], set[tuple[int, int]]]:
        """Words of a lower-case text, and the ranges of words of its lines, its paragraphs and the whole."""
        words, ranges, same = [], set(), {}
        for paragraph in text.split("\n\n"):
            opened = len(words)
            for line in paragraph.split("\n"):
                start = len(words)
                words += [same.setdefault(word, word) for word in self.words_of(line)]
                ranges.add((start, len(words)))
            ranges.add((opened, len(words)))
        return words, ranges | {(0, len(words))}

    def places(self, words: list[str]) -> dict[int, list[tuple[int, int]]]:
        """By template: the places of its bigrams, each with the one before which a segment must start to share it.

        A template that holds a bigram k times shares the k last of a segment at most; the place of the one k before
        is where the earlier segment would have used them up.
        """
        found, seen = defaultdict(list), defaultdict(list)
        holders = self.holders
        for at, bigram in [(i, pair) for i, pair in enumerate(zip(words, words[1:])) if pair in holders]:
            for template, times in holders[bigram]:
                earlier = seen[template, bigram]
                earlier.append(at)
                found[template].append((at, earlier[-1 - times] if len(earlier) > times else -1))
        return found

    def whole(self, words: list[str], ranges: set[tuple[int, int]], places) -> dict[tuple[str, str], float]:
        """Scores of (license, segment) for lines, paragraphs and the whole text."""
        scores: dict[tuple[str, str], float] = {}
        marks = sorted({at for found in places.values() for at, _ in found})
        for start, end in ranges:
            m = end - start - 1
            if m < self.lowest or bisect_left(marks, end - 1) - bisect_left(marks, start) < self.least * m / 2:
                continue
            for template, found in places.items():
                name, n, low, high, times = self.templates[template]
                if low <= m <= high:
                    here = found[bisect_left(found, (start,)) : bisect_left(found, (end - 1,))]
                    if len(here) >= self.least * (m + n) / 2 - 1e-9:
                        shared = sum((Counter((words[at], words[at + 1]) for at, _ in here) & times).values())
                        score = 2 * shared / (m + n)
                        if score >= self.least - 1e-9:
                            key = name, " ".join(words[start:end])
                            scores[key] = max(score, scores.get(key, 0.0))
        return scores

    def runs(self, words: list[str], places, whole=None) -> dict[tuple[str, str], float]:
        """Scores of (license, segment) for the best run of words anywhere, the first of equals, of every licence.

        A run that is part of a segment of `whole` (what matches as a line, a paragraph or a text) counts only if it
        is of another licence and closer to it than that segment is to its own.

        The best run of a template starts and ends with one of its bigrams. How many a run from a place can share at
        most, that of the longest, slides along with the places; only runs that can be better than the best so far are
        walked, and only until a longer one cannot be better.
        """
        outer = [(name, f" {segment} ", score) for (name, segment), score in (whole or {}).items()]
        best: dict[str, tuple[float, str]] = {}
        for template, found in places.items():
            name, n, low, high, _ = self.templates[template]
            # The place that counts once the one it waits for lies in front of the run.
            waiting = {back: k for k, (_, back) in enumerate(found) if back >= 0}
            most, end = 0, 0
            for i, (first, _) in enumerate(found):
                while end < len(found) and found[end][0] - first < high:
                    most += found[end][1] < first
                    end += 1
                bound = 2 * most / (max(low, most) + n)
                if bound >= self.least - 1e-9 and bound > best.get(name, (0.0,))[0]:
                    score, size = self._walk(found, i, n, high, most)
                    if score >= self.least - 1e-9 and score > best.get(name, (0.0,))[0]:
                        segment = " ".join(words[first : first + size + 1])
                        if not any(
                            (name == other or score <= its + 1e-9) and f" {segment} " in text for other, text, its in outer
                        ):
                            best[name] = score, segment
                most += (waiting.get(first, end) < end) - 1
        return {(name, segment): score for name, (score, segment) in best.items()}

    @staticmethod
    def _walk(found: list[tuple[int, int]], start: int, n: int, high: int, most: int) -> tuple[float, int]:
        """Best score of a run from a place, and its bigrams; the shortest of equals."""
        first, shared, best, size = found[start][0], 0, 0.0, 0
        for at, back in islice(found, start, None):
            length = at - first + 1
            if length > high or 2 * most <= best * (length + n):
                break
            shared += back < first
            if 2 * shared / (length + n) > best:
                best, size = 2 * shared / (length + n), length
        return best, size


@lru_cache(maxsize=4)
def _finder(templates, least: float) -> LicenseFinder:
    return LicenseFinder(templates, least)


def _by_text(text: Column, templates, least: float, find) -> Column:
    """`find(finder, words, ranges, places)` of every text as an array of (license, score, segment), best first, then by name.

    The texts are lower-cased before they are handed to Python.
    """

    @F.arrow_udf(_FOUND)
    def found(texts: pa.Array) -> pa.Array:
        finder = _finder(tuple(templates), least)
        lists = []
        for one in texts:
            words, ranges = finder.split(one.as_py())
            places = finder.places(words)
            scores = find(finder, words, ranges, places) if places else {}
            ordered = sorted((-score, name, segment) for (name, segment), score in scores.items())
            lists.append([{"license": name, "score": -minus, "segment": segment} for minus, name, segment in ordered])
        return pa.array(lists, pa.list_(pa.struct([("license", pa.string()), ("score", pa.float64()), ("segment", pa.string())])))

    return found(F.lower(F.coalesce(text.cast("string"), F.lit(""))))


def _hits(docs: DataFrame, templates, least: float, text: str, find) -> DataFrame:
    rows = docs.select(
        F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("text_key"),
        F.inline(_by_text(F.col(text), templates, least, find)),
    )
    return rows.select("text_key", "license", "segment", "score").distinct()


def license_hits(docs: DataFrame, templates=TEMPLATES, least: float = 0.8, text: str = "text") -> DataFrame:
    """`text_key` (MD5 of a text), `license`, `segment`, `score`: lines, paragraphs (parted by an empty line) and whole
    texts close to a template."""
    return _hits(docs, templates, least, text, lambda finder, words, ranges, places: finder.whole(words, ranges, places))


def window_hits(
    docs: DataFrame, hits: DataFrame, templates=TEMPLATES + BODIES, least: float = 0.8, text: str = "text"
) -> DataFrame:
    """`text_key`, `license`, `segment`, `score`: the best run of words of each licence anywhere in texts, without those that
    are part of one of `hits` and no better (see `LicenseFinder.runs`)."""
    runs = _hits(docs, templates, least, text, lambda finder, words, ranges, places: finder.runs(words, places))
    whole = hits.select(
        "text_key", F.col("license").alias("whole_license"), F.col("segment").alias("whole"), F.col("score").alias("whole_score")
    )
    inside = F.concat(F.lit(" "), "whole", F.lit(" ")).contains(F.concat(F.lit(" "), "segment", F.lit(" ")))
    beaten = (F.col("license") == F.col("whole_license")) | (F.col("score") <= F.col("whole_score") + 1e-9)
    return runs.alias("run").join(
        whole.alias("hit"), (F.col("run.text_key") == F.col("hit.text_key")) & inside & beaten, "left_anti"
    )


def scan_licenses(docs: DataFrame, templates=TEMPLATES, least: float = 0.8, text: str = "text") -> DataFrame:
    """One row per row of `docs`: `row`, a struct of all its columns, and `licenses`, an array of
    (license, score, segment), best score first, then by name; one entry per licence.

    Lines, paragraphs and whole texts are compared first, then runs of words anywhere in a text, so that a notice
    inside a sentence and a licence of several paragraphs in a longer document are found too.

    Null and empty texts have none; repeated rows stay and get the same licences; no rows give none;
    columns may have any names. Several templates of one licence, and several segments that match it, count
    as one licence with the best score (of segments that tie, one).

    Each text is split once, where it was read: no shuffle, and other columns do not pass through Python. A very long text
    costs a list of its words; work grows with its words and with the licence bigrams among them.
    """
    known = tuple(templates)
    more = known + (BODIES if templates is TEMPLATES else ())

    def find(finder, words, ranges, places):
        few = finder.whole(words, ranges, {t: at for t, at in places.items() if t < len(known)})
        best: dict[str, tuple[float, str]] = {}
        for (name, segment), score in [*few.items(), *finder.runs(words, places, few).items()]:
            best[name] = min(best.get(name, (0.0, "")), (-score, segment))
        return {(name, segment): -minus for name, (minus, segment) in best.items()}

    rows = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"))
    return rows.select("row", _by_text(F.col("row").getField(text), more, least, find).alias("licenses"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: DuckDB twin of the registered query for texts whose licences are whole lines, paragraphs or texts.
ORACLE = rf"""
WITH tpl AS (SELECT * FROM (VALUES {", ".join(f"({i}, {_quoted(a)}, {_quoted(b)})" for i, (a, b) in enumerate(TEMPLATES))})
  t(template, license, body)),
tw AS (SELECT template, license, regexp_extract_all(lower(body), '[\p{{L}}\p{{N}}]+') AS w FROM tpl),
tb AS (SELECT template, license, len(w) - 1 AS n, w, unnest(range(1, len(w))) AS i FROM tw),
tc AS (SELECT template, license, n, w[i] AS a, w[i + 1] AS b, count(*) AS times FROM tb GROUP BY ALL),
d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
s AS (SELECT DISTINCT body, unnest(list_distinct(list_concat(list_concat(string_split(body, chr(10)),
        string_split(body, chr(10) || chr(10))), [body]))) AS seg FROM d),
sw AS (SELECT body, seg, regexp_extract_all(lower(seg), '[\p{{L}}\p{{N}}]+') AS w FROM s),
sb AS (SELECT body, seg, len(w) - 1 AS m, w, unnest(range(1, len(w))) AS i FROM sw),
sc AS (SELECT body, seg, m, w[i] AS a, w[i + 1] AS b, count(*) AS seen FROM sb GROUP BY ALL),
sh AS (SELECT body, seg, license, template, m, n, sum(least(seen, times)) AS shared FROM sc JOIN tc USING (a, b) GROUP BY ALL),
best AS (SELECT body, license, max(2.0 * shared / (m + n)) AS score FROM sh
         WHERE 2.0 * shared / (m + n) >= 0.8 - 1e-9 GROUP BY ALL),
ranked AS (SELECT body, count(*) AS k, arg_min(license, (-score, license)) AS license, max(score) AS score FROM best GROUP BY body)
SELECT doc_id, coalesce(k, 0)::BIGINT AS n_licenses, license, round(score, 6) AS score FROM d LEFT JOIN ranked USING (body)
"""
