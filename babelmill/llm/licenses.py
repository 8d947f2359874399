"""Licence scans with template markup.

A template is licence wording with marked regions: ``<<beginOptional>> ... <<endOptional>>`` (nested or not) may be
absent, ``<<var;name="...";original="...";match="...">>`` stands for other words, as the regular expression ``match``
says (``.+`` where there is none). A template compiles to an automaton over normalised tokens: words in lower case
without the punctuation around them, with the spelling variants that licence matching treats as equal. A text is
accepted where all the mandatory wording stands in order and nothing else but what the regions allow.

What a replaceable region stands for is a run of whole tokens whose text, from its first token's first character to its
last token's last, fits ``match`` as a whole, in any case. ``.+``, ``.*`` and ``.{m,n}`` count the characters as they
are written and cross lines; for any other expression blanks and line feeds count as one space. No region has a limit
but its own. A region is as long as it can be for the longest match, but one of those three kinds after which no
wording must follow is as short as it may be, since nothing says where it ends.

Contract of ``scan_licenses``: a row (doc_id, license_id, start, end) for each match; offsets count characters of the
text, from the first token of the match to the end of its last.

* matches of one template don't overlap: leftmost first, and the longest from there. Matches of different templates
  that start at the same place yield the longest; ties go to the smaller license_id.
* NULL texts take no part, empty texts hold no match, NULL ids give rows with a NULL doc_id, repeated rows repeat.
* very long texts are scanned whole; an empty table gives an empty table; only id and text are read.
* a template that begins with a region, has no mandatory wording or unbalanced marks, or an expression that doesn't
  compile, is a ValueError.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blobs import tune

TOKEN = re.compile(r"\w+(?:[.'’\-‐-―]\w+)*|©")
MARK = re.compile(r"<<(beginOptional|endOptional|var;)(.*?)>>", re.S)
SAME = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense", "organisation": "organization",
    "organisations": "organizations", "authorised": "authorized", "favour": "favor", "honour": "honor", "judgement": "judgment",
    "merchantability": "merchantability", "noncommercial": "non-commercial", "per-cent": "percent", "wilful": "willful", "©": "copyright", "c": "copyright",
}


def token(word: str) -> str:
    word = re.sub(r"[‐-―]", "-", word.lower()).replace("’", "'")
    return SAME.get(word, word)


def tokens(text: str) -> list[tuple[str, int, int]]:
    return [(token(m.group()), m.start(), m.end()) for m in TOKEN.finditer(text)]


@dataclass(frozen=True)
class Region:
    """A replaceable region: any ``low`` to ``high`` characters (no end if None), or what ``pattern`` fits."""

    low: int
    high: int | None
    pattern: regex.Pattern | None
    lazy: bool
    after: frozenset[int]

    def fits(self, text: str, start: int, end: int) -> tuple[bool, bool]:
        """(whether the characters are what it stands for, whether more of them may be)."""
        if self.pattern is None:
            size = end - start
            full = self.low <= size and (self.high is None or size <= self.high)
            return full, (self.high is None or size < self.high) and not (self.lazy and full)
        held = " ".join(text[start:end].split())
        return self.pattern.fullmatch(held) is not None, self.pattern.fullmatch(held, partial=True) is not None


@dataclass(frozen=True)
class Automaton:
    """States 0..n-1; ``moves`` takes a state and a word on, ``regions`` has the region that a state enters; epsilon moves
    are closed in advance. ``first``: words a match can begin with."""

    name: str
    moves: tuple[dict[str, frozenset[int]], ...]
    regions: tuple[Region | None, ...]
    begin: frozenset[int]
    accept: int
    first: frozenset[str]
    mandatory: tuple[str, ...]

    def longest(self, text: str, found: list[tuple[str, int, int]], at: int) -> int:
        """The token after the longest match that begins at a token, or -1. A match in progress is a set of states and, for
        regions that are entered, where; a region that any number of characters fits has one place for all."""
        states, inside, best = self.begin, set(), -1
        while True:
            if self.accept in states:
                best = at
            if at == len(found):
                return best
            word, begin, end = found[at]
            after: set[int] = set()
            entered = {(s, begin) for s in states if self.regions[s] is not None} | inside
            inside = set()
            for s in states:
                after |= self.moves[s].get(word, frozenset())
            for s, start in entered:
                region = self.regions[s]
                full, more = region.fits(text, start, end)
                if full:
                    after |= region.after
                if more:
                    free = full and region.high is None and region.pattern is None
                    inside.add((s, -1 - region.low) if free else (s, start))
            if not after and not inside:
                return best
            states, at = frozenset(after), at + 1


def compile_template(name: str, template: str) -> Automaton:
    """The automaton of a template. Optional regions are bypassed by epsilon moves; a replaceable region is a state that
    reads tokens as long as its expression goes on."""
    eps: list[set[int]] = [set()]
    moves: list[dict[str, set[int]]] = [{}]
    open_regions: dict[int, tuple[int, int | None, regex.Pattern | None, int]] = {}
    mandatory: list[str] = []
    open_: list[int] = []

    def state() -> int:
        eps.append(set())
        moves.append({})
        return len(eps) - 1

    def literal(now: int, text: str) -> int:
        for word, _, _ in tokens(text):
            new = state()
            moves[now].setdefault(word, set()).add(new)
            if not open_:
                mandatory.append(word)
            now = new
        return now

    now = done = 0
    for mark in MARK.finditer(template):
        now = literal(now, template[done : mark.start()])
        done = mark.end()
        if mark.group(1) == "beginOptional":
            fresh = state()
            eps[now].add(fresh)
            open_.append(now)
            now = fresh
        elif mark.group(1) == "endOptional":
            if not open_:
                raise ValueError(f"{name}: an optional region ends that never began")
            fresh = state()
            eps[now].add(fresh)
            eps[open_.pop()].add(fresh)
            now = fresh
        else:
            match = re.search(r'match="(.*?)"', mark.group(2), re.S)
            pattern = match.group(1) if match else ".+"
            end = state()
            if re.fullmatch(r"[\w|-]+", pattern):  # plain alternatives are words like any other
                for word in pattern.split("|"):
                    moves[now].setdefault(token(word), set()).add(end)
                now = end
                continue
            entry = state()
            eps[now].add(entry)
            span = re.fullmatch(r"\.(?:(\+)|(\*)|\{(\d*)(,?)(\d*)\})", pattern)
            if span:
                low = 1 if span.group(1) else int(span.group(3) or 0)
                high = None if span.group(3) is None or span.group(4) and not span.group(5) else int(span.group(5) or low)
                open_regions[entry] = (low, high, None, end)
                empty = low == 0
            else:
                try:
                    compiled = regex.compile(pattern, regex.IGNORECASE)
                except regex.error as wrong:
                    raise ValueError(f"{name}: {pattern} isn't a regular expression: {wrong}") from wrong
                open_regions[entry] = (0, None, compiled, end)
                empty = compiled.fullmatch("") is not None
            if empty:
                eps[entry].add(end)
            now = end
    now = literal(now, template[done:])
    if open_:
        raise ValueError(f"{name}: an optional region never ends")

    def closure(start: set[int]) -> frozenset[int]:
        found, rest = set(start), list(start)
        while rest:
            for s in eps[rest.pop()]:
                if s not in found:
                    found.add(s)
                    rest.append(s)
        return frozenset(found)

    begin = closure({0})
    if now in begin or any(s in open_regions for s in begin) or not mandatory:
        raise ValueError(f"{name}: a template must begin with wording and have some that is mandatory")
    first = frozenset(w for s in begin for w in moves[s])
    closed = tuple({w: closure(to) for w, to in m.items()} for m in moves)
    regions: list[Region | None] = [None] * len(eps)
    for at, (low, high, pattern, end) in open_regions.items():
        after = closure({end})
        lazy = pattern is None and now in after
        if not lazy or low:
            regions[at] = Region(low, high, pattern, lazy, after)
    return Automaton(name, closed, tuple(regions), begin, now, first, tuple(mandatory))


# wording that several templates share
_PROGRAM = (
    'This <<var;name=what;match="program|software|file{what}">> is free software<<beginOptional>>:<<endOptional>> you can redistribute it and/or modify it under the terms of the'
    " GNU {license} General Public License as published by the Free Software Foundation<<beginOptional>>,<<endOptional>>"
)
_WARRANTY = (
    'This <<var;name=what;match="program|software|file|library">> is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of'
    " MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {license} General Public License for more details."
)
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
    <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
    <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
    documentation and/or other materials provided with the distribution."""
_AS_IS = """THIS SOFTWARE IS PROVIDED BY <<var;name=holder;match=".{1,5000}">> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
    WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var;name=liable;match=".{1,5000}">> BE LIABLE FOR ANY DIRECT,
    INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
    DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE
    OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

TEMPLATES: dict[str, str] = {
    "MIT-notice": "<<beginOptional>>This <<var;name=what;match=\"software|work|project|code|package|library\">> is<<endOptional>> <<var;name=verb;match=\"released|licensed|distributed|available\">> under the <<beginOptional>>terms of the<<endOptional>> MIT License",
    "Apache-2.0-notice": "Licensed under the Apache License <<beginOptional>>,<<endOptional>> Version 2.0 <<beginOptional>>(the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at<<endOptional>>",
    "GPL-3.0-notice": "This <<var;name=what;match=\"work|program|software|file|library\">> is licensed under the <<beginOptional>>terms of the<<endOptional>> GNU General Public License <<beginOptional>>,<<endOptional>> version 3 <<beginOptional>>or any later version<<endOptional>>",
    "GPL-2.0-notice": "This <<var;name=what;match=\"work|program|software|file|library\">> is licensed under the <<beginOptional>>terms of the<<endOptional>> GNU General Public License, version 2 <<beginOptional>>or any later version<<endOptional>>",
    "CC-BY-NC-4.0-notice": "Licensed under <<beginOptional>>a Creative Commons license<<endOptional>> CC BY-NC 4.0 <<beginOptional>>International<<endOptional>>",
    "CC-BY-SA-4.0-notice": "Licensed under <<beginOptional>>a Creative Commons license<<endOptional>> CC BY-SA 4.0 <<beginOptional>>International<<endOptional>>",
    "CC-BY-4.0-notice": "Licensed under <<beginOptional>>a Creative Commons license<<endOptional>> CC BY 4.0 <<beginOptional>>International<<endOptional>>",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at <<var;name=url;match=\"\\S+\">>",
    "reserved": "<<beginOptional>>Copyright <<var;name=year;match=\"[0-9]{4}(-[0-9]{4})?\">> <<var;name=holder;match=\".{1,120}\">><<endOptional>> All rights reserved",
    "GPL-header": f"""{_PROGRAM.format(what="", license="")} either version <<var;name=version;match="2|3">> of the License, or <<beginOptional>>(at your option)<<endOptional>> any later version.
        <<beginOptional>>{_WARRANTY.format(license="")}<<endOptional>>""",
    "LGPL-header": f"""{_PROGRAM.format(what="|library", license='<<var;name=less;match="Lesser|Library">>')} either version <<var;name=version;match="2|2.1|3">> of the License, or <<beginOptional>>(at your option)<<endOptional>> any later version.
        <<beginOptional>>{_WARRANTY.format(license='<<var;name=less;match="Lesser|Library">>')}<<endOptional>>""",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may
        obtain a copy of the License at <<var;name=url;match="\\S+">> Unless required by applicable law or agreed to in writing, software distributed under the
        License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
    "MIT": f"""<<beginOptional>><<beginOptional>>The<<endOptional>> MIT License <<beginOptional>>(MIT)<<endOptional>><<endOptional>> <<beginOptional>>Copyright <<var;name=copyright;match=".{{0,5000}}">><<endOptional>>
        Permission is hereby granted, free of charge, to any person obtaining a copy of <<var;name=software;match="this|the">> software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be
        included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT
        WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
        FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;name=holder;match=".{{1,5000}}">> BE
        LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING
        FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """<<beginOptional>>ISC License<<endOptional>> <<beginOptional>>Copyright <<var;name=copyright;match=".{0,5000}">><<endOptional>>
        Permission to use, copy, modify, <<var;name=conj;match="and/or|and|or">> distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all
        copies. <<beginOptional>>THE SOFTWARE IS PROVIDED "AS IS" AND <<var;name=author;match=".{1,5000}">> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
        INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;name=author;match=".{1,5000}">> BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
        NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.<<endOptional>>""",
    "BSD-2-Clause": f"{_BSD} {_AS_IS}",
    "BSD-3-Clause": f"""{_BSD} <<var;name=bullet;match=".{{0,20}}">> Neither the name of <<var;name=organization;match=".{{1,5000}}">> nor the names of its contributors may be used to
        endorse or promote products derived from this software without specific prior written permission. {_AS_IS}""",
    "BSD-condition": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer.""",
}


def anchors(automata: list[Automaton]) -> list[str]:
    """Substrings of which any text with a match has one: the longest mandatory word of each template, without what
    spelling variants change."""
    found = set()
    for one in automata:
        stable = [w for w in one.mandatory if w not in SAME.values() and w.isascii() and "'" not in w and "-" not in w]
        if any(w.startswith("licen") for w in one.mandatory):
            found.add("licen")
        elif stable:
            found.add(max(stable, key=lambda w: (len(w), w)))
        else:
            return [""]
    return sorted(w for w in found if not any(o != w and o in w for o in found))


def match_text(text: str, automata: list[Automaton]) -> list[tuple[str, int, int]]:
    """(license_id, start, end) of the matches in a text, in order."""
    found = tokens(text)
    last = {word: i for i, (word, _, _) in enumerate(found)}
    until: dict[str, int] = {}  # the last token at which all of a template's wording can still follow
    by_first: dict[str, list[Automaton]] = {}
    for one in automata:
        until[one.name] = min(last.get(word, -1) for word in one.mandatory)
        for word in one.first if until[one.name] >= 0 else ():
            by_first.setdefault(word, []).append(one)
    out: list[tuple[str, int, int]] = []
    busy: dict[str, int] = {}
    for i, (word, _, _) in enumerate(found):
        best: tuple[int, str] | None = None
        for one in by_first.get(word, ()):
            if busy.get(one.name, 0) <= i <= until[one.name] and (end := one.longest(text, found, i)) > i:
                busy[one.name] = end
                if best is None or (-end, one.name) < best:
                    best = (-end, one.name)
        if best:
            out.append((best[1], found[i][1], found[-best[0] - 1][2]))
    return out


def scan_licenses(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", templates: dict[str, str] | None = None) -> DataFrame:
    """All licence matches. The JVM keeps the texts that hold an anchor, which loses nothing; the rest is one narrow stage."""
    tune(df.sparkSession)
    automata = [compile_template(name, text) for name, text in sorted((templates or TEMPLATES).items())]
    docs = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    low = F.lower("text")
    docs = docs.where(reduce(lambda a, b: a | b, [low.contains(word) for word in anchors(automata)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(doc, *hit) for doc, text in zip(*(c.to_pylist() for c in batch.columns)) for hit in match_text(text, automata)]
            if rows:
                doc, name, start, end = zip(*rows)
                columns = [pa.array(doc, pa.int64()), pa.array(name), pa.array(start, pa.int32()), pa.array(end, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "license_id", "start", "end"])

    return docs.mapInArrow(run, "doc_id long, license_id string, start int, end int")
