"""Licence wording in documents, by templates with optional and replaceable regions.

A template is a licence's wording with the markup that licence lists publish:
``<<beginOptional>>...<<endOptional>>`` round what may be missing, and
``<<var;name="...";original="...";match="...">>`` for what may differ, where ``match`` is ``.*`` or
``.+`` (any words), or alternatives parted by ``|``.  All else is mandatory.  A template is compiled
into an automaton over words: states for places in the wording, transitions on words, on any word
inside a replaceable region, and on nothing past an optional one.  It accepts a stretch of words
only where all mandatory wording stands there exactly, in order and without a word between.

Each text is read once, piece by piece; an automaton keeps, for every state it is in, the first word
from which that state was reached, so the work grows with words times states and never with the
number of places at which a match might start.  A template is only tried on texts that hold all of
its mandatory words.

Words are lower-cased A to Z and split at all ASCII characters but digits and letters.  Null and
empty texts have no words, no labels and a score of 0.  Repeated rows are judged each.  An empty
table gives no rows.  Columns besides id and text are ignored.  The score is m / (m + 1), where m is
the number of mandatory words of the longest wording found, base phrases among them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from areaweave.llm.common import pick

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BREAK = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
#: Bytes of a text whose words are held at once.
PIECE = 1_000_000
#: The phrases that are always looked for, and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

_OPEN = '<<beginOptional>>'
_CLOSE = '<<endOptional>>'
_THIS = '<<beginOptional>>this <<var;name="thing";original="software";match="software|program|work|project|code|file|text">> is<<endOptional>> '
_UNDER = '<<var;name="verb";original="licensed";match="licensed|released|distributed|available|published">> under '
_TERMS = 'the <<beginOptional>>terms of the<<endOptional>> '
_HOLDER = '<<beginOptional>>Copyright <<beginOptional>>(c)<<endOptional>> <<var;name="holder";original="year and holder";match=".+">><<endOptional>> '
_VERSION = '<<var;name="word";original="version";match="version|v">> '
_PUBLISHED = '<<beginOptional>>as published by the Free Software Foundation<<endOptional>> <<beginOptional>>either<<endOptional>> '

#: Published wordings, with the markup of their templates.
TEMPLATES = {
    "MIT": _HOLDER + """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
        and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be
        included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF
        ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
        PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;name="holder";original="THE AUTHORS OR COPYRIGHT HOLDERS";match=".+">>
        BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
        OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "MIT-notice": _THIS + _UNDER + _TERMS + "MIT license",
    "ISC": _HOLDER + """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE
        IS PROVIDED "AS IS" AND <<var;name="holder";original="THE AUTHOR";match=".+">> DISCLAIMS ALL WARRANTIES WITH REGARD TO
        THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.""",
    "BSD-2-Clause": _HOLDER + """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must
        retain the above copyright notice, this list of conditions and the following disclaimer.
        <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above copyright notice, this list
        of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. THIS SOFTWARE IS PROVIDED BY <<var;name="holder";original="THE COPYRIGHT HOLDERS";match=".+">> "AS IS\"""",
    "BSD-3-Clause": _HOLDER + """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must
        retain the above copyright notice, this list of conditions and the following disclaimer.
        <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above copyright notice, this list
        of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. <<beginOptional>>3.<<endOptional>> Neither the name of <<var;name="holder";original="the copyright holder";match=".+">>
        nor the names of its contributors may be used to endorse or promote products derived from this software without
        specific prior written permission.""",
    "Apache-2.0-notice": _THIS + 'Licensed under the Apache License ' + _VERSION + "2.0",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at <<var;name="place";original="address";match=".+">>
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
    "GPL-2.0": 'GNU General Public License ' + _PUBLISHED + _VERSION + "2",
    "GPL-3.0": 'GNU General Public License ' + _PUBLISHED + _VERSION + "3",
    "LGPL": 'GNU <<var;name="kind";original="Lesser";match="lesser|library">> General Public License',
    "AGPL-3.0": 'GNU Affero General Public License ' + _PUBLISHED + _VERSION + "3",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at <<var;name="place";original="address";match=".+">> MPL 2.0""",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC-BY-4.0": '<<var;name="name";original="CC BY";match="cc by|creative commons attribution">> 4.0',
    "CC-BY-SA-4.0": '<<var;name="name";original="CC BY-SA";match="cc by sa|creative commons attribution sharealike">> 4.0',
    "CC-BY-NC-4.0": '<<var;name="name";original="CC BY-NC";match="cc by nc|creative commons attribution noncommercial">> 4.0',
    "reserved": "All rights reserved",
}

#: Words, ("any", least number), ("one of", alternatives of words) and ("maybe", items) in their order.
Item = bytes | tuple


def words_of(text: str) -> list[bytes]:
    return WORD.findall(text.encode().lower())


def read_template(text: str) -> list[Item]:
    """The items of a template."""
    open_items: list[list[Item]] = [[]]
    for part in re.split(r"(<<.*?>>)", text, flags=re.DOTALL):
        if part == _OPEN:
            open_items.append([])
        elif part == _CLOSE:
            if len(open_items) < 2:
                raise ValueError("an optional region ends that has not begun")
            inside = open_items.pop()
            open_items[-1].append(("maybe", inside))
        elif part.startswith("<<var;"):
            match = re.search(r'match="([^"]*)"', part)
            if match is None:
                raise ValueError(f"no match in {part!r}")
            if match[1] in (".*", ".+"):
                open_items[-1].append(("any", int(match[1] == ".+")))
            else:
                open_items[-1].append(("one of", [words_of(choice) for choice in match[1].split("|")]))
        elif part.startswith("<<"):
            raise ValueError(f"unknown markup {part!r}")
        else:
            open_items[-1] += words_of(part)
    if len(open_items) > 1:
        raise ValueError("an optional region does not end")
    return open_items[0]


@dataclass
class Automaton:
    """States from 0; ``step`` by word, ``loop`` on any word, ``skip`` on nothing; one state accepts."""

    label: str
    mandatory: list[bytes] = field(default_factory=list)
    step: list[dict[bytes, set[int]]] = field(default_factory=lambda: [{}])
    any_word: list[set[int]] = field(default_factory=lambda: [set()])
    skip: list[set[int]] = field(default_factory=lambda: [set()])
    accept: int = 0

    def _state(self) -> int:
        self.step.append({})
        self.any_word.append(set())
        self.skip.append(set())
        return len(self.step) - 1

    def _chain(self, at: int, words: Iterable[bytes]) -> int:
        for word in words:
            after = self._state()
            self.step[at].setdefault(word, set()).add(after)
            at = after
        return at

    def _build(self, items: Sequence[Item], at: int, mandatory: bool) -> int:
        for item in items:
            if isinstance(item, bytes):
                at = self._chain(at, [item])
                if mandatory:
                    self.mandatory.append(item)
                continue
            kind, inside = item
            after = self._state()
            if kind == "maybe":
                self.skip[self._build(inside, at, False)].add(after)
                self.skip[at].add(after)
            elif kind == "any":
                for _ in range(inside):
                    first = self._state()
                    self.any_word[at].add(first)
                    at = first
                self.any_word[after].add(after)
                self.skip[at].add(after)
            else:
                for words in inside:
                    self.skip[self._chain(at, words)].add(after)
            at = after
        return at

    def _past(self, states: Iterable[int]) -> frozenset[int]:
        found, todo = set(), list(states)
        while todo:
            state = todo.pop()
            if state not in found:
                found.add(state)
                todo += self.skip[state]
        return frozenset(found)

    def finish(self) -> Automaton:
        """Replaces skips by what they lead to."""
        self.start = self._past([0])
        self.begins = {word for state in self.start for word in self.step[state]}
        self.step = [{word: self._past(to) for word, to in by_word.items()} for by_word in self.step]
        self.any_word = [self._past(to) for to in self.any_word]
        self.needed = sorted(set(self.mandatory), key=len, reverse=True)
        return self


def compile_template(label: str, text: str) -> Automaton:
    automaton = Automaton(label)
    automaton.accept = automaton._build(read_template(text), 0, True)
    if not automaton.mandatory:
        raise ValueError(f"template {label!r} has no mandatory word")
    automaton.finish()
    if any(automaton.any_word[s] for s in automaton.start) or automaton.accept in automaton.start:
        raise ValueError(f"template {label!r} may begin with any word")
    return automaton


class Run:
    """An automaton at work on one text: takes words in turn, gives (first word, end) of what it accepts."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.since: dict[int, int] = {}
        self.found: dict[int, int] = {}

    def take(self, words: list[bytes], at: int) -> None:
        step, any_word, start = self.automaton.step, self.automaton.any_word, self.automaton.start
        begins, accept, since = self.automaton.begins, self.automaton.accept, self.since
        for n, word in enumerate(words, at):
            if not since and word not in begins:
                continue
            after: dict[int, int] = {}
            if word in begins:
                for state in start:
                    for to in step[state].get(word, ()):
                        after[to] = n
            for state, first in since.items():
                for to in (*step[state].get(word, ()), *any_word[state]):
                    if after.get(to, first) >= first:
                        after[to] = first
            since = after
            if accept in since:
                self.found[since[accept]] = n + 1
        self.since = since


def pieces(low: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """Words of a lower-cased text, some at a time; no word is cut."""
    at = 0
    while at < len(low):
        end = at + size
        if end < len(low):
            mark = BREAK.search(low, end)
            end = mark.start() if mark else len(low)
        yield WORD.findall(low, at, end)
        at = end


def scan_text(text: str, phrases: Sequence[tuple[Automaton, str]], templates: Sequence[Automaton],
              size: int = PIECE) -> tuple[int, dict[str, list[int]], list[tuple[str, int, int]], int]:
    """Number of words, places of the phrases by label, (label, first word, end) of each wording, longest wording."""
    low = text.encode().lower()
    tried = [(Run(a), label) for a, label in [*phrases, *[(t, None) for t in templates]] if all(w in low for w in a.needed)]
    n_words = 0
    for words in pieces(low, size):
        for run, _ in tried:
            run.take(words, n_words)
        n_words += len(words)
    places: dict[str, list[int]] = {}
    for run, label in tried:
        if label is not None and run.found:
            places.setdefault(label, []).extend(run.found)
    matches = sorted((run.automaton.label, first, end) for run, label in tried if label is None for first, end in run.found.items())
    longest = max((len(run.automaton.mandatory) for run, _ in tried if run.found), default=0)
    return n_words, places, matches, longest


RESULT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
          "matches array<struct<label:string,start:long,end:long>>, score double")
_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()),
          pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())])), pa.float64()]


def scan(docs: DataFrame, templates: dict[str, str] | None = None, phrases: Sequence[tuple[str, str]] = PHRASES,
         id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_words, places of the phrases (number, first, last, labels), all wordings found with their words, score.

    Of wordings that begin at one word, the longest is given for each template.
    """
    automata = [compile_template(label, text) for label, text in (TEMPLATES if templates is None else templates).items()]
    fixed = [(compile_template(text, text), label) for text, label in phrases]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                n_words, places, matches, longest = scan_text(text.as_py() or "", fixed, automata)
                at = sorted(p for found in places.values() for p in found)
                rows.append((doc, n_words, len(at), at[0] if at else None, at[-1] if at else None, sorted(places),
                             [dict(zip(("label", "start", "end"), m, strict=True)) for m in matches],
                             longest / (longest + 1)))
            columns = zip(*rows, strict=True) if rows else [[]] * len(_KINDS)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)],
                                             ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
                                              "matches", "score"])

    return pick(docs, doc_id=id_column, text=text_column).mapInArrow(run, RESULT)


def as_regex(items: Sequence[Item]) -> str:
    """The same wording over words with a space after each, for engines without these automata."""
    out = ""
    for item in items:
        if isinstance(item, bytes):
            out += item.decode() + " "
        elif item[0] == "maybe":
            out += f"(?:{as_regex(item[1])})?"
        elif item[0] == "any":
            out += "(?:[^ ]+ )" + ("+" if item[1] else "*")
        else:
            out += "(?:" + "|".join(as_regex(words) for words in item[1]) + ")"
    return out
