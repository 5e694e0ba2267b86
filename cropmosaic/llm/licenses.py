"""License scans: templates with optional and replaceable regions, compiled into one token automaton.

A template is a text with markup:
    <<beginOptional>> ... <<endOptional>>   words that may be absent; may be nested
    <<var;words=2-40>>                      any words, 2 to 40 of them
All other words are mandatory and must match exactly, one after the other.
"""

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropmosaic.llm.importance import text_words

_MARK = re.compile(r"<<(beginOptional|endOptional|var;words=(\d+)-(\d+))>>")


@dataclass(frozen=True)
class Template:
    """Marked-up wording and the label it gives; `base` templates are plain phrases whose places are reported."""

    label: str
    markup: str
    base: bool = False


# The phrases of the contract, and wordings of well-known public licenses and notices.
BASE = (
    Template("mit", "mit license", True),
    Template("apache", "apache license", True),
    Template("gpl", "general public license", True),
)
NOTICES = (
    Template("mit-notice", "released under the <<beginOptional>>terms of the<<endOptional>> MIT license"),
    Template("mit-notice", "licensed under the <<beginOptional>>terms of the<<endOptional>> MIT license"),
    Template(
        "apache-2.0-notice",
        "licensed under the Apache License<<beginOptional>>,<<endOptional>> <<beginOptional>>Version<<endOptional>> 2.0"
        '<<beginOptional>> (the "License"); you may not use this file except in compliance with the License<<endOptional>>',
    ),
    Template(
        "gpl-3.0-notice",
        "licensed under the <<beginOptional>>terms of the<<endOptional>> <<beginOptional>>GNU<<endOptional>> General Public License"
        " <<beginOptional>>as published by the Free Software Foundation,<<endOptional>> <<beginOptional>>either<<endOptional>> version 3"
        "<<beginOptional>> of the License, or (at your option) any later version<<endOptional>>",
    ),
    Template(
        "gpl-2.0-notice",
        "licensed under the <<beginOptional>>terms of the<<endOptional>> <<beginOptional>>GNU<<endOptional>> General Public License"
        " <<beginOptional>>as published by the Free Software Foundation,<<endOptional>> <<beginOptional>>either<<endOptional>> version 2"
        "<<beginOptional>> of the License, or (at your option) any later version<<endOptional>>",
    ),
    Template("cc-by-nc-4.0", "licensed under <<beginOptional>>a<<endOptional>> CC BY-NC 4.0<<beginOptional>> International License<<endOptional>>"),
    Template("cc-by-sa-4.0", "licensed under <<beginOptional>>a<<endOptional>> CC BY-SA 4.0<<beginOptional>> International License<<endOptional>>"),
    Template("cc-by-4.0", "licensed under <<beginOptional>>a<<endOptional>> CC BY 4.0<<beginOptional>> International License<<endOptional>>"),
)
TEXTS = (
    Template(
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of "
        "<<var;words=1-12>> to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> "
        "shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND <<beginOptional>>NON<<endOptional>> <<var;words=1-1>>. "
        "IN NO EVENT SHALL <<var;words=1-20>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
        "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    Template(
        "isc-text",
        "Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND <<var;words=1-20>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS",
    ),
    Template(
        "bsd-text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. <<beginOptional>>2.<<endOptional>> Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. <<beginOptional>><<beginOptional>>3.<<endOptional>> Neither the name of <<var;words=1-20>> "
        "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission.<<endOptional>> THIS SOFTWARE IS PROVIDED BY <<var;words=1-20>> \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES",
    ),
    Template("public-domain", "This is free and unencumbered software released into the public domain"),
)
TEMPLATES = BASE + NOTICES + TEXTS


@dataclass
class Wording:
    """A parsed template: its words in order (None: any word) and the jumps that pass over positions."""

    words: list[bytes | None] = field(default_factory=list)
    jumps: list[tuple[int, int]] = field(default_factory=list)

    @property
    def mandatory(self) -> int:
        """Words of the template outside all regions."""
        inside = {i for a, b in self.jumps for i in range(a, b)}
        return sum(w is not None and i not in inside for i, w in enumerate(self.words))


def parse(markup: str) -> Wording:
    """Markup -> words and jumps. Raises ValueError for open regions, or without any mandatory word at start and end."""
    out, open_, at = Wording(), [], 0
    for m in [*_MARK.finditer(markup), None]:
        out.words += text_words(markup[at : m.start() if m else len(markup)].encode())
        if m is None:
            break
        at = m.end()
        if m[1] == "beginOptional":
            open_.append(len(out.words))
        elif m[1] == "endOptional":
            if not open_:
                raise ValueError(f"<<endOptional>> without a beginning: {markup[:60]}")
            out.jumps.append((open_.pop(), len(out.words)))
        else:
            least, most = int(m[2]), int(m[3])
            if not 0 <= least <= most:
                raise ValueError(f"not a range of words: {m[0]}")
            start = len(out.words)
            out.words += [None] * most
            out.jumps += [(start + i, start + most) for i in range(least, most)]
    if open_ or not out.mandatory:
        raise ValueError(f"open region or no mandatory word: {markup[:60]}")
    return out


class Automaton:
    """All wordings side by side, the state a number with one bit for each position (the word that must come next).

    A word moves every bit whose position accepts it one up; jumps then set the bits behind the
    regions that may end or be absent. The bit behind the last word accepts.
    """

    def __init__(self, wordings: Sequence[Wording]):
        self.start, self.any, self.accepting = 0, 0, 0
        self.accepts: dict[bytes, int] = {}
        self.owner: dict[int, int] = {}
        jumps, at = [], 0
        for n, w in enumerate(wordings):
            for i, word in enumerate(w.words):
                if word is None:
                    self.any |= 1 << at + i
                else:
                    self.accepts[word] = self.accepts.get(word, 0) | 1 << at + i
            jumps += [(at + a, at + b) for a, b in w.jumps]
            self.start |= 1 << at
            at += len(w.words)
            self.accepting |= 1 << at
            self.owner[at] = n
            at += 1
        targets: dict[int, int] = {}
        for a, b in jumps:
            targets[b] = targets.get(b, 0) | 1 << a
        # all jumps go up, so one turn in the order of their targets follows chains of jumps too
        self.jumps = sorted((b, a) for b, a in targets.items())
        self.jumping = sum(1 << i for i in {a for a, _ in jumps})
        self.start = self.closed(self.start)
        self.accepts = {w: bits | self.any for w, bits in self.accepts.items()}

    def closed(self, state: int) -> int:
        if state & self.jumping:
            for to, sources in self.jumps:
                if state & sources:
                    state |= 1 << to
        return state

    def ends(self, words: Sequence[bytes]) -> list[tuple[int, int]]:
        """(template, number of words read) wherever a match that starts at any word ends."""
        found, state, start, get, other = [], self.start, self.start, self.accepts.get, self.any
        for i, word in enumerate(words):
            bits = get(word)
            if bits is None:
                if state == start and not start & other:
                    continue
                bits = other
            state = self.closed((state & bits) << 1) | start
            hit = state & self.accepting
            while hit:
                low = hit & -hit
                found.append((self.owner[low.bit_length() - 1], i + 1))
                hit ^= low
        return found

    def longest(self, words: Sequence[bytes]) -> int:
        """Number of words of the longest match from the first word on, 0 without any."""
        state, best = self.start, 0
        for i, word in enumerate(words):
            state = self.closed((state & self.accepts.get(word, self.any)) << 1)
            if state & self.accepting:
                best = i + 1
            if not state:
                break
        return best


def _reversed(w: Wording) -> Wording:
    n = len(w.words)
    return Wording(w.words[::-1], [(n - b, n - a) for a, b in w.jumps])


class Scanner:
    """Finds the places of all templates in a list of words."""

    def __init__(self, templates: Sequence[Template]):
        self.templates = list(templates)
        parsed = [parse(t.markup) for t in self.templates]
        self.automaton = Automaton(parsed)
        self.backward = [Automaton([_reversed(w)]) for w in parsed]
        self.most = [len(w.words) for w in parsed]

    def spans(self, words: Sequence[bytes]) -> list[tuple[int, int, int]]:
        """(template, start, end) for each end of a match, with its earliest start; words from 0, the end not included."""
        out = []
        for n, end in self.automaton.ends(words):
            back = words[max(0, end - self.most[n]) : end][::-1]
            out.append((n, end - self.backward[n].longest(back), end))
        return out


def covered(spans: list[tuple[int, int]]) -> int:
    """Words that stand in at least one span."""
    total, last = 0, 0
    for a, b in sorted(spans):
        total += max(0, b - max(a, last))
        last = max(last, b)
    return total


_FOUND = (
    "n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, "
    "score double, spans array<struct<label:string,start:long,end:long>>"
)


def scan(text: Column, templates: Sequence[Template] = TEMPLATES) -> Column:
    """Struct of what a text holds of the templates.

    n_base, first_word, last_word: places of base templates, their smallest and largest start;
    base_labels and labels: distinct, sorted; score: share of the words that stand in a match of
    any template, 0 without words; spans: (label, start, end) of every match, in order of their
    ends, each with its earliest start. NULL and empty texts have no words; the text is read whole.
    """
    scanner = Scanner(templates)
    names, base = [t.label for t in scanner.templates], [t.base for t in scanner.templates]

    @F.pandas_udf(_FOUND)
    def found(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            words = text_words(t)
            spans = scanner.spans(words)
            starts = [a for n, a, _ in spans if base[n]]
            score = covered([(a, b) for _, a, b in spans]) / len(words) if spans else 0.0
            rows.append(
                (
                    len(words),
                    len(starts),
                    min(starts, default=None),
                    max(starts, default=None),
                    sorted({names[n] for n, _, _ in spans if base[n]}),
                    sorted({names[n] for n, _, _ in spans}),
                    score,
                    [{"label": names[n], "start": a, "end": b} for n, a, b in spans],
                )
            )
        frame = pd.DataFrame(rows, columns=["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])
        return frame.astype({"first_word": "Int64", "last_word": "Int64"})

    return found(text.cast("string").cast("binary"))


def license_scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """One row per document: doc_id and the fields of scan(). Row by row; an empty table gives none."""
    found = docs.select(F.col(key).alias("doc_id"), scan(F.col(text), templates).alias("_found"))
    return found.select("doc_id", "_found.*")
