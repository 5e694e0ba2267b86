"""Language identification by cross-parsing against suffix automata of labelled text."""

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cropmosaic.llm.common import fold, id_text, unit_hash

#: The automaton of a language is built from at most FIT_CHARACTERS of labelled text, at most
#: FIT_PER_DOCUMENT of one document, taking documents of the smallest id hashes. Texts to be
#: judged are read whole, each as one parse, many side by side.
FIT_CHARACTERS, FIT_PER_DOCUMENT, FIT_DOCUMENTS, MAX_LANGUAGES = 32_000, 1_000, 64, 100
#: Every letter of the samples has a code: 0 is a letter that none holds, 1 stands for all that is no letter. The
#: DENSE commonest have a column of the tables, the others are looked up among the transitions that exist.
DENSE = 62
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    """Languages, their sample texts, and all their letters, the commonest first."""

    languages: tuple[str, ...]
    samples: tuple[str, ...]
    characters: str


def _letters(text: str) -> str:
    """Small letters; each run of other characters becomes one blank."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", held_out: tuple[int, int] = (4, 2)) -> Model:
    """The model from documents with text and language whose crc32(id) mod held_out[0] is not held_out[1].

    Only the bounded sample named above comes to the driver. More than MAX_LANGUAGES labels are
    an error; without any labelled row no language is known.
    """
    rows = docs.select(F.col(key).alias("_id"), F.col(text).cast("string").alias("_text"), F.col(lang).cast("string").alias("_lang"))
    rows = rows.filter(F.col("_text").isNotNull() & F.col("_lang").isNotNull() & (fold(F.col("_id"), held_out[0]) != held_out[1]))
    order = Window.partitionBy("_lang").orderBy(unit_hash(F.lit("lang"), id_text(F.col("_id"))), "_id")
    rows = rows.select("_id", "_lang", F.substring("_text", 1, FIT_PER_DOCUMENT).alias("_text"))
    rows = rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= FIT_DOCUMENTS)
    parts: dict[str, list[str]] = {}
    for r in rows.orderBy("_lang", "_n").limit((MAX_LANGUAGES + 1) * FIT_DOCUMENTS).collect():
        parts.setdefault(r["_lang"], []).append(_letters(r["_text"]))
    if len(parts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    joined = {k: "\x00".join(v)[:FIT_CHARACTERS] for k, v in parts.items()}
    samples = {k: v for k, v in joined.items() if v.strip("\x00 ")}
    counts: dict[str, int] = {}
    for sample in samples.values():
        for c in sample:
            if c.isalpha():
                counts[c] = counts.get(c, 0) + 1
    letters = sorted(counts, key=lambda c: (-counts[c], c))
    return Model(tuple(samples), tuple(samples.values()), "".join(letters))


def automaton(codes: list[int]) -> list[dict[int, int]]:
    """Suffix automaton: the transitions of each state; state 0 is the root. A negative code ends a text."""
    step: list[dict[int, int]] = [{}]
    length, link, last = [0], [-1], 0
    for c in codes:
        if c < 0:
            last = 0
            continue
        if c in step[last]:
            q = step[last][c]
            if length[q] == length[last] + 1:
                last = q
                continue
            clone = _clone(step, length, link, last, c, q)
            last = clone
            continue
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            link[new] = q if length[q] == length[p] + 1 else _clone(step, length, link, p, c, q)
        last = new
    return step


def _clone(step: list[dict[int, int]], length: list[int], link: list[int], p: int, c: int, q: int) -> int:
    clone = len(step)
    step.append(dict(step[q]))
    length.append(length[p] + 1)
    link.append(link[q])
    link[q] = clone
    while p >= 0 and step[p].get(c) == q:
        step[p][c] = clone
        p = link[p]
    return clone


class Parser:
    """Tables of all languages: table[state, code] is 2 x next state, plus 1 where a phrase ends before the code.

    Where the automaton cannot go on, the longest match ends and the next phrase starts at the
    root with the same code. A code that the sample lacks is a phrase of its own and leads to the
    language's last state, where a text begins too: every code starts a phrase there. Transitions by
    codes without a column are sorted by (state, code) and found by bisection.
    """

    def __init__(self, model: Model):
        self.model = model
        self.code = np.zeros(0x110000, np.int32)
        known = {c: 2 + i for i, c in enumerate(model.characters)}
        self.width, self.codes_known = DENSE + 2, 2 + len(known)
        tables, self.roots, self.starts, base = [], [], [], 0
        rare: list[tuple[int, int]] = []
        for sample in model.samples:
            steps = automaton([-1 if c == "\x00" else known.get(c, 0 if c.isalpha() else 1) for c in sample])
            table = np.full((len(steps) + 1, self.width), -1, np.int64)
            for state, to in enumerate(steps):
                for c, q in to.items():
                    if c < self.width:
                        table[state, c] = 2 * (base + q)
                    else:
                        rare.append(((base + state) * self.codes_known + c, 2 * (base + q)))
            start = base + len(steps)
            root = np.where(table[0] >= 0, table[0], 2 * start) | 1
            tables.append(np.where(table >= 0, table, root[None, :]).astype(np.int32))
            self.roots.append(base)
            self.starts.append(start)
            base = start + 1
        self.table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)
        rare.sort()
        self.rare_keys = np.array([k for k, _ in rare] + [1 << 62], np.int64)
        self.rare_next = np.array([q for _, q in rare] + [-1], np.int32)
        for c, i in known.items():
            for form in {c, c.upper()}:
                if len(form) == 1:
                    self.code[ord(form)] = i
        self.letter: dict[int, bool] = {}
        self.norm = np.array([math.log2(max(2, len(s))) for s in model.samples])

    def _rare(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The table's entry for codes without a column: states (texts x languages), one code a text."""

        def next_of(at: np.ndarray) -> np.ndarray:
            key = at.astype(np.int64) * self.codes_known + code[:, None]
            place = np.searchsorted(self.rare_keys, key)
            return np.where(self.rare_keys[place] == key, self.rare_next[place], -1)

        on, start = next_of(state), 2 * np.array(self.starts, np.int32)[None, :]
        again = next_of(np.broadcast_to(np.array(self.roots, np.int32), state.shape))
        return np.where(on >= 0, on, np.where(again >= 0, again, start) | 1)

    def codes(self, text: str) -> np.ndarray:
        """Codes of the text's characters; each run of other characters than letters is one code 1."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        found = self.code[points]
        rest = np.flatnonzero(found == 0)
        if len(rest):
            kinds, where = np.unique(points[rest], return_inverse=True)
            for k in kinds:
                if int(k) not in self.letter:
                    self.letter[int(k)] = chr(k).isalpha()
            found[rest] = np.where(np.array([self.letter[int(k)] for k in kinds])[where], 0, 1)
        keep = np.ones(len(found), bool)
        keep[1:] = ~((found[1:] == 1) & (found[:-1] == 1))
        return found[keep]

    def phrases(self, codes: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text against each language: all texts go on by one character at a time."""
        order = np.argsort([-len(c) for c in codes], kind="stable")
        sizes = np.array([len(codes[i]) for i in order], np.int64)
        flat = np.concatenate([codes[i] for i in order]) if len(codes) else np.zeros(0, np.int32)
        start = np.cumsum(sizes) - sizes
        state = np.tile(2 * np.array(self.starts, np.int32), (len(codes), 1))
        count = np.zeros((len(codes), len(self.roots)), np.int32)
        longest = int(sizes[0]) if len(sizes) else 0
        live = np.searchsorted(-sizes, -np.arange(1, longest + 1), side="right")
        rare = flat >= self.width
        some_rare = bool(rare.any())
        column = np.where(rare, 0, flat)
        for t in range(longest):
            n = live[t]
            at = start[:n] + t
            now = (state[:n] >> 1) * self.width
            now += column[at, None]
            now = self.table[now]
            if some_rare:
                which = np.flatnonzero(rare[at])
                if len(which):
                    now[which] = self._rare(state[which] >> 1, flat[at[which]])
            state[:n] = now
            count[:n] += now & 1
        total = np.zeros((len(codes), len(self.roots)))
        total[order] = count
        return total

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.roots:
            return names, scores
        codes = [self.codes(t) if t else np.zeros(0, np.int32) for t in texts]
        judged = [i for i, c in enumerate(codes) if (c != 1).any()]
        # phrases of one text cost log2 of the sample's length each: bits per character, up to a factor
        cost = self.phrases([codes[i] for i in judged]) * self.norm
        for i, row in zip(judged, cost):
            order = np.argsort(row, kind="stable")
            best = row[order[0]]
            names[i] = self.model.languages[order[0]]
            scores[i] = 1.0 if len(row) == 1 else float(row[order[1]] / (best + row[order[1]]))
        return names, scores


_PARSERS: dict[int, Parser] = {}


def predict(text: Column, model: Model) -> Column:
    """Struct (lang, score) of a text column.

    The language with the fewest normalised phrases wins (ties: the first by name); score is the
    runner-up's share of the costs of the two, from 0.5 (no difference) to 1. NULL, and text
    without a letter, is `und` with score 0.
    """
    shared = model  # a bounded sample, sent with the function

    @F.pandas_udf("lang string, score double")
    def judge(texts: pd.Series) -> pd.DataFrame:
        key = hash(shared)
        if key not in _PARSERS:
            _PARSERS.clear()
            _PARSERS[key] = Parser(shared)
        names, scores = _PARSERS[key].predict(list(texts))
        return pd.DataFrame({"lang": names, "score": scores})

    return judge(text.cast("string"))
