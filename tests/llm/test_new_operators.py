"""op11 to op13 against brute force on small tables, odd input, ties and hot groups."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cropmosaic.llm import divergence, importance, licenses
from llm_fixtures import make_docs, odd_docs  # noqa: F401

ITEMS = StructType([StructField("item_id", LongType()), StructField("text", StringType())])
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


# ---------------------------------------------------------------- op11


def brute_resample(docs, items, min_words=20, percent=25):
    """{row number: (doc_id, n_features, weight, score, rank)} of rows (doc_id, text)."""

    def features(text):
        w = words(text)
        return [zlib.crc32(f.encode()) % 10000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text))
    for text in items:
        t.update(features(text))
    n, m = sum(s.values()), sum(t.values())
    out = []
    for i, text in docs:
        f = features(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (n + 10000) / ((s[b] + 1) * (m + 10000)))) for b in f]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))))
    able = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = able[: percent * len(able) // 100]
    rest = Counter(r[:4] for r in out) - Counter(r[:4] for r in drawn)
    return sorted([(*r[:4], k + 1) for k, r in enumerate(drawn)] + [(*r, None) for r in rest.elements()], key=repr)


def got_resample(docs, items, **options):
    rows = importance.resample(docs, items, **options).select("doc_id", "n_features", "weight", "score", "rank").collect()
    return sorted(map(tuple, rows), key=repr)


def test_resample_brute_force(spark, make_docs):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(300)] + ["Été", "ÇA", "a1b2"]
    docs = [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 60))), "en", "a") for i in range(200)]
    docs += [(500, " ".join(["copy"] * 30), "en", "a")] * 40  # one id and text very often: tied in score, id and features
    docs += [(None, "x " * 25, "en", "a"), (None, None, None, None), (-(1 << 63), "y " * 25, None, None), ((1 << 63) - 1, "y " * 25, None, None)]
    items = [" ".join(rng.choice(vocabulary[:50], 40)), None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(items)], ITEMS)
    want = brute_resample([(i, t) for i, t, _, _ in docs], items)
    assert got_resample(make_docs(docs).repartition(5), df) == want
    assert got_resample(make_docs(docs, clash=False).coalesce(1), df) == want


def test_resample_cut_among_copies(spark, make_docs):
    docs = [(7, "same words " * 15, "en", "a")] * 30
    got = got_resample(make_docs(docs), spark.createDataFrame([(1, "other")], ITEMS), percent=50)
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 16)) and len(got) == 30


def test_resample_odd(spark, odd_docs, make_docs):
    items = spark.createDataFrame([(1, "quick brown fox")], ITEMS)
    want = brute_resample([(r["doc_id"], r["text"]) for r in odd_docs.collect()], ["quick brown fox"], min_words=9, percent=70)
    assert got_resample(odd_docs, items, min_words=9, percent=70) == want
    assert got_resample(odd_docs, items.limit(0)) == brute_resample([(r["doc_id"], r["text"]) for r in odd_docs.collect()], [])
    assert got_resample(make_docs([]), items) == []
    with pytest.raises(ValueError):
        importance.resample(items.select(F.col("text").alias("doc_id"), "text"), items)


def test_kth_largest(spark):
    values = [5, -3, 5, 5, 9, 0, -(1 << 62), 1 << 62, 8, 8]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for k in range(1, len(values) + 1):
        v = sorted(values, reverse=True)[k - 1]
        assert importance.kth_largest(df, F.col("v"), k) == (v, sum(x > v for x in values), values.count(v))


def test_ranks_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(importance, "ROWS_PER_RANGE", 7)
    df = spark.range(100).select(F.col("id"), (F.col("id") % 10).alias("score"))
    order = [F.col("score"), F.bitwise_not("id")]
    got = importance.with_rank(df, order, 100).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 101))
    assert [(r["score"], r["id"]) for r in got] == sorted(((i % 10, i) for i in range(100)), key=lambda r: (-r[0], r[1]))


# ---------------------------------------------------------------- op12


def brute_spans(markup, tokens):
    """All (start, end) at which a template matches, by trying every way through it."""
    w = licenses.parse(markup)
    jumps = defaultdict(list)
    for a, b in w.jumps:
        jumps[a].append(b)

    def ends(pos, at):
        if pos == len(w.words):
            yield at
            return
        for to in jumps[pos]:
            yield from ends(to, at)
        if at < len(tokens) and w.words[pos] in (None, tokens[at]):
            yield from ends(pos + 1, at + 1)

    return {(a, b) for a in range(len(tokens)) for b in ends(0, a)}


MARKUPS = [
    "a b",
    "a <<beginOptional>>b c<<endOptional>> d",
    "a <<var;words=0-2>> b",
    "<<beginOptional>>a<<endOptional>> b <<var;words=1-3>> c",
    "a <<beginOptional>>b <<beginOptional>>c<<endOptional>> <<var;words=1-1>><<endOptional>> <<beginOptional>>d<<endOptional>> a",
    "b c <<beginOptional>>a<<endOptional>>",
]


def test_automaton_brute_force():
    rng = np.random.default_rng(5)
    scanner = licenses.Scanner([licenses.Template(str(i), m) for i, m in enumerate(MARKUPS)])
    for n in [0, 1, 2, *rng.integers(3, 14, 300)]:
        tokens = [bytes(t) for t in rng.choice([b"a", b"b", b"c", b"d", b"x"], n)]
        got = scanner.spans(tokens)
        for i, m in enumerate(MARKUPS):
            want = brute_spans(m, tokens)
            earliest = {(min(a for a, b in want if b == end), end) for _, end in want}
            assert sorted((a, b) for k, a, b in got if k == i) == sorted(earliest), (m, tokens)
        inside = {p for m in MARKUPS for a, b in brute_spans(m, tokens) for p in range(a, b)}
        assert licenses.covered([(a, b) for _, a, b in got]) == len(inside)


@pytest.mark.parametrize("markup", ["<<beginOptional>>a", "a<<endOptional>>", "<<var;words=0-3>>", "a <<var;words=3-2>>", ""])
def test_bad_markup(markup):
    with pytest.raises(ValueError):
        licenses.parse(markup)


MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or "
    'substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING '
    "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
    "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)


def test_license_texts(spark, make_docs):
    cases = {
        1: ("MIT License\n\nCopyright (c) 2020 Someone\n\n" + MIT, {"mit", "mit-text"}),
        2: (MIT.replace("this software and associated documentation files (the \"Software\")", "the program"), {"mit-text"}),
        3: (MIT.replace("hereby granted", "granted"), set()),  # mandatory wording differs
        4: (MIT.replace("free of charge", "free of any charge"), set()),
        5: ("This work is licensed under the GNU General Public License, version 3.", {"gpl", "gpl-3.0-notice"}),
        6: ("licensed under the terms of the General Public License as published by the Free Software Foundation, either version 2 of the "
            "License, or (at your option) any later version.", {"gpl", "gpl-2.0-notice"}),
        7: ("Licensed under CC BY-NC 4.0. And the apache license, the MIT-license.", {"apache", "cc-by-nc-4.0", "mit"}),
        8: ("A license from MIT; the general public; license.", {"gpl"}),
        9: ("emit license, mit licenses", set()),
    }
    got = {r["doc_id"]: r for r in licenses.license_scan(make_docs([(i, t, None, None) for i, (t, _) in cases.items()])).collect()}
    assert {i: set(r["labels"]) for i, r in got.items()} == {i: labels for i, (_, labels) in cases.items()}
    assert got[2]["score"] == 1.0 and got[3]["score"] == 0.0 and 0.9 < got[1]["score"] < 1.0
    spans = {s["label"]: (s["start"], s["end"]) for s in got[6]["spans"]}
    assert spans["gpl-2.0-notice"] == (0, len(words(cases[6][0])))
    assert (got[7]["n_base"], got[7]["first_word"], got[7]["last_word"]) == (2, words(cases[7][0]).index("apache"), len(words(cases[7][0])) - 2)


def test_licenses_odd(odd_docs, make_docs):
    got = licenses.license_scan(odd_docs).collect()
    assert len(got) == odd_docs.count()
    texts = {r["doc_id"]: r["text"] for r in odd_docs.collect() if r["doc_id"] is not None}
    assert all(r["n_words"] == len(words(texts[r["doc_id"]])) for r in got if r["doc_id"] is not None)
    assert all((r["n_base"], r["first_word"], r["labels"], r["score"]) == (0, None, [], 0.0) for r in got)
    assert licenses.license_scan(make_docs([])).count() == 0


def test_licenses_long_and_hot(make_docs):
    n = 20_000
    docs = [(1, "mit license " * n, None, None)] + [(2, "word " * 100_000 + "apache license", None, None)]
    got = {r["doc_id"]: r for r in licenses.license_scan(make_docs(docs)).drop("spans").collect()}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["score"]) == (n, 0, 2 * n - 2, 1.0)
    assert (got[2]["n_base"], got[2]["first_word"]) == (1, 100_000)


# ---------------------------------------------------------------- op13


def brute_audit(docs, min_docs, top=50):
    """Rows of the audit for rows (lang, source, text)."""
    docs = [(la or "", so or "", TERM.findall((t or "").translate(LOWER))) for la, so, t in docs]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held = Counter(t for _, _, w in own for t in set(w))
        kept = [t for t, n in held.items() if n >= min_docs]
        counts = {s: Counter() for _, s, _ in own}
        for _, s, w in own:
            counts[s].update(t for t in w if held[t] >= min_docs)
        everywhere = sum(counts.values(), Counter())

        def p(c):
            return {t: 1 + 1000000000 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}

        ps, q = {s: p(c) for s, c in counts.items()}, p(everywhere)
        for s in counts:
            parts = {
                "pair": [(o, sum(abs(ps[s][t] - ps[o][t]) for t in kept)) for o in counts if o != s],
                "term": [(t, ps[s][t] - q[t]) for t in kept if counts[s][t] and ps[s][t] > q[t]],
            }
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, i, v, r + 1) for r, (i, v) in enumerate(items) if part == "pair" or r < top}
    return out


def audit_rows(df, **options):
    rows = [tuple(r) for r in divergence.audit(df, **options).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("tile,cells", [(512, 1 << 16), (2, 40)])
def test_audit_brute_force(make_docs, monkeypatch, tile, cells):
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "CELLS", cells)
    rng = np.random.default_rng(11)
    vocabulary = ["a", "é", "Ärger", "internationally", "internationalen", "internationalize", "x" * 40, "x" * 40 + "y", "日本", "to1do"]
    vocabulary += [f"t{chr(97 + i)}" for i in range(20)]
    docs = []
    for i in range(150):
        lang, source = rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", "S3", "é", None, "s5", "s6"])
        text = ", ".join(rng.choice(vocabulary, rng.integers(0, 30), p=None))
        docs.append((i % 90, text, lang, source))
    docs += [(1, "hot " * 500, "en", "s1")] * 60 + [(2, None, "xx", "s1"), (3, "", "xx", None), (4, "rare", "yy", "only")]
    got = audit_rows(make_docs(docs).repartition(3), min_docs=9, top=6)
    assert got == brute_audit([(la, s, t) for _, t, la, s in docs], 9, 6)
    assert ("xx", "", "pair", "s1", 0, 1) in got


def test_audit_odd(odd_docs, make_docs):
    rows = [(r["lang"], r["source"], r["text"]) for r in odd_docs.collect()]
    assert audit_rows(odd_docs, min_docs=1) == brute_audit(rows, 1)
    assert audit_rows(odd_docs) == brute_audit(rows, 30)
    assert audit_rows(make_docs([])) == set()


def test_sorted_pointers():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 50, 2000):
        terms = ["".join(rng.choice(list("ab"), rng.integers(1, 30))) for _ in range(n)] + ["a" * 200, "a" * 200, "a" * 199] * (n > 1)
        data = np.frombuffer(" ".join(terms).encode().replace(b" ", b"\0"), np.uint8)
        start, length, text = divergence.term_pointers(data, np.array([0, len(data)]))
        assert len(start) == len(terms)
        order, new = divergence.sort_pointers(data, start, length)
        assert order.tolist() == sorted(range(len(terms)), key=lambda i: (terms[i].encode(), i))
        spelled = [terms[i] for i in order]
        assert new.tolist() == [i == 0 or spelled[i] != spelled[i - 1] for i in range(len(spelled))]


def test_terms_end_with_their_text():
    data, offsets = np.frombuffer(b"ab" b"cd\0" b"" b"e", np.uint8), np.array([0, 2, 5, 5, 6])
    start, length, text = divergence.term_pointers(data, offsets)
    assert list(zip(start, length, text)) == [(0, 2, 0), (2, 2, 1), (5, 1, 3)]
