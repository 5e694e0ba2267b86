"""Odd input, and operators beyond what the registered queries show."""

import itertools
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from cropmosaic.llm import ann, decontamination, language_id, lm_scoring, mixing, quality, sharding, simhash, url_filter, warc
from cropmosaic.llm.components import components
from llm_fixtures import make_docs, odd_docs  # noqa: F401

ITEMS = StructType([StructField("item_id", LongType()), StructField("text", StringType())])
LABELS = StructType([StructField("doc_id", LongType()), StructField("quality", LongType())])
PAGES = StructType([StructField("page_id", LongType()), StructField("url", StringType()), StructField("html", StringType()), StructField("digest", StringType())])


def test_native_plan(spark, odd_docs):
    items = spark.createDataFrame([(1, "quick brown fox")], ITEMS)
    plan = decontamination.contamination(odd_docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_decontamination_odd(spark, odd_docs, make_docs):
    items = spark.createDataFrame([(10, "Quick BROWN fox"), (9, "of the"), (None, "lazy, dog"), (3, None), (4, ""), (5, "a b c d e f g h i j k")], ITEMS)
    got = decontamination.contamination(odd_docs, items).collect()
    assert len(got) == odd_docs.count()
    one = next(r for r in got if r["doc_id"] == 1)
    assert (one["n_words"], one["n_hit"], one["items"]) == (14, 5, ["", "10"])
    assert all(r["n_hit"] == 0 for r in got if r["doc_id"] not in (1, 2))
    repeated = [r for r in got if r["doc_id"] == 2]
    assert len(repeated) == 2 and repeated[0] == repeated[1]
    assert decontamination.contamination(odd_docs, items.limit(0)).filter("contaminated").count() == 0
    assert decontamination.contamination(make_docs([]), items).count() == 0


def test_decontamination_overlap(spark, make_docs):
    words = [f"w{i}" for i in range(30)]
    docs = make_docs([(1, "x " + " ".join(words[2:20]) + " y", "en", "a"), (2, " ".join(words[5:14]), "en", "a"), (3, "a a a a a a a a a a a a", "en", "a")])
    items = spark.createDataFrame([(1, " ".join(words)), (2, "a a a")], ITEMS)
    got = {r["doc_id"]: (r["n_hit"], r["items"]) for r in decontamination.contamination(docs, items).collect()}
    assert got == {1: (18, ["1"]), 2: (0, []), 3: (12, ["2"])}


def test_proximity(spark, make_docs):
    docs = make_docs([(1, "red one two green three blue", "en", "a"), (2, "red " + "x " * 40 + "green blue", "en", "a"), (3, "blue green red", "en", "a")])
    items = spark.createDataFrame([(7, "red green blue")], ITEMS)
    got = {r["doc_id"]: (r["item"], r["start"], r["end"]) for r in decontamination.near_phrases(docs, items, within=6).collect()}
    assert got == {1: ("7", 0, 5), 3: ("7", 0, 2)}


def test_proximity_against_all_intervals(spark, make_docs):
    """The case of a nearer place that leads nowhere, an item word that is absent, and random texts against brute force."""
    words = ["w%d" % i for i in range(30)]
    words[10], words[7], words[14], words[15] = "rare", "mid", "mid", "late"
    docs = [(1, " ".join(words)), (2, "rare mid"), (3, "late late mid rare mid"), (3, "late late mid rare mid"), (4, None), (5, "")]
    rng = np.random.default_rng(4)
    docs += [(10 + i, " ".join(rng.choice(list("abcdefg"), int(rng.integers(1, 40))))) for i in range(60)]
    items = [(1, "rare mid late"), (2, "a b c"), (3, "A, b; a"), (4, "a zzz"), (5, ""), (None, "f g e d")]
    got = decontamination.near_phrases(
        make_docs([(i, t, "en", "a") for i, t in docs]), spark.createDataFrame(items, ITEMS), within=6
    ).collect()
    want = set()
    for i, text in docs:
        text = (text or "").split()
        for item, phrase in items:
            terms = set("".join(c if c.isalnum() else " " for c in phrase.lower()).split())
            for end, w in enumerate(text):
                if w in terms and terms <= set(text[max(0, end - 6) : end + 1]):
                    start = next(s for s in range(end, -1, -1) if terms <= set(text[s : end + 1]))
                    want.add((i, "" if item is None else str(item), start, end))
    assert sorted(map(tuple, got)) == sorted(want)
    assert (1, "1", 10, 15) in want and not any(w[1] == "4" for w in want)


def test_words_cut_at_gaps(spark):
    texts = ["", " ", "a", "  a  b", "A-b_C9", "é ñ,ü", "x\x00y\x7fz", "日本 語", "!", "a!", "!a", None, "\U0001f600 ok"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(decontamination.tokens(F.col("t")), decontamination.word_count(F.col("t"))).collect()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    want = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lower)) for t in texts]
    assert [r[0] for r in got] == want and [r[1] for r in got] == [len(w) for w in want]


def test_a_repeated_labelled_document_is_one_of_the_sample(spark, make_docs, monkeypatch):
    seen = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda x, n, y: seen.append((len(n), sorted(y))) or fit(x, n, y))
    docs = make_docs([(1, "a fine line", "en", "a")] * 3000 + [(2, "x", "en", "a"), (2, "y", "en", "a"), (3, None, "en", "a")])
    docs = docs.selectExpr("*", "doc_id AS _id", "0 AS _label", "text AS _body", "doc_id AS id", "1 AS label")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (3, 0)], LABELS)
    quality.train(docs, labels, held_out=(5, 9))
    assert seen == [(3, [0, 0, 1])]


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (103, 102), (101, 103), (7, 7)]
    got = dict(components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100, 102: 100, 103: 100}


@pytest.mark.parametrize("words,limit", [(1, 3), (2, 12)])
def test_link_rows(words, limit):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, (6, words)).astype(np.uint64)
    bits = base[rng.integers(0, 6, 400)] ^ np.left_shift(np.uint64(1), rng.integers(0, 64, (400, words)).astype(np.uint64)) ^ np.left_shift(np.uint64(1), rng.integers(0, 64, (400, words)).astype(np.uint64))
    cells = np.sort(rng.integers(0, 3, 400))
    links = simhash.link_rows(cells, bits, limit)

    def trees(pairs):
        root = list(range(400))
        for a, b in pairs:
            x, y = root[a], root[b]
            root = [min(x, y) if r in (x, y) else r for r in root]
        return root

    near = [(a, b) for a, b in itertools.combinations(range(400), 2) if cells[a] == cells[b] and np.bitwise_count(bits[a] ^ bits[b]).sum() <= limit]
    assert trees(links) == trees(near) and len(links) < 400


def test_simhash_odd(odd_docs, make_docs, monkeypatch):
    got = {(r["doc_id"], r["bits"].hex()): r["component_id"] for r in simhash.near_duplicates(odd_docs).collect()}
    assert simhash.near_duplicates(odd_docs).count() == odd_docs.count()
    empty = {k: v for k, v in got.items() if k[1] == "0" * 16}
    assert {k[0] for k in empty} == {None, 3, 4, 5} and set(empty.values()) == {3}
    assert [v for k, v in got.items() if k[0] in (6, 7)] == [6, 6]
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in kept.collect()) == [-1, 1, 3, 6, 8]
    assert simhash.keep_one(make_docs([])).count() == 0
    monkeypatch.setattr(simhash, "CELL_ROWS", 1)  # every group is large: cut in Gray order, compared by pairs of chunks
    again = {(r["doc_id"], r["bits"].hex()): r["component_id"] for r in simhash.near_duplicates(odd_docs).collect()}
    assert again == got


def test_mixing_odd(odd_docs, make_docs):
    got = mixing.mix(odd_docs).toPandas()
    assert len(got) == odd_docs.count()
    by = got.groupby("source", dropna=False).agg(target=("target", "max"), taken=("taken", "sum"), size=("size", "sum"))
    assert (abs(by.target - by.taken) <= 1).all() and (got.taken <= 3 * got["size"]).all() and (by.target <= 3 * by["size"]).all()
    made = mixing.materialize(odd_docs)
    assert made.columns == odd_docs.columns
    words = made.select("source", mixing.word_count(F.col("text")).alias("n")).toPandas().groupby("source", dropna=False).n.sum()
    assert words.sum() == by.taken.sum()
    assert mixing.materialize(make_docs([])).count() == 0 and mixing.mix(make_docs([])).count() == 0
    again = mixing.mix(odd_docs).toPandas()
    assert sorted(again.fillna(-1).values.tolist(), key=repr) == sorted(got.fillna(-1).values.tolist(), key=repr)


def test_first_words(spark):
    df = spark.createDataFrame([("  a b\t\tc  d ",)], "t string")
    assert [df.select(mixing.first_words(F.col("t"), F.lit(n))).first()[0] for n in (1, 3, 9)] == ["  a", "  a b\t\tc", "  a b\t\tc  d "]


def test_sharding(spark, odd_docs, make_docs, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 1)
    got = sharding.shard_documents(odd_docs, 3).toPandas()
    assert len(got) == odd_docs.count()
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    assert ((got.grown_shard == got.shard) | (got.grown_shard == 3)).all()
    assert sharding.shard_documents(make_docs([]), 3).count() == 0
    keys = spark.range(20_000)
    share = keys.select(sharding.rendezvous(F.col("id"), [1.0, 2.0, 0.0, 1.0]).alias("s")).groupBy("s").count().collect()
    assert {r["s"] for r in share} == {0, 1, 3} and all(abs(r["count"] - (10_000 if r["s"] == 1 else 5_000)) < 300 for r in share)
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("id"), [])


def test_quality_odd(spark, odd_docs, make_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (6, None), (8, 0), (99, 1)], LABELS)
    model = quality.train(odd_docs, labels)
    scores = odd_docs.select("text", quality.quality(F.col("text"), model).alias("s")).collect()
    assert all(0 <= r["s"] <= 1 for r in scores)
    assert len({r["s"] for r in scores if not r["text"]}) == 1
    none = quality.train(odd_docs, labels.limit(0))
    assert {round(r[0], 9) for r in odd_docs.select(quality.quality(F.col("text"), none)).collect()} == {0.5}
    assert make_docs([]).select(quality.quality(F.col("text"), model)).count() == 0


def test_marginals_brute_force():
    rng = np.random.default_rng(1)
    odds, steps, counts = rng.normal(size=7), rng.normal(size=(2, 2)), np.array([3, 1, 2, 1])
    got = quality.marginals(odds, counts, steps)[2]
    at = 0
    for n in counts:
        total, good = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=int(n)):
            w = math.exp(sum(odds[at + i] * y[i] for i in range(n)) + sum(steps[a, b] for a, b in zip(y, y[1:])))
            total, good = total + w, good + w * np.array(y)
        assert np.allclose(got[at : at + n], good / total)
        at += n


def test_language_odd(odd_docs, make_docs):
    model = language_id.train(odd_docs)
    got = odd_docs.select("doc_id", "text", language_id.predict(F.col("text"), model).alias("p")).collect()
    assert all((r["p"]["lang"] == "und") == (not any(c.isalpha() for c in r["text"] or "")) for r in got)
    nothing = language_id.train(make_docs([]))
    assert {r[0]["lang"] for r in odd_docs.select(language_id.predict(F.col("text"), nothing)).collect()} == {"und"}


def test_cross_parsing_brute_force():
    samples = ("banana bandana", "ananas\x00nab")
    parser = language_id.Parser(language_id.Model(("x", "y"), samples, "abdns"))
    for text in ("banabanana", "nabxnas", "zz", "ananasnab dana"):
        want = []
        for sample in samples:
            n, i = 0, 0
            while i < len(text):
                k = 1
                while i + k <= len(text) and any(text[i : i + k] in part for part in sample.split("\x00")):
                    k += 1
                i += max(1, k - 1)
                n += 1
            want.append(n)
        assert parser.phrases([parser.codes(text)])[0].tolist() == want


def test_languages_of_many_letters(make_docs):
    """Six invented languages, three of them with 800 letters each: all are told apart."""
    rng = np.random.default_rng(7)
    scripts = ["abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψω"]
    scripts += ["".join(chr(0x4E00 + 2000 * k + i) for i in range(800)) for k in range(2)]
    scripts.append("".join(chr(0xAC00 + i) for i in range(800)))
    rows = []
    for k, letters in enumerate(scripts):
        vocabulary = ["".join(rng.choice(list(letters), int(rng.integers(1, 5)))) for _ in range(400)]
        rows += [(1000 * k + i, " ".join(rng.choice(vocabulary, 120)), f"l{k}", "a") for i in range(100)]
    docs = make_docs(rows)
    model = language_id.train(docs, held_out=(4, 2))
    assert len(model.characters) > 1500
    told = docs.filter("crc32(CAST(doc_id AS STRING)) % 4 = 2").select("lang", language_id.predict(F.col("text"), model)["lang"].alias("got"))
    wrong = told.filter("lang <> got").count()
    assert told.count() > 100 and wrong == 0


def test_rare_letters_brute_force(monkeypatch):
    """Codes with and without a column give the phrases of a plain parse, on texts of any length."""
    rng = np.random.default_rng(3)
    letters = [chr(0x4E00 + i) for i in range(40)]
    samples = tuple("\x00".join("".join(rng.choice(letters[k * 8 : 24 + k * 8], 60)) for _ in range(8)) for k in range(3))
    texts = ["".join(rng.choice(letters, int(n))) for n in (1, 2, 30, 300, 5000)] + ["漢" * 50, letters[0] * 9000]

    def plain(text, sample):
        n, now = 0, ""
        for c in text:
            if now and now + c in sample:
                now += c
            else:
                n, now = n + 1, c if c in sample else ""
        return n

    want = [[plain(t, s) for s in samples] for t in texts]
    for dense in (62, 5, 0):
        monkeypatch.setattr(language_id, "DENSE", dense)
        parser = language_id.Parser(language_id.Model(("x", "y", "z"), samples, "".join(letters)))
        assert parser.phrases([parser.codes(t) for t in texts]).tolist() == want


def test_urls(spark):
    rows = [
        (1, "http://good.org/fr/a", "<a href='http://friend.com/x'>"),
        (2, "http://friend.com/", '<a href="//far.com">'),
        (3, "http://bad.net/x", ""),
        (4, "https://spam.com/?q=1#f", "<A HREF=http://BAD.net/y> <a href='http://bad.net/'>"),
        (5, "http://spam.com", None),
        (6, None, None),
        (7, "nothing", "<a href='http://bad.net/'>"),
        (None, "http://far.com/z", ""),
        (3, "http://bad.net/x", ""),
        (9, "HTTP://X.Example.NET/en/", ""),
    ]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], PAGES).withColumn("host", F.lit("clash"))
    rules = [url_filter.Rule("block", "net", "/"), url_filter.Rule("allow", "example.net", "/en/"), url_filter.Rule("allow", "org", "/fr/")]
    got = {(r["page_id"], r["url"]): (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(pages, rules).collect()}
    assert got[(1, rows[0][1])] == ("good.org", "/fr/a", "org/fr/", "allow")
    assert got[(4, rows[3][1])] == ("spam.com", "/", None, "block") and got[(5, "http://spam.com")][3] == "block"
    assert got[(2, "http://friend.com/")][3] == "allow" and got[(None, "http://far.com/z")][3] == "allow"
    assert got[(6, None)] == ("", "", None, "allow") and got[(7, "nothing")] == ("", "", None, "allow")
    assert got[(9, rows[9][1])] == ("x.example.net", "/en/", "example.net/en/", "allow")
    assert url_filter.judge(pages.limit(0), rules).count() == 0
    assert url_filter.judge(pages, []).filter("rule is not null").count() == 0


def test_a_large_host_is_not_blocked_for_one_link(spark):
    """201 pages, one link to a blocked host among many good ones; ten links from an allowed host; a farm of blocked links."""
    rows = [(i, f"http://big.com/{i}", "<a href='http://fine.com/'>" if i else "<a href='http://bad.net/'>") for i in range(201)]
    rows += [(300 + i, f"http://bad.net/{i}", "") for i in range(10)]
    rows += [(400 + i, f"http://paper.org/{'fr' if i < 3 else 'en'}/{i}", "<a href='http://big.com/'>") for i in range(10)]
    rows += [(500 + i, f"http://farm.com/{i}", "<a href='http://bad.net/'>" * 50) for i in range(3)]
    rows += [(600, "http://fine.com/", "")]
    pages = spark.createDataFrame([(*r, "") for r in rows], PAGES)
    rules = [url_filter.Rule("block", "net", "/"), url_filter.Rule("allow", "org", "/fr/")]
    got = {(r["host"], r["verdict"]): r["count"] for r in url_filter.judge(pages, rules).groupBy("host", "verdict").count().collect()}
    assert got == {("big.com", "allow"): 201, ("bad.net", "block"): 10, ("paper.org", "allow"): 10, ("farm.com", "block"): 3, ("fine.com", "allow"): 1}


def test_verdicts_against_matrices(spark):
    """Trust, distrust and verdict of every host of a random graph, by dense matrices."""
    rng = np.random.default_rng(2)
    hosts = [f"h{i}.{'net' if i % 5 == 0 else 'org' if i % 5 == 1 else 'com'}" for i in range(25)]
    rows = []
    for i, h in enumerate(hosts):
        for k in range(int(rng.integers(1, 8))):
            to = rng.choice(hosts, int(rng.integers(0, 4)))
            rows.append((len(rows), f"http://{h}/{'fr' if k % 2 else 'en'}/", "".join(f"<a href='http://{t}/'>" for t in to)))
    pages = spark.createDataFrame([(*r, "") for r in rows], PAGES)
    rules = [url_filter.Rule("block", "net", "/"), url_filter.Rule("allow", "org", "/fr/")]
    n, links = len(hosts), np.zeros((25, 25))
    size, good, bad = np.zeros(n), np.zeros(n), np.zeros(n)
    for _, u, html in rows:
        h = hosts.index(u.split("/")[2])
        size[h] += 1
        bad[h] += u.split("/")[2].endswith("net")
        good[h] += u.split("/")[2].endswith("org") and "/fr/" in u
        for t in re.findall("//([^/]+)/", html):
            links[h, hosts.index(t)] += hosts.index(t) != h

    def rank(seed, edges):
        out = edges.sum(axis=1)
        step = np.divide(edges, out[:, None], out=np.zeros_like(edges), where=out[:, None] > 0)
        seed = seed / seed.sum()
        now = seed
        for _ in range(30):
            now = (0.15 + 0.85 * now[out == 0].sum()) * seed + 0.85 * (now @ step)
        return now

    trust = np.maximum(good, good.sum() * rank(good, links))
    distrust = np.maximum(bad, bad.sum() * rank(bad, links.T))
    blocked = {h for i, h in enumerate(hosts) if distrust[i] > trust[i] and (bad[i] >= size[i] / 2 or distrust[i] - bad[i] >= size[i] / 10)}
    assert 0 < len([h for h in blocked if not h.endswith("net")]) < 15
    for r in url_filter.judge(pages, rules).collect():
        ruled = "block" if r["host"].endswith("net") else "allow" if r["rule"] else None
        assert r["verdict"] == (ruled or ("block" if r["host"] in blocked else "allow"))


def test_only_named_archives_are_read(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    rows = [(i, f"http://a.com/{i}", f"{i} " * 600) for i in range(12)]
    folder = warc.shared_folder(spark)
    warc.write_archives(spark.createDataFrame([(*r, "") for r in rows], PAGES), folder)
    index = warc.build_index(spark, folder)
    found = warc.find_captures(index, spark.createDataFrame([("com,a)/7",), ("com,a)/zzz",)], "key string"))
    asked, opened = warc._archives, []
    monkeypatch.setattr(warc, "_archives", lambda s, f: opened.append(f) or asked(s, f))
    assert [r["page_id"] for r in warc.read_captures(spark, folder, found).collect()] == ["7"]
    assert [len(f) for f in opened if isinstance(f, list)] == [1]
    assert warc.read_captures(spark, folder, found.limit(0)).count() == 0
    monkeypatch.setattr(warc, "NAMED_ARCHIVES", 0)
    assert [r["page_id"] for r in warc.read_captures(spark, folder, found).collect()] == ["7"]


def test_pagerank_brute_force(spark):
    links = [("a", "b", 2), ("b", "c", 1), ("a", "c", 1), ("c", "a", 1), ("d", "c", 3)]
    got = dict(url_filter.propagate(spark.createDataFrame([(h, 1.0 if h in "ad" else 0.0) for h in "abcde"], "host string, seed double"), spark.createDataFrame(links, "src string, dst string, n long"), rounds=100).collect())
    hosts = "abcde"
    step = np.zeros((5, 5))
    for s, d, n in links:
        step[hosts.index(d), hosts.index(s)] = n / sum(x[2] for x in links if x[0] == s)
    seed = np.array([0.5, 0, 0, 0.5, 0])
    rank = seed.copy()
    for _ in range(300):
        rank = 0.15 * seed + 0.85 * (step @ rank + seed * rank[4])
    assert np.allclose([got[h] for h in hosts], rank, atol=1e-5)


def test_warc(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_CAPTURES", 2)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 3000)
    tricky = "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nb\r\n\r\n"
    rows = [(3, "http://b.com/x", "same"), (1, "http://a.b.com/y?q", "same"), (2, None, "same"), (4, "http://b.com/x", tricky), (5, "no host\nhere", ""), (6, "é", None), (None, "http://b.com/x", "alone"), (7, "http://b.com/x", "same"), (7, "http://b.com/x", "same"), (8, "http://c.com", "Ü" * 5000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], PAGES)
    got = warc.archive_and_read(pages).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert by["1"]["record_type"] == "response" and all(by[i]["refers_to"] == "1" and by[i]["payload_bytes"] == 4 for i in ("2", "3", "7"))
    assert bytes(by["4"]["payload"]).decode() == tricky and bytes(by["8"]["payload"]).decode() == "Ü" * 5000
    assert by["5"]["record_type"] == "response" and by["6"]["refers_to"] == "5" and bytes(by[""]["payload"]) == b"alone"
    assert warc.archive_and_read(pages.limit(0)).count() == 0
    folder = warc.shared_folder(spark)
    warc.write_archives(pages, folder, least_bytes=5)
    index = warc.build_index(spark, folder)
    found = warc.find_captures(index, spark.createDataFrame([("com,b)/x",), ("com,zzz)/",)], "key string"))
    read = warc.read_captures(spark, folder, found).collect()
    assert sorted(r["page_id"] for r in read) == ["", "3", "4", "7", "7"] and all(r["record_type"] == "response" for r in read)
    monkeypatch.setattr(warc, "BROADCAST_BYTES", -1)
    assert sorted(warc.find_captures(index, spark.createDataFrame([("com,b)/x",)], "key string")).collect()) == sorted(found.collect())


def test_nearest_odd(spark):
    schema = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(DoubleType())), StructField("v", StringType())])
    rng = np.random.default_rng(2)
    good = [(i, [float(x) for x in rng.normal(size=8) * (1 + i % 3)], "clash") for i in range(300)]
    bad = [(1000, None, ""), (1001, [0.0] * 8, ""), (1020, [1.0, None] * 4, ""), (1040, [float("nan")] * 8, ""), (1060, [float("inf")] * 8, ""), (1080, [1.0], ""), (1100, [], ""), (None, [1.0] * 8, "")]
    copies = [(i, good[40][1], "") for i in range(2000, 2100)]
    rows = spark.createDataFrame(good + bad + copies + [good[20]], schema)
    got = ann.nearest(rows, F.col("id") % 20 == 0, 5).toPandas()
    all_ = {i: np.array(v) for i, v, _ in good + copies}
    asked = [i for i in all_ if i % 20 == 0]
    assert sorted(got.query_id.unique()) == asked
    for q in asked:
        score = {i: float((v * all_[q]).sum()) for i, v in all_.items() if i != q}
        want = sorted(score, key=lambda i: (-score[i], i))[:5]
        assert list(got[got.query_id == q].sort_values("rank").vec_id) == want
    few = ann.nearest(rows.filter("vec_id IN (0, 1, 20)"), F.col("id") % 20 == 0, 5)
    assert few.groupBy("query_id").count().collect() and few.count() == 4
    assert ann.nearest(rows.limit(0), F.col("id") % 20 == 0, 5).count() == 0


def test_lm_odd(odd_docs, make_docs):
    got = lm_scoring.score(odd_docs).toPandas()
    assert len(got) == odd_docs.count() and np.isfinite(got.score).all() and (got.score < 0).all()
    without_words = got[got.n_tokens == 1]
    assert len(without_words) == 4 and without_words.score.nunique() == 2  # one is blank, the others are empty
    assert lm_scoring.score(make_docs([])).count() == 0


def test_lm_is_a_distribution():
    texts = [b"banana bandana", b"an ananas", b"nab"] * 5
    tree = lm_scoring.build_tree(lm_scoring.pair_counts(texts))
    counts = lm_scoring.Counts(tree)
    for t in texts:
        counts.add(t)
    counts.flush()
    model = lm_scoring.Model(tree, [lm_scoring.quantized(s[::2], s[1::2]) for s in counts.seen], np.full((lm_scoring.DEPTHS * lm_scoring.KINDS, lm_scoring.N_INPUTS), 0.35))
    # the next byte after "ban", the end among them: probabilities of all continuations sum to one
    data = [np.frombuffer(bytes(lm_scoring.LEFT) + b"ban" + bytes([b]), np.uint8) for b in range(256)]
    got, _ = lm_scoring._score(model, data, np.zeros((256, lm_scoring.N_INPUTS)), 0.02)
    start, _ = lm_scoring._score(model, [np.frombuffer(bytes(lm_scoring.LEFT) + b"ban", np.uint8)], np.zeros((1, lm_scoring.N_INPUTS)), 0.02)
    assert abs(np.exp2(got - start[0]).sum() - 1) < 1e-3
