"""The registered queries against their SQL, or against brute force where SQL has none."""

import math
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import xxhash

sys.path.insert(0, str(Path(__file__).parents[1]))

import __spark_entry__ as entry_point  # noqa: E402
from check_oracle import compare, duck  # noqa: E402
from cropmosaic.llm import language_id  # noqa: E402
from cropmosaic.llm.queries import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").translate(SMALL))


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").toPandas().sort_values("doc_id").reset_index(drop=True)


def rows(spark, name, key="doc_id"):
    return QUERIES[name](spark, SF).toPandas().sort_values(key).reset_index(drop=True)


def test_registered():
    names = set(entry_point.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {f"op{i}" for i in range(1, 14)} == {n.split("_")[0] for n in QUERIES}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    assert compare(spark, duck(SF), SF, QUERIES[name], ORACLE[name]) is None


def test_lm_scoring(spark, documents):
    got = rows(spark, "op1_lm_scoring")
    out = np.array([zlib.crc32(str(i).encode()) % 7 == 2 for i in documents.doc_id])
    text = [words(t) for t in documents.text]
    count, docs = Counter(), 0
    for w, held in zip(text, out):
        if not held:
            count.update(w)
            docs += 1
    n, v = sum(count.values()) + docs, len(count) + 1
    base = [sum(math.log10((count[t] + 1) / (n + v + 1)) for t in w) + math.log10((docs + 1) / (n + v + 1)) for w in text]
    assert (got.held_out.to_numpy() == out).all() and (got.train_tokens == n).all()
    assert np.allclose(got.base_score, base, atol=1e-6)
    assert (got.n_tokens == [len(w) + 1 for w in text]).all()
    assert (got.n_known == [sum(count[t] > 0 for t in w) + 1 for w in text]).all()
    held = got[out]
    size = sum(len((t or "").encode()) + 1 for t in documents.text[out])
    assert -held.score.sum() / math.log10(2) / size < 3.0  # bits per byte


def test_simhash(spark, documents):
    got = rows(spark, "op2_simhash")
    prints = []
    for t in documents.text:
        w = words(t)
        runs = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    assert list(got.fingerprint) == [f"{p:016x}" for p in prints]
    ids, least = list(documents.doc_id), list(range(len(prints)))
    for _ in range(len(prints)):
        new = [min(least[j] for j in range(len(prints)) if (prints[i] ^ prints[j]).bit_count() <= 3) for i in range(len(prints))]
        if new == least:
            break
        least = new
    assert list(got.component_id) == [ids[i] for i in least]


def test_language(spark, documents):
    got = rows(spark, "op5_language")
    assert (got.held_out.to_numpy() == [zlib.crc32(str(i).encode()) % 4 == 2 for i in documents.doc_id]).all()
    assert (got.lang_pred == documents.lang)[got.held_out].mean() > 0.9
    assert got.score.between(0, 1).all()
    model = language_id.train(spark.read.parquet(f"{SF}/documents.parquet"), held_out=(4, 2))

    def phrases(text, sample):
        n, now = 0, ""
        for c in text:
            if now and now + c in sample:
                now += c
            else:
                n, now = n + 1, c if c in sample else ""
        return n

    for text, told, score in zip(documents.text, got.lang_pred, got.score):
        plain = re.sub("[^\\W\\d_]", lambda m: m[0].lower() if len(m[0].lower()) == 1 else m[0], text or "")
        plain = re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in plain))
        if len(plain) > 3000:
            continue
        if not plain.strip():
            assert told == "und" and score == 0
            continue
        cost = sorted((phrases(plain, s) * math.log2(len(s)), la) for la, s in zip(model.languages, model.samples))
        assert told == cost[0][1] and score == pytest.approx(cost[1][0] / (cost[0][0] + cost[1][0]))


def test_quality(spark, documents):
    got = rows(spark, "op6_quality")
    label = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    assert (got.held_out.to_numpy() == [zlib.crc32(str(i).encode()) % 5 == 0 for i in documents.doc_id]).all()
    both = got.merge(label, on="doc_id")
    assert (both.predicted == both.quality)[both.held_out].mean() > 0.85
    assert ((got.score >= 0.3).astype(int) == got.predicted).all() and got.score.between(0, 1).all()


def test_url_filter(spark):
    got = rows(spark, "op4_url_filter", "page_id")
    pages = spark.read.parquet(f"{SF}/pages.parquet").toPandas().sort_values("page_id")
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    for url, g in zip(pages.url, got.itertuples()):
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].translate(SMALL), m[2]) if m else ("", "")
        fits = [(len(h + p), h + p, v) for v, h, p in rules if ("." + host).endswith("." + h) and path.startswith(p)]
        assert (g.host, g.path) == (host, path)
        assert (g.rule, g.verdict) == max(fits)[1:] if fits else g.rule is None


def test_nearest(spark):
    got = rows(spark, "op10_nearest", ["query_id", "rank"])
    e = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas().sort_values("vec_id")
    x, ids = np.array(e.embedding.tolist(), np.float64), e.vec_id.to_numpy()
    hits = []
    for q in ids[ids % 20 == 0]:
        own = got[got.query_id == q]
        score = (x * x[ids == q]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:20]
        hits.append(len(set(ids[order]) & set(own.vec_id)) / len(order))
        assert list(own["rank"]) == list(range(1, len(own) + 1))
        assert (own.score.to_numpy() == [score[ids == v][0] for v in own.vec_id]).all()
    assert np.mean(hits) >= 0.9
