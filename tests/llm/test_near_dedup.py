"""The near-copy stage against brute force on fingerprints of 3-word shingles, linked at 3 bits or fewer."""

import numpy as np

from cropmosaic.llm import simhash
from llm_fixtures import make_docs  # noqa: F401


def brute_keep(docs):
    """Ids that stay of (id, text) with distinct ids: the smallest of each component."""
    prints = [int.from_bytes(simhash.fingerprint((t or "").encode(), 3)) for _, t in docs]
    root = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 and root[i] != root[j]:
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    return {min(docs[k][0] for k in range(len(docs)) if root[k] == r) for r in set(root)}


def kept(df):
    return {r["doc_id"] for r in simhash.keep_one(df).select("doc_id").collect()}


def texts(rng):
    """Texts with copies that differ in none to a few words, single words, and empty ones."""
    out = []
    for _ in range(25):
        base = [f"w{i}" for i in rng.integers(0, 500, rng.integers(1, 400))]
        for _ in range(rng.integers(1, 5)):
            new = base.copy()
            for at in rng.choice(len(new), min(len(new), int(rng.integers(0, 3))), replace=False):
                new[at] = "changed"
            out.append(" ".join(new))
    return out + ["", None, " \t", "one", "one", "One"]


def test_kept_documents(make_docs):
    rng = np.random.default_rng(8)
    found = texts(rng)
    docs = list(zip(rng.permutation(1000)[: len(found)].tolist(), found))
    want = brute_keep(docs)
    assert len(want) < len(docs) - 10
    df = make_docs([(i, t, "en", "a") for i, t in docs])
    assert kept(df) == want
    assert kept(df.repartition(7)) == want


def test_a_large_group_of_near_copies(make_docs, monkeypatch):
    monkeypatch.setattr(simhash, "CELL_ROWS", 16)  # cut in Gray order, compared by pairs of chunks
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in range(900)]
    docs = []
    for i in range(150):
        new = base.copy()
        new[int(rng.integers(0, 900))] = f"x{i}"
        docs.append((i, " ".join(new)))
    assert kept(make_docs([(i, t, "en", "a") for i, t in docs])) == brute_keep(docs)
