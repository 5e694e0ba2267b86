"""What the language model works out once for equal bytes, and its tokens."""

import numpy as np
import pytest
from cropmosaic.llm import lm_scoring

TEXTS = [b"banana bandana \xc3\xa9t\xc3\xa9 " * 40, b"an ananas, nab the band " * 60, b"", b" \t\n", bytes(range(1, 250)) * 3]


def made():
    tree = lm_scoring.build_tree(lm_scoring.pair_counts(TEXTS))
    counts = lm_scoring.Counts(tree)
    for t in TEXTS:
        counts.add(t)
    counts.flush()
    odds = [lm_scoring.quantized(s[::2], s[1::2]) for s in counts.seen]
    apart = [lm_scoring.without_itself(s[::2], s[1::2]).ravel() for s in counts.seen]
    weights = np.linspace(0.1, 0.5, lm_scoring.DEPTHS * lm_scoring.KINDS * lm_scoring.N_INPUTS).reshape(-1, lm_scoring.N_INPUTS)
    return lm_scoring.Model(tree, odds, weights, apart), counts


def test_equal_bytes_are_looked_up_once():
    model, _ = made()
    slopes = lm_scoring.Slopes(model)
    slopes.add(TEXTS)
    held = slopes.kinds.size
    slopes.add(TEXTS)
    assert slopes.kinds.size == held
    assert np.allclose(slopes.flush(), 2 * lm_scoring.slopes(model, TEXTS), rtol=1e-4, atol=1e-3)
    first = lm_scoring.score_texts(model, TEXTS)
    held = model.kinds.used
    assert (lm_scoring.score_texts(model, TEXTS) == first).all() and model.kinds.used == held


@pytest.mark.parametrize("bits", [1, 6])
def test_kinds_driven_out_change_nothing(monkeypatch, bits):
    model, _ = made()
    scores, slopes = lm_scoring.score_texts(model, TEXTS), lm_scoring.slopes(model, TEXTS)
    monkeypatch.setattr(lm_scoring, "PLACE_BITS", bits)
    model, _ = made()
    assert np.allclose(lm_scoring.score_texts(model, TEXTS), scores, rtol=1e-6)
    assert np.allclose(lm_scoring.slopes(model, TEXTS), slopes, rtol=1e-4, atol=1e-3)


def test_counts_are_those_of_every_byte():
    model, counts = made()
    tree, want = model.tree, [np.zeros_like(s) for s in counts.seen]
    for text in TEXTS:
        whole = bytes(lm_scoring.LEFT) + text + bytes([lm_scoring.END])
        upto, word = lm_scoring._upto(np.frombuffer(whole, np.uint8)), lm_scoring._words(np.frombuffer(whole, np.uint8))
        for i in range(lm_scoring.LEFT, len(whole)):
            pair = 256 * whole[i - 1] + whole[i]
            marks = tree.mark[tree.at[pair] : tree.at[pair] + tree.size[pair]]
            for k, seen in enumerate(want):
                seen[lm_scoring.slot(k, upto[i : i + 1], word[i : i + 1]) << 1 ^ marks] += 1
    assert all((a == b).all() for a, b in zip(counts.seen, want))


def test_tokens():
    bodies = [b" The\x0bquick\x0c the ", b"", b"\t", b"\x1cA \x85b \xff\xfe", "É é x Y".encode(), b"one"]
    hashed, number, each = lm_scoring._tokens(bodies)
    want = [b.translate(lm_scoring._LOWER).split() for b in bodies]
    assert each.tolist() == [len(w) for w in want]
    assert hashed[number].tolist() == [lm_scoring._hash(t) for w in want for t in w]
