"""What the language model's weights and code tree are set on: every training document, whole."""

import numpy as np
from cropmosaic.llm import lm_scoring
from llm_fixtures import make_docs  # noqa: F401


def test_weights_and_tree_come_from_all_training_documents(make_docs, monkeypatch):
    texts = [f"text number {i} " + f"with word{i} " * (1200 if i == 3 else 5) for i in range(9)]
    pairs, models, build, score_rows = [], [], lm_scoring.build_tree, lm_scoring._score_rows

    def built(found):
        pairs.append(found)
        return build(found)

    def scored(spark, rows, model, *rest):
        models.append(model)
        return score_rows(spark, rows, model, *rest)

    monkeypatch.setattr(lm_scoring, "build_tree", built)
    monkeypatch.setattr(lm_scoring, "_score_rows", scored)
    lm_scoring.score(make_docs([(i, t, "en", "a") for i, t in enumerate(texts)]), held_out=(7, 9)).collect()
    whole = sum(lm_scoring.pair_counts([t.encode()]) for t in texts)
    end = 256 * lm_scoring.END  # the pair of one text's end and the next one's start depends on their order
    assert (np.delete(pairs[-1].ravel(), end) == np.delete(whole.ravel(), end)).all()
    model = models[-1]
    want = lm_scoring.fitted(sum(lm_scoring.slopes(model, [t.encode()]) for t in texts))
    assert np.allclose(model.weights, want, atol=1e-3)


def test_an_occurrence_is_left_out_of_its_own_odds():
    zeros, ones = np.array([3, 0, 1]), np.array([0, 1, 7])
    got = lm_scoring.without_itself(zeros, ones)
    assert got[0, 0] == lm_scoring.quantized(np.array([0]), np.array([2]))[0]
    assert got[1, 1] == 0  # seen once: without itself nothing is known
    assert got[2, 1] == lm_scoring.quantized(np.array([1]), np.array([6]))[0]
