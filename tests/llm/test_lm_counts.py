"""What the language model counts: every training document, whole, at every size."""

from cropmosaic.llm import lm_scoring
from llm_fixtures import make_docs  # noqa: F401


def test_every_training_document_is_counted(make_docs, monkeypatch):
    monkeypatch.setattr(lm_scoring, "TUNING_DOCUMENTS", 5)
    texts = [f"text number {i} " + f"with word{i} " * (1200 if i == 3 else 5) for i in range(5)]
    docs, read, collect = make_docs([(i, t, "en", "a") for i, t in enumerate(texts)]), [], lm_scoring._collect_model

    def recorded(counted, tree):
        read.append((counted.filter("kind = 0").collect(), tree))
        return collect(counted, tree)

    monkeypatch.setattr(lm_scoring, "_collect_model", recorded)
    lm_scoring.score(docs, held_out=(7, 9)).collect()
    found, tree = read[-1]
    counts = lm_scoring.Counts(tree)
    for t in texts:
        counts.add(t.encode())
    want = [lm_scoring.unpacked(data) for k, _, data in counts.parts() if k == 0]
    got = [lm_scoring.unpacked(r["data"]) for r in found]
    assert sum(z.sum() + o.sum() for _, z, o in got) == sum(z.sum() + o.sum() for _, z, o in want)
