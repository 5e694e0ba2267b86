"""Document quality from a linear-chain conditional random field over lines."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from cropmosaic.llm.common import fold, id_text, unit_hash

#: The model is fitted on at most so many labelled documents of each class, those of the smallest
#: id hashes, and at most so many lines of each. Everything else reads whole tables and whole texts.
FIT_DOCUMENTS, FIT_LINES = 2000, 200
PIECE_BYTES = 4 << 20


def _classes() -> np.ndarray:
    kind = np.full(256, 5, np.uint8)  # punctuation of prose, and what is left
    kind[[ord(c) for c in "#$%&*@^~\\<>{}[]=_+|/"]] = 4  # marks that are rare in prose
    kind[48:58] = 3
    kind[65:91] = 1
    kind[97:123] = 0
    kind[128:] = 2
    kind[[9, 10, 11, 12, 13, 32]] = 6
    return kind


_KIND = _classes()
NAMES = ["bias", "caps", "digits", "marks", "shouts", "bars", "caps_many", "marks_many", "bars_many", "digits_many", "no_stop", "short", "length", "repeated", "word", "no_words", "start", "end", "same_words", "same_words_many"]
N_OWN = len(NAMES)
N_FEATURES = 3 * N_OWN


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """features (lines x 3 N_OWN: own, previous line's, next line's), bytes of each line, lines of each text."""
    lines = [t.split(b"\n") for t in texts]
    counts = np.array([len(x) for x in lines], np.int64)
    again, same = np.zeros(counts.sum(), np.float32), np.zeros(counts.sum(), np.float32)
    at = 0
    for own in lines:
        seen: set[bytes] = set()
        for line in own:
            if line:
                again[at] = line in seen
                seen.add(line)
                own_words = line.split()
                if own_words:
                    same[at] = 1 - len(set(own_words)) / len(own_words)
            at += 1
    buffer = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.flatnonzero(buffer == 10)
    starts = np.r_[0, ends[:-1] + 1]
    size = (ends - starts).astype(np.float32)
    kind = _KIND[buffer]

    def total(flags: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flags, starts, dtype=np.float32)

    caps, small, high, digits, marks = (total(kind == k) for k in (1, 0, 2, 3, 4))
    shouts, bars = total(buffer == ord("!")), total(buffer == ord("|"))
    word_ends = np.r_[(kind[1:] == 6) & (kind[:-1] != 6), False]
    words = total(word_ends)
    last = buffer[np.maximum(ends - 1, starts)]
    letters = np.maximum(caps + small + high, 1)
    base = np.maximum(size, 1)
    full = size > 0
    x = np.zeros((len(starts), N_OWN), np.float32)
    x[:, 0] = 1
    for i, (part, whole) in enumerate(((caps, letters), (digits, base), (marks, base), (shouts, base), (bars, base))):
        x[:, 1 + i] = np.sqrt(part / whole)
    x[:, 6] = (caps / letters > 0.5) & full
    x[:, 7] = marks / base > 0.05
    x[:, 8] = bars / base > 0.02
    x[:, 9] = digits / base > 0.1
    x[:, 10] = full & ~np.isin(last, list(b".!?:;\"'"))
    x[:, 11] = size < 20
    x[:, 12] = np.log1p(size) / 8
    x[:, 13] = again
    x[:, 14] = np.minimum(base / np.maximum(words, 1), 40) / 20
    x[:, 15] = ~full
    first = np.cumsum(counts) - counts
    final = first + counts - 1
    x[first, 16] = 1
    x[final, 17] = 1
    x[:, 18] = same
    x[:, 19] = same > 0.5
    previous, following = np.zeros_like(x), np.zeros_like(x)
    previous[1:] = x[:-1]
    following[:-1] = x[1:]
    previous[first] = 0
    following[final] = 0
    return np.concatenate((x, previous, following), axis=1), size + 1, counts


@dataclass(frozen=True)
class Model:
    """weights: log-odds of good for each feature; steps[a, b]: log-potential of label b after label a."""

    weights: np.ndarray
    steps: np.ndarray


def _log_sum(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def marginals(odds: np.ndarray, counts: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward log-odds of every line and the probability that it is good.

    All texts advance together, line by line; with two labels a message is one number.
    """
    order = np.argsort(-counts, kind="stable")
    first = (np.cumsum(counts) - counts)[order]
    length = counts[order]
    live = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right") if len(length) else []
    forward, backward = odds.astype(np.float64).copy(), np.zeros(len(odds))
    for t in range(1, len(live)):
        at = first[: live[t]] + t
        before = forward[at - 1]
        forward[at] += _log_sum(before + steps[1, 1], steps[0, 1]) - _log_sum(before + steps[1, 0], steps[0, 0])
    for t in range(len(live) - 1, 0, -1):
        at = first[: live[t]] + t
        after = odds[at] + backward[at]
        backward[at - 1] = _log_sum(after + steps[1, 1], steps[1, 0]) - _log_sum(after + steps[0, 1], steps[0, 0])
    return forward, backward, 1 / (1 + np.exp(-np.clip(forward + backward, -60, 60)))


def fit(x: np.ndarray, counts: np.ndarray, label: np.ndarray, rounds: int = 200, decay: float = 1e-3) -> Model:
    """Conditional likelihood by gradient steps; every line has its document's label and documents weigh the same."""
    weights, steps = np.zeros(x.shape[1]), np.zeros((2, 2))
    y = np.repeat(label, counts).astype(np.float64)
    share = np.repeat(1 / counts, counts) / len(counts)
    starts = np.cumsum(counts) - counts
    inner = np.ones(len(y), bool)
    inner[starts] = False
    now = np.flatnonzero(inner)
    moment, square = np.zeros(len(weights) + 4), np.zeros(len(weights) + 4)
    for n in range(1, rounds + 1):
        odds = x @ weights
        forward, backward, p = marginals(odds, counts, steps)
        slope = x.T @ ((y - p) * share) - decay * weights
        pair = np.stack(
            [
                steps[a, b] + a * forward[now - 1] + b * (odds[now] + backward[now])
                for a in (0, 1)
                for b in (0, 1)
            ]
        )
        pair = np.exp(pair - pair.max(axis=0))
        pair /= pair.sum(axis=0)
        seen = np.stack([(y[now - 1] == a) & (y[now] == b) for a in (0, 1) for b in (0, 1)])
        slope = np.concatenate((slope, ((seen - pair) * share[now]).sum(axis=1) - decay * steps.ravel()))
        moment = 0.9 * moment + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        move = 0.1 * (moment / (1 - 0.9**n)) / (np.sqrt(square / (1 - 0.99**n)) + 1e-8)
        weights = weights + move[:-4]
        steps = steps + move[-4:].reshape(2, 2)
    return Model(weights, steps)


def _pieces(texts: list[bytes]) -> Iterator[list[bytes]]:
    piece, size = [], 0
    for t in texts:
        piece.append(t)
        size += len(t)
        if size >= PIECE_BYTES:
            yield piece
            piece, size = [], 0
    if piece:
        yield piece


def score_texts(texts: list[bytes], model: Model) -> np.ndarray:
    """Length-weighted mean of the lines' probabilities of being good, for each text."""
    scores = [np.zeros(0)]
    for piece in _pieces(texts):
        x, size, counts = line_features(piece)
        p = marginals(x @ model.weights, counts, model.steps)[2]
        starts = np.cumsum(counts) - counts
        scores.append(np.add.reduceat(p * size, starts) / np.add.reduceat(size.astype(np.float64), starts))
    return np.clip(np.concatenate(scores), 0, 1)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", held_out: tuple[int, int] = (5, 0)) -> Model:
    """The model from labelled documents whose crc32(id) mod held_out[0] is not held_out[1].

    Bounded sample: see FIT_DOCUMENTS. Rows without a label or text column value count as
    unlabelled or empty; without any labelled row the model gives 0.5 to every line.
    """
    marked = labels.select(F.col(key).alias("_id"), F.col(label).cast("int").alias("_label"))
    marked = marked.filter(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & (fold(F.col("_id"), held_out[0]) != held_out[1]))
    order = [unit_hash(F.lit("quality"), id_text(F.col("_id"))), F.col("_id")]
    bad, good = (marked.filter(F.col("_label") == y).orderBy(*order).limit(FIT_DOCUMENTS) for y in (0, 1))
    marked = bad.unionByName(good)
    bodies = docs.select(F.col(key).alias("_doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_body"))
    chosen = bodies.join(F.broadcast(marked), F.col("_doc") == F.col("_id")).select(
        F.col("_id").cast("string").alias("id"),
        F.col("_label").alias("label"),
        F.xxhash64("_body").alias("place"),
        F.col("_body").cast("binary").alias("body"),
    )

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bodies = [b"\n".join(t.split(b"\n")[:FIT_LINES]) for t in batch["body"]]
            if bodies:
                x, _, counts = line_features(bodies)
                rows = np.split(x, np.cumsum(counts)[:-1])
                yield batch[["id", "label", "place"]].assign(x=[r.astype(np.float16).tobytes() for r in rows])

    # an id that many rows repeat gives one of them, so the driver never holds more than the sample
    sample = chosen.mapInPandas(features, "id string, label int, place long, x binary").groupBy("id", "label").agg(F.min_by("x", "place").alias("x"))
    got = sorted((r["label"], bytes(r["x"])) for r in sample.toLocalIterator())
    if not got:
        return Model(np.zeros(N_FEATURES), np.zeros((2, 2)))
    rows = [np.frombuffer(b, np.float16).reshape(-1, N_FEATURES) for _, b in got]
    return fit(np.concatenate(rows).astype(np.float64), np.array([len(r) for r in rows]), np.array([y for y, _ in got]))


def quality(text: Column, model: Model) -> Column:
    """Score of a text column, 0 to 1. NULL counts as the empty text, which is one empty line."""

    @F.pandas_udf(DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(score_texts([t or b"" for t in texts], model))

    return score(text.cast("string").cast("binary"))
