"""Importance resampling towards a target corpus: hashed n-gram weights, a bisected cutoff, ranks by range."""

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from cropmosaic.llm.common import bucket_count, id_text, stored, with_size_hint

BUCKETS, MIN_WORDS, PERCENT, SEED = 10_000, 20, 25, 7
#: Thresholds that one counting job tries at once, and rows of a range of ranks.
WAYS, ROWS_PER_RANGE = 15, 100_000
#: Bytes of a text -> bytes of its words: A-Z lower-cased, 0-9, a-z and all of 0x80 and above kept, the rest blank.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def text_words(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text: runs of letters, digits and non-ASCII characters, only A-Z lower-cased."""
    return (text or b"").translate(WORD_BYTES).split()


def feature_buckets(text: bytes | None, buckets: int = BUCKETS) -> np.ndarray:
    """Bucket (crc32 modulo buckets) of every run of one or two words, repeats included.

    The checksum of a pair goes on from that of its first word, so no pair is ever put together.
    """
    words = text_words(text)
    if not words:
        return np.zeros(0, np.int64)
    one = list(map(zlib.crc32, words))
    two = map(zlib.crc32, map(b" ".__add__, words[1:]), one)
    return np.fromiter([*one, *two], np.int64, 2 * len(words) - 1) % buckets


def _bytes(text: str) -> Column:
    return F.col(text).cast("string").cast("binary")


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket. Each task gives at most `buckets` rows."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for t in batch["t"]:
                total += np.bincount(feature_buckets(t, buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at, "n": total[at]})

    rows = docs.select(_bytes(text).alias("t")).mapInPandas(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most `buckets` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed target and source frequency of each bucket, rounded down."""
    n, m = int(source.sum()), int(target.sum())
    b = len(source)
    ratio = [(t + 1) * (n + b) / ((s + 1) * (m + b)) for s, t in zip(source.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def weigh(text: Column, gain: np.ndarray) -> Column:
    """Struct (n_words, n_features, weight): weight is the mean gain over the features, rounded down; 0 without features."""

    @F.pandas_udf("n_words long, n_features long, weight long")
    def scores(texts: pd.Series) -> pd.DataFrame:
        n, w = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            at = feature_buckets(t, len(gain))
            n[i] = len(at)
            w[i] = gain[at].sum() // len(at) if len(at) else 0
        return pd.DataFrame({"n_words": (n + 1) // 2, "n_features": n, "weight": w})

    return scores(text.cast("string").cast("binary"))


def gumbel(key: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel number that seed and key decide, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), id_text(key)).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def kth_largest(rows: DataFrame, value: Column, k: int) -> tuple[int, int, int]:
    """(value, rows above it, rows equal to it) of the k-th largest of a column of whole numbers, 1 <= k <= rows.

    Bisection of the range of values: each job counts all rows at WAYS thresholds, exactly; nothing is sorted.
    """
    seen = rows.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    lo, hi = seen["lo"], seen["hi"]
    while lo < hi:
        marks = sorted({lo + (hi - lo) * i // (WAYS + 1) + 1 for i in range(WAYS + 1)} - {lo})
        at = rows.agg(*[F.count(F.when(value >= F.lit(m), 1)).alias(f"m{i}") for i, m in enumerate(marks)]).first()
        reached = [m for i, m in enumerate(marks) if at[i] >= k]
        missed = [m for i, m in enumerate(marks) if at[i] < k]
        lo, hi = max(reached, default=lo), min(missed, default=hi + 1) - 1
    found = rows.agg(F.count(F.when(value > F.lit(lo), 1)).alias("above"), F.count(F.when(value == F.lit(lo), 1)).alias("equal")).first()
    return lo, found["above"], found["equal"]


def first_rows(rows: DataFrame, order: list[Column], k: int) -> Column:
    """Condition that holds for exactly the first k rows by `order`, columns of whole numbers, largest first.

    The cutoff of the first column is bisected, then that of the next among the rows tied there,
    and so on; the last column must tell all rows apart. `rows` should be a stored table.
    """
    if k <= 0:
        return F.lit(False)
    taken, tied = F.lit(False), F.lit(True)
    for value in order:
        cut, above, equal = kth_largest(rows.filter(tied), value, k)
        taken = taken | (tied & (value > F.lit(cut)))
        tied = tied & (value == F.lit(cut))
        k -= above
        if k == equal:
            break
    return taken | tied


def with_rank(rows: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The n rows with `rank` 1, 2, ... by `order`, largest first: ranges of rows are numbered side by side."""
    falling = [c.desc() for c in order]
    ranges = rows.repartitionByRange(bucket_count(n, ROWS_PER_RANGE), *falling).withColumn("_range", F.spark_partition_id())
    ranges = stored(ranges)
    sizes = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each range of ROWS_PER_RANGE rows
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    nth = F.row_number().over(Window.partitionBy("_range").orderBy(*falling))
    placed = ranges.withColumn("_nth", nth).join(with_size_hint(offsets, bucket_count(n, ROWS_PER_RANGE), 16), "_range")
    return placed.withColumn("rank", (F.col("_before") + F.col("_nth")).cast("long")).drop("_range", "_nth", "_before")


def resample(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, rank (NULL if not drawn).

    Of the documents with at least min_words words, percent in a hundred (rounded down) are drawn
    without replacement, in proportion to the exponential of their weight: those of the largest
    score, weight plus a Gumbel number of the id. Ties go to the smaller id, then fewer features.
    A NULL or empty text has no words, weight 0 and is never drawn (while min_words > 0). A NULL id
    counts as '' and comes last among ties; rows that repeat an id are documents of their own and
    share its Gumbel number. An empty target or table works. Ids must be whole numbers.
    """
    if not isinstance(docs.schema[key].dataType, IntegralType):
        raise ValueError(f"{key} must be a column of whole numbers")
    gain = gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), weigh(F.col(text), gain).alias("w"))
    rows = rows.select("doc_id", "w.n_words", "w.n_features", "w.weight", (F.col("w.weight") + gumbel(F.col("doc_id"), seed)).alias("score"))
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()))
    able = rows.filter(F.col("n_words") >= min_words)
    # ~x falls as x rises and never overflows
    order = [
        F.col("score"),
        F.col("doc_id").isNotNull().cast("long"),
        F.coalesce(F.bitwise_not("doc_id"), F.lit(0).cast("long")),
        F.bitwise_not("n_features"),
        F.bitwise_not("_row"),
    ]
    n = able.count() * percent // 100
    drawn = (F.col("n_words") >= min_words) & first_rows(able, order, n)
    columns = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    ranked = with_rank(rows.filter(drawn), order, n).select(*columns)
    return ranked.unionByName(rows.filter(~drawn).withColumn("rank", F.lit(None).cast("long")).select(*columns))
