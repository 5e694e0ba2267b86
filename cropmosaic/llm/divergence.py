"""Source divergence: how far the word frequencies of the sources of a language lie apart.

Terms are counted by sorting pointers to word starts, not by making words: each Arrow batch of
texts is one buffer of bytes, a pointer is a position in it, and equal neighbours in sorted
order are the occurrences of one term. What leaves a task are counts.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cropmosaic.llm.common import stored, with_size_hint

MIN_DOCS, SMOOTHING, SCALE, TOP = 30, 5, 1_000_000_000, 50
#: Cells of a matrix (sources x terms) that a task holds, and about how many sources it compares with as many others.
CELLS, TILE = 1 << 16, 512
#: Bytes of text whose pointers a task sorts at once; a longer text is sorted alone, whole.
SLICE_BYTES = 8 << 20
#: Bytes of a term: A-Z lower-cased, a-z and all of 0x80 and above; every other byte ends a term.
_TERM_BYTES = np.array([b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 0 for b in range(256)], np.uint8)
#: First k of eight bytes, k = 0..8.
_FIRST = np.array([((1 << 8 * k) - 1) << 8 * (8 - k) for k in range(9)], np.uint64)


def term_pointers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, text) of every term of the texts data[offsets[i]:offsets[i + 1]] of folded bytes."""
    inside = data != 0
    filled = np.flatnonzero(np.diff(offsets))
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    first, last = offsets[filled], offsets[filled + 1] - 1
    starts[first], ends[last] = inside[first], inside[last]
    start = np.flatnonzero(starts)
    length = np.flatnonzero(ends) + 1 - start
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(start, offsets)))
    return start, length, text


def sort_pointers(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): pointers sorted by their terms' bytes, equal terms in the order given; new marks the first of each term.

    Multikey quicksort with eight bytes as one character: slices are sorted by the character at
    their depth, and only runs of equal characters that go on are sorted by the next one.
    """
    bytes_ = np.concatenate([data, np.zeros(8, np.uint8)])
    window = np.lib.stride_tricks.as_strided(bytes_.view(), (len(data) + 1, 8), (1, 1))

    def character(at: np.ndarray, depth: int) -> np.ndarray:
        rest = np.clip(length[at] - 8 * depth, 0, 8)
        return window[np.minimum(start[at] + 8 * depth, len(data))].view(">u8").ravel().astype(np.uint64) & _FIRST[rest]

    order = np.arange(len(start))
    key = character(order, 0)
    turned = np.argsort(key, kind="stable")
    order, key = order[turned], key[turned]
    new = np.r_[True, key[1:] != key[:-1]] if len(order) else np.zeros(0, bool)
    open_, depth = np.arange(len(order)), 1
    while len(open_):
        # of the positions left, those in runs of two or more whose terms are longer than what was compared
        run = np.cumsum(new[open_]) - 1
        goes_on = (length[order[open_]] > 8 * depth) & (np.bincount(run)[run] > 1)
        open_, run = open_[np.isin(run, run[goes_on])], run[np.isin(run, run[goes_on])]
        if not len(open_):
            break
        at = order[open_]
        key = character(at, depth)
        turned = np.lexsort((key, run))
        order[open_], key = at[turned], key[turned]
        new[open_[1:]] |= key[1:] != key[:-1]
        depth += 1
    return order, new


def _text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes of a binary array and the offsets of its texts."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(offsets) < 2 or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return _TERM_BYTES[data], offsets - offsets[0]


def count_terms(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(lang, source, text) -> (lang, source, term, n, docs): occurrences and texts of each term in each group of the batch."""
    (of_lang, langs), (of_source, sources) = (pd.factorize(batch.column(i).to_pandas()) for i in (0, 1))
    names, code = np.unique(of_lang * len(sources) + of_source, return_inverse=True)
    data, offsets = _text_buffer(batch.column(2))
    start, length, text = term_pointers(data, offsets)
    order, new = sort_pointers(data, start, length)
    run, text = np.cumsum(new) - 1, text[order]
    # equal terms stand in text order, so a text of the same run before it has been counted
    fresh = np.r_[True, (run[1:] != run[:-1]) | (text[1:] != text[:-1])] if len(run) else np.zeros(0, bool)
    key = run * len(names) + code[text]
    kinds, n = np.unique(key, return_counts=True)
    docs = np.unique(key[fresh], return_counts=True)[1]
    lead = order[new]
    terms = [data[a : a + k].tobytes() for a, k in zip(start[lead].tolist(), length[lead].tolist())]
    terms = pa.array(terms, pa.binary()).cast(pa.string())
    which, whose = np.divmod(kinds, len(names))
    of_lang, of_source = np.divmod(names[whose], len(sources))
    lang, source = pa.array(langs[of_lang], pa.string()), pa.array(sources[of_source], pa.string())
    return pa.RecordBatch.from_arrays(
        [lang, source, terms.take(pa.array(which)), pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
        ["lang", "source", "term", "n", "docs"],
    )


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows in runs of about SLICE_BYTES of text (the third column)."""
    ends = np.cumsum(pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n, docs) over all texts; NULL is the empty text. Counted per slice, then per task, then by a shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from map(count_terms, _slices(batch))

    rows = docs.select(_text(lang).alias("lang"), _text(source).alias("source"), _text(text).cast("binary").alias("text"))
    counted = rows.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _probability(n: Column, all_: Column, terms: Column, smoothing: int, scale: int) -> Column:
    """1 + floor(scale * (n + smoothing) / (all + smoothing * terms)), exactly; 0 without terms."""
    top = F.lit(scale).cast("decimal(10,0)") * (n + F.lit(smoothing)).cast("decimal(19,0)")
    out = F.call_function("div", top, (all_ + F.lit(smoothing) * terms).cast("decimal(19,0)")) + F.lit(1)
    return F.when(terms > 0, out).otherwise(F.lit(0)).cast("long")


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cells of rows sorted by cell -> (lang, a, b, value) for its pairs of sources; see _pair_sums."""
    held = None
    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        if not len(rows):
            continue
        cell = rows["cell"].to_numpy()
        edges = np.r_[0, np.flatnonzero(cell[1:] != cell[:-1]) + 1]
        for lo, hi in zip(edges[:-1], edges[1:]):
            yield from _compare_cell(rows.iloc[lo:hi])
        held = rows.iloc[edges[-1] :]
    if held is not None:
        yield from _compare_cell(held)


def _compare_cell(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    plain = rows["term"].isna()
    base = rows[plain].sort_values("source")
    names, left, right = base["source"].to_numpy(), base["here"].to_numpy(), base["there"].to_numpy()
    given = rows[~plain]
    at, terms = pd.factorize(given["term"])
    zero = base["p"].to_numpy()
    table = np.repeat(zero[:, None], len(terms), axis=1)
    table[np.searchsorted(names, given["source"].to_numpy()), at] = given["p"].to_numpy()
    absent = int(base["terms"].iloc[0]) - len(terms)
    # a tile with itself gives each pair once; two tiles give every pair across them
    for i in np.flatnonzero(left):
        others = np.flatnonzero(right)
        others = others[others > i] if left.all() and right.all() else others
        if len(others):
            apart = np.abs(table[others] - table[i]).sum(axis=1) + absent * np.abs(zero[others] - zero[i])
            yield pd.DataFrame({"lang": rows["lang"].iloc[0], "a": names[i], "b": names[others], "value": apart})


def _pair_sums(entries: DataFrame, groups: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, item, value): sum of |p - q| over all kept terms of the language, for every two of its sources.

    Terms are dealt to blocks and sources to tiles, so that a task holds about CELLS numbers
    however many sources or terms there are. Only terms that a source holds travel; all others
    have the same p in it. A cell gives one partial sum for each pair of its sources.
    """
    langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("_sources"), F.max("terms").alias("_terms"))
    tiles = F.ceil(F.col("_sources") / F.lit(TILE)).cast("long")
    wide = F.least(F.col("_sources"), F.lit(2 * TILE))
    langs = langs.select("lang", tiles.alias("_tiles"), F.greatest(F.ceil(F.col("_terms") * wide / F.lit(CELLS)), F.lit(1)).cast("long").alias("_blocks"))
    langs = stored(langs)
    small = with_size_hint(langs, langs.count(), 64)
    block = F.pmod(F.xxhash64("term"), F.col("_blocks"))
    sizes = kept.join(small, "lang").groupBy("lang", block.alias("block")).agg(F.count(F.lit(1)).alias("terms"))
    # a language without kept terms still has its pairs, of sum 0
    bare = langs.join(sizes.select("lang").distinct(), "lang", "left_anti").select("lang", F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("terms"))
    sizes = sizes.unionByName(bare)
    tile = F.pmod(F.xxhash64("source"), F.col("_tiles"))
    held = entries.join(small, "lang").select("lang", block.alias("block"), "source", tile.alias("tile"), "_tiles", "term", "p", F.lit(None).cast("long").alias("terms"))
    zeros = groups.select("lang", "source", F.col("p0").alias("p")).join(small, "lang").join(sizes, "lang")
    zeros = zeros.select("lang", "block", "source", tile.alias("tile"), "_tiles", F.lit(None).cast("string").alias("term"), "p", "terms")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_tiles") - 1)).alias("other")
    rows = held.unionByName(zeros).select("*", each)
    low, high = F.least("tile", "other"), F.greatest("tile", "other")
    cells = rows.select(
        "lang", F.xxhash64("lang", "block", low, high).alias("cell"), "source", "term", "p", "terms",
        (F.col("tile") == low).alias("here"), (F.col("tile") == high).alias("there"),
    )
    sums = cells.repartition("cell").sortWithinPartitions("cell").mapInPandas(_compare, "lang string, a string, b string, value long")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    sides = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    return sums.select("lang", "value", F.inline(sides)).select("lang", "source", "item", "value")


def audit(
    docs: DataFrame,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
    min_docs: int = MIN_DOCS,
    smoothing: int = SMOOTHING,
    scale: int = SCALE,
    top: int = TOP,
) -> DataFrame:
    """lang, source, part, item, value, rank: what sets each source of a language apart.

    A language keeps the terms that stand in at least min_docs of its documents. p is the smoothed
    frequency of a kept term in a group (lang, source), or in the language, times scale, a whole
    number. Part `pair`: every other source of the language, value the sum of |p - q| over all
    kept terms. Part `term`: the `top` kept terms that the group holds and uses most above the
    language, value p - q. Ranks count from 1 by falling value, then rising item.

    NULL text, lang and source are ''. Each row is a document, repeated ids included. Groups
    without a term, or in a language that keeps none, have pairs (of sum 0 if none is kept); an
    empty table gives no rows.
    """
    groups = stored(docs.select(_text(lang).alias("lang"), _text(source).alias("source")).distinct())
    counts = stored(term_counts(docs, lang, source, text))
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
    kept = stored(kept.filter(F.col("docs") >= min_docs).select("lang", "term", "total"))
    entries = stored(counts.join(with_size_hint(kept, kept.count(), 96), ["lang", "term"]).select("lang", "source", "term", "n", "total"))
    of_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_n"))
    of_group = entries.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = groups.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left").na.fill(0, ["group_n", "terms", "lang_n"])

    def p(n: Column, all_: str) -> Column:
        return _probability(n, F.col(all_), F.col("terms"), smoothing, scale)

    groups = stored(groups.withColumn("p0", p(F.lit(0).cast("long"), "group_n")))
    sized = with_size_hint(groups, groups.count(), 128)
    found = entries.join(sized, ["lang", "source"]).select("lang", "source", "term", p(F.col("n"), "group_n").alias("p"), p(F.col("total"), "lang_n").alias("q"))
    found = stored(found)
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    above = found.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    above = above.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    pairs = _pair_sums(found, groups, kept).withColumn("rank", F.row_number().over(order))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(above.withColumn("part", F.lit("term")).select(*columns))
