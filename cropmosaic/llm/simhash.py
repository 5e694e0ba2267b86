"""SimHash near-duplicates with a Gray-order hierarchical index."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from cropmosaic.llm.common import bucket_count, stored, with_size_hint
from cropmosaic.llm.components import components

WORD_BITS, BLOCK_BITS = 64, 16
#: Rows of one masked pattern that a task holds together; larger groups are cut in Gray order.
CELL_ROWS = 2048
#: Cells' worth of rows in a range that one task cuts.
RANGE_CELLS = 32
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_STEP = 1 << 13


def _mixed(hashes: np.ndarray, word: int) -> np.ndarray:
    """Further 64 bits from each hash: unchanged for word 0, else a multiply-and-shift mix."""
    if not word:
        return hashes
    x = hashes ^ np.uint64(0x9E3779B97F4A7C15 * word % (1 << 64))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(text: bytes | None, shingle: int, seed: int = 42) -> np.ndarray:
    """64-bit hashes of the shingles, in order and with repeats; a text of fewer words is one shingle."""
    found = (text or b"").translate(_LOWER).split()
    if len(found) < shingle:
        runs = [b" ".join(found)] if found else []
    else:
        runs = list(map(b" ".join, zip(*(found[i:] for i in range(shingle)))))
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in runs), np.uint64, len(runs))


def fingerprint(text: bytes | None, shingle: int, words: int = 1, seed: int = 42) -> bytes:
    """words x 64 bits, the first bit first: a bit is 1 if it is set in over half the hashes of the shingles.

    A text of fewer words is one shingle; without words all bits are 0.
    """
    return majority(shingle_hashes(text, shingle, seed), words)


def majority(hashes: np.ndarray, words: int) -> bytes:
    """words x 64 bits: a bit is 1 if it is set in over half the hashes."""
    ones = np.zeros(WORD_BITS * words, np.int64)
    for i in range(0, len(hashes), _STEP):
        part = np.stack([_mixed(hashes[i : i + _STEP], k) for k in range(words)], axis=1).astype(">u8").view(np.uint8)
        bits = np.unpackbits(part, axis=1)
        while len(bits) > 255:  # sums of up to 255 rows fit a byte
            fit = len(bits) // 255 * 255
            ones += bits[:fit].reshape(-1, 255, bits.shape[1]).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
            bits = bits[fit:]
        ones += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes)).tobytes()


def fingerprints(text: Column, shingle: int, words: int = 1, seed: int = 42) -> Column:
    """fingerprint() of a text column, as binary."""

    @F.pandas_udf(BinaryType())
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle, words, seed) for t in texts], dtype=object)

    return prints(text.cast("string").cast("binary"))


def _word(bits: Column, i: int) -> Column:
    """The i-th 64 bits of a fingerprint as a signed number."""
    return F.conv(F.hex(F.substring(bits, 8 * i + 1, 8)), 16, -10).cast("long")


def gray_rank(fp: Column) -> Column:
    """Position of the fingerprint in the Gray sequence, as a signed number of the same order."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


class Forest:
    """Union-find over the rows of a batch; keeps the links that joined two trees."""

    def __init__(self, n: int):
        self.parent = list(range(n))
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist()):
            r, s = self.find(x), self.find(y)
            if r != s:
                self.parent[max(r, s)] = min(r, s)
                self.links.append((x, y))


FAN, PAIRS_AT_ONCE = 4, 1 << 17


def _tree(cells: np.ndarray, bits: np.ndarray, labels: np.ndarray) -> list[dict[str, np.ndarray]]:
    """Levels from leaves to root. A node has the bits that all rows below it share (mask, bits), its cells and labels."""
    n = len(bits)
    at = np.arange(n)
    level = dict(first=at, last=at, low=cells, high=cells, least=labels, most=labels, bits=bits, mask=np.full_like(bits, ~np.uint64(0)))
    levels = [level]
    while len(level["first"]) > 1:
        start = np.arange(0, len(level["first"]), FAN)
        end = np.minimum(start + FAN, len(level["first"])) - 1
        some = np.bitwise_or.reduceat(level["bits"], start)
        every = np.bitwise_and.reduceat(level["bits"], start)
        mask = np.bitwise_and.reduceat(level["mask"], start) & ~(some ^ every)
        level = dict(
            first=level["first"][start],
            last=level["last"][end],
            low=level["low"][start],
            high=level["high"][end],
            least=np.minimum.reduceat(level["least"], start),
            most=np.maximum.reduceat(level["most"], start),
            bits=every & mask,
            mask=mask,
        )
        levels.append(level)
    return levels


def _differences(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=1, dtype=np.int64)


def _leaders(cells: np.ndarray, bits: np.ndarray, max_bits: int, forest: "Forest") -> np.ndarray:
    """Link the rows near to a few leaders of each large cell; a label for each row, equal for rows that are linked."""
    labels = np.arange(len(cells))
    edges = np.r_[0, np.flatnonzero(np.diff(cells)) + 1, len(cells)]
    for lo, hi in zip(edges[:-1], edges[1:]):
        open_ = np.arange(lo, hi)
        for _ in range(8):
            if len(open_) < 32:
                break
            near = _differences(bits[open_] ^ bits[open_[0]]) <= max_bits
            labels[open_[near]] = open_[0]
            forest.join(np.full(near.sum() - 1, open_[0]), open_[near][1:])
            open_ = open_[~near]
    return labels


def link_rows(cells: np.ndarray, bits: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest: rows of one cell end in one tree if a chain of pairs at most max_bits apart joins them.

    Rows (n x words) must be sorted by cell and Gray rank. Pairs of nodes are followed from the
    root down. The differences of a pair are those on bits that both nodes share; going down,
    those on newly shared bits are added. Over max_bits the whole pair of groups is dropped, and
    so is one whose rows are all linked already. If even the open bits could not bring a pair
    over max_bits, all its rows are linked at once.
    """
    forest = Forest(len(bits))
    levels = _tree(cells, bits, _leaders(cells, bits, max_bits, forest))
    total, top = WORD_BITS * bits.shape[1], len(levels) - 1
    zero = np.zeros(1, np.int64)
    stack = [(top, zero, zero, np.zeros((1, bits.shape[1]), np.uint64), zero)]
    i, j = (x.ravel() for x in np.meshgrid(np.arange(FAN), np.arange(FAN), indexing="ij"))
    while stack:
        depth, a, b, seen, apart = stack.pop()
        if len(a) > PAIRS_AT_ONCE:
            stack.append((depth, a[PAIRS_AT_ONCE:], b[PAIRS_AT_ONCE:], seen[PAIRS_AT_ONCE:], apart[PAIRS_AT_ONCE:]))
            a, b, seen, apart = a[:PAIRS_AT_ONCE], b[:PAIRS_AT_ONCE], seen[:PAIRS_AT_ONCE], apart[:PAIRS_AT_ONCE]
        at = levels[depth]
        meet = (at["low"][a] <= at["high"][b]) & (at["low"][b] <= at["high"][a])
        one_label = (at["least"][a] == at["most"][a]) & (at["least"][b] == at["most"][b]) & (at["least"][a] == at["least"][b])
        meet &= ~one_label
        a, b, seen, apart = a[meet], b[meet], seen[meet], apart[meet]
        shared = at["mask"][a] & at["mask"][b]
        apart = apart + _differences((at["bits"][a] ^ at["bits"][b]) & shared & ~seen)
        one_cell = (at["low"][a] == at["high"][a]) & (at["low"][b] == at["high"][b]) & (at["low"][a] == at["low"][b])
        near = apart <= max_bits
        whole = near & one_cell & (apart + total - _differences(shared) <= max_bits)
        if not depth:
            forest.join(a[whole & (a != b)], b[whole & (a != b)])
            continue
        for k in np.flatnonzero(whole):
            rows = np.r_[at["first"][a[k]] : at["last"][a[k]] + 1, at["first"][b[k]] : at["last"][b[k]] + 1]
            forest.join(np.full(len(rows) - 1, rows[0]), rows[1:])
        go = near & ~whole
        a, b, shared, apart = a[go], b[go], shared[go], apart[go]
        ca, cb = (a[:, None] * FAN + i).ravel(), (b[:, None] * FAN + j).ravel()
        keep = (ca <= cb) & (cb < len(levels[depth - 1]["first"]))
        up = np.repeat(np.arange(len(a)), FAN * FAN)[keep]
        if len(up):
            stack.append((depth - 1, ca[keep], cb[keep], shared[up], apart[up]))
    return forest.links


def _linker(max_bits: int):
    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def links(rows: pd.DataFrame) -> pd.DataFrame:
            cells, ids = rows["cell"].to_numpy(np.int64), rows["id"].to_numpy(np.int64)
            number = np.concatenate(([0], np.cumsum(cells[1:] != cells[:-1])))
            bits = np.frombuffer(b"".join(rows["bits"]), ">u8").astype(np.uint64).reshape(len(rows), -1)
            pairs = np.array(link_rows(number, bits, max_bits), np.int64).reshape(-1, 2)
            return pd.DataFrame({"a": ids[pairs[:, 0]], "b": ids[pairs[:, 1]]})

        yield from map(links, _whole_cells(batches))

    return link


def _whole_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows, sorted by cell, in parts that do not split a cell."""
    held = None  # the rows of the last cell, which may go on in the next batch
    for batch in batches:
        if not len(batch):
            continue
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        other = np.flatnonzero(rows["cell"].to_numpy() != rows["cell"].iloc[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield rows.iloc[:cut]
        held = rows.iloc[cut:]
    if held is not None and len(held) > 1:
        yield held


def _cells(prints: DataFrame, words: int, max_bits: int) -> DataFrame:
    """(cell, id, bits, gray): upper nodes of the index, one row of a fingerprint for each it belongs to.

    The first masks are blocks of 16 bits. A block value that more than CELL_ROWS fingerprints share is cut in Gray order into chunks with masks of their own, and only pairs of chunks
    whose shared bits allow a link become cells, so no cell has more than twice CELL_ROWS rows.
    """
    blocks = range(WORD_BITS * words // BLOCK_BITS)
    value = lambda i: F.conv(F.hex(F.substring("bits", 2 * i + 1, 2)), 16, 10).cast("long")
    keys = F.array(*[F.lit(i << BLOCK_BITS).cast("long") + value(i) for i in blocks])
    rows = prints.select("id", "bits", gray_rank(_word(F.col("bits"), 0)).alias("gray"), F.explode(keys).alias("key"))
    large = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > CELL_ROWS))
    n, total = large.agg(F.count(F.lit(1)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    if not n:
        return rows.select(F.col("key").alias("cell"), "id", "bits", "gray")
    large = with_size_hint(large.select("key"), n, 32)
    small = rows.join(large, "key", "left_anti").select(F.col("key").alias("cell"), "id", "bits", "gray")
    # ranges of (key, Gray rank) first, chunks within each: a block value of any size is cut by many tasks
    order = ["key", "gray", "bits"]
    ranges = rows.join(large, "key").repartitionByRange(bucket_count(total, RANGE_CELLS * CELL_ROWS), *order)
    ranges = stored(ranges.select("key", "id", "bits", "gray", F.spark_partition_id().cast("long").alias("range")))
    nth = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    chunk = F.col("range") * F.lit(1 << 32) + F.floor((nth - 1) / CELL_ROWS)
    cut = stored(ranges.withColumn("chunk", chunk).select("key", "chunk", "id", "bits", "gray"))
    parts = [_word(F.col("bits"), i) for i in range(words)]
    nodes = cut.groupBy("key", "chunk").agg(
        *[F.bit_and(w).alias(f"all{i}") for i, w in enumerate(parts)], *[F.bit_or(w).alias(f"any{i}") for i, w in enumerate(parts)]
    )
    other = nodes.select("key", *[F.col(c).alias(f"{c}_2") for c in nodes.columns if c != "key"])
    apart = F.lit(0)
    for i in range(words):
        here, there = F.col(f"all{i}"), F.col(f"all{i}_2")
        open_ = here.bitwiseXOR(F.col(f"any{i}")).bitwiseOR(there.bitwiseXOR(F.col(f"any{i}_2")))
        apart = apart + F.bit_count(here.bitwiseXOR(there).bitwiseAND(F.bitwise_not(open_)))
    pairs = nodes.join(other, "key").filter((F.col("chunk") <= F.col("chunk_2")) & (apart <= max_bits))
    cell = F.xxhash64("key", "chunk", "chunk_2")
    pairs = pairs.select("key", cell.alias("cell"), F.explode(F.array_distinct(F.array("chunk", "chunk_2"))).alias("chunk"))
    return small.unionByName(cut.join(pairs, ["key", "chunk"]).select("cell", "id", "bits", "gray"))


def linked_prints(prints: DataFrame, words: int = 1, max_bits: int = 3) -> DataFrame:
    """Distinct fingerprints (id, bits) -> (node, root) for those that link to another; root is the smallest id reached.

    Complete where two linked fingerprints must agree in a block: up to 3 differing bits of 64.
    Beyond that a pair is found if one of its 4 x words blocks agrees.
    """
    cells = _cells(prints, words, max_bits).repartition("cell").sortWithinPartitions("cell", "gray")
    return components(cells.select("cell", "id", "bits").mapInPandas(_linker(max_bits), "a long, b long"))


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, words: int = 1, max_bits: int = 3
) -> DataFrame:
    """One row per document: doc_id, body (hash of the text), bits, component_id, root (a name of the component).

    component_id is the smallest doc_id that a chain of links of at most max_bits differing
    bits reaches, its own included (NULL ids count only if there is no other). Equal
    fingerprints are one node, named by a 64-bit number (their bits, or a hash of more than 64),
    so copies are never paired. NULL, empty and blank texts have fingerprint 0 and link like any
    other; repeated rows each get their row; no rows, no rows.
    """
    body = F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))
    rows = docs.select(F.col(key).alias("doc_id"), body.alias("body"), fingerprints(F.col(text), shingle, words).alias("bits"))
    rows = stored(rows.withColumn("id", _word(F.col("bits"), 0) if words == 1 else F.xxhash64("bits")))
    classes = stored(rows.groupBy("id").agg(F.min("doc_id").alias("least"), F.first("bits").alias("bits")))
    trees = stored(linked_prints(classes.select("id", "bits"), words, max_bits))
    rooted = classes.drop("bits").join(trees, classes["id"] == trees["node"], "left")
    rooted = rooted.select("id", "least", F.coalesce("root", "id").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("id", "root", "component_id")
    return rows.join(named, "id").select("doc_id", "body", "bits", "component_id", "root")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The documents with one of each component of near_duplicates() left: that of the smallest id, then of the smallest hash of its text.

    The columns are those of docs. Texts are not shuffled for the decision: the keys that go
    are subtracted, broadcast when they are few. Of rows that repeat id and text one stays.
    """
    found = stored(near_duplicates(docs, key, text, shingle=shingle, max_bits=max_bits).drop("bits"))
    nameless = F.when(F.col("component_id").isNull(), F.col("root")).alias("nameless")
    first = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = first.groupBy("component_id", nameless).agg(F.min("body").alias("_first")).select("component_id", "_first").distinct()
    keys = found.groupBy(F.col("doc_id").alias("_id"), F.col("body").alias("_body")).count()
    stays = F.col("_id").eqNullSafe(F.col("component_id")) & (F.col("_body") == F.col("_first"))
    gone = stored(keys.join(first, stays, "left_anti").select("_id", "_body"))
    more = stored(keys.filter("count > 1").join(first, stays, "left_semi").select("_id", "_body"))
    columns = docs.columns
    names = [f"_c{i}" for i in range(len(columns))]
    name, content = names[columns.index(key)], names[columns.index(text)]
    rows = docs.toDF(*names).withColumn("_key", F.col(name))
    rows = rows.withColumn("_hash", F.xxhash64(F.coalesce(F.col(content).cast("string"), F.lit(""))))
    match = F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_body"))
    rows = rows.join(with_size_hint(gone, gone.count(), 24), match, "left_anti")
    repeated = more.count()
    if repeated:
        more = with_size_hint(more, repeated, 24)
        nth = F.row_number().over(Window.partitionBy("_key", "_hash").orderBy(F.lit(0)))
        again = rows.join(more, match, "left_semi").withColumn("_nth", nth).filter("_nth = 1").drop("_nth")
        rows = rows.join(more, match, "left_anti").unionByName(again)
    return rows.select(*[F.col(n).alias(c) for n, c in zip(names, columns)])
