"""Mixing sources to target weights by exact token budgets."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cropmosaic.llm.common import id_text, running_before, stored, unit_hash

WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_BUCKET = 4_096
MAX_EPOCHS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weight: Column, share: float, max_epochs: float) -> DataFrame:
    """source, source_size, rows -> the same with target.

    The sources share `share` of all words by weight; none gets more than max_epochs times its
    own, and what it leaves goes to the others by weight. That is the filling level L with
    sum(min(cap, weight * L)) = total: in the order of cap / weight the capped sources come
    first. One row per source, so windows over the whole (small) table are used.
    """
    by_ratio = Window.orderBy("_ratio", "_rank")
    ranked = sizes.withColumn("_rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    capped = (
        ranked.withColumn("_weight", weight)
        .withColumn("_cap", F.lit(float(max_epochs)) * F.col("source_size"))
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
    )
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    past = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (
        capped.withColumn("_total", F.lit(float(share)) * F.sum("source_size").over(everything))
        .withColumn("_left", F.col("_total") - F.coalesce(F.sum("_cap").over(past), F.lit(0.0)))
        .withColumn("_level", F.col("_left") / F.sum("_weight").over(onward))
        .withColumn("_found", F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_rank", "_level"))).over(everything))
    )
    target = F.least("_cap", F.coalesce(F.col("_found")["_level"] * F.col("_weight"), F.col("_cap")))
    return level.select("source", "source_size", "rows", target.alias("target"))


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weight: Column | None = None,
    share: float = 1.0,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, epochs, position.

    Within each source documents are put in the order of a hash-random key (`position`); words
    before each document are distributed prefix sums, and the source's budget (its target,
    rounded) is cut exactly: full epochs take every document whole, the last one takes documents
    from the front and a part of the one at the cut. `weight` is an expression over `_rank`, the
    position of the source by code point, NULL last (default 1, 2, 3, repeating). Documents
    without words take part with size 0; a source without words has target 0; repeated rows
    count one by one. The order depends on ids and sizes only, so reruns agree.
    """
    weight = F.lit(1.0) + (F.col("_rank") - 1) % 3 if weight is None else weight
    rows = stored(
        docs.select(
            F.col(key).alias("doc_id"),
            F.col(source).cast("string").alias("source"),
            word_count(F.col(text)).alias("size"),
            position(F.col(key)).alias("position"),
        )
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    targets = stored(source_targets(sizes, weight, share, max_epochs)).withColumnRenamed("source", "_source")
    rows = rows.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    buckets = F.ceil(F.col("rows") / ROWS_PER_BUCKET)
    rows = running_before(rows, ["source"], "position", ["doc_id", "size"], "size", buckets, "_before")
    budget = F.round("target").cast("long")
    full = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - full * F.col("source_size")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - F.col("_before")))
    return rows.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (full * F.col("size") + part).cast("long").alias("taken"),
        full.alias("epochs"),
        "position",
    )


def position(key: Column) -> Column:
    return unit_hash(F.lit("mix"), id_text(key))


def first_words(text: Column, words: Column) -> Column:
    """The text up to the end of its n-th word."""
    pieces = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    return F.array_join(F.slice(pieces, F.lit(1), words), "")


def materialize(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mixed corpus with the columns of docs: each document as often as it is taken.

    The document at a source's cut comes once more with its first words only. Documents of which
    nothing is taken are left out, those without words too. Texts are not shuffled: mix() works
    on ids and sizes, and what goes back to the documents is one row per source, its full epochs
    and its cut. Only rows that repeat the one at the cut are numbered to share what is left.
    """
    columns = docs.columns
    names = [f"_c{i}" for i in range(len(columns))]
    body, name, origin = (names[columns.index(c)] for c in (text, key, source))
    taken = stored(mix(docs, key, text, source, **options))
    part = F.col("taken") - F.col("epochs") * F.col("size")
    at = F.struct("position", "doc_id", "size")
    cuts = (
        taken.withColumn("_part", part)
        .groupBy("source", at.alias("_at"))
        .agg(F.sum("_part").alias("_part"), F.max("epochs").alias("epochs"))
        .groupBy("source")
        .agg(
            F.max("epochs").alias("_epochs"),
            F.max(F.when(F.col("_part") > 0, F.struct("_at", "_part"))).alias("_cut"),
        )
        .withColumnRenamed("source", "_source")
    )
    rows = docs.toDF(*names)
    here = F.struct(position(F.col(name)).alias("position"), F.col(name).alias("doc_id"), word_count(F.col(body)).alias("size"))
    rows = rows.withColumn("_at", here).join(stored(cuts), F.col(origin).cast("string").eqNullSafe(F.col("_source")))
    size = F.col("_at")["size"]
    at_cut = F.coalesce(F.col("_at") == F.col("_cut")["_at"], F.lit(False))
    before = F.coalesce(F.col("_at") < F.col("_cut")["_at"], F.lit(False))
    rest = rows.filter(~at_cut).withColumn("_last", F.when(before, size).otherwise(0).cast("long"))
    number = F.row_number().over(Window.partitionBy("_source").orderBy(name))
    cut = rows.filter(at_cut).withColumn("_nth", number)
    left = F.col("_cut")["_part"] - (F.col("_nth") - 1) * size
    cut = cut.withColumn("_last", F.greatest(F.lit(0).cast("long"), F.least(size, left))).drop("_nth")
    copies = rest.unionByName(cut).filter(size > 0)
    times = F.col("_epochs") + F.when(F.col("_last") == size, 1).otherwise(0)
    cut_at = F.when((F.col("_last") > 0) & (F.col("_last") < size), F.array(F.col("_last").cast("int"))).otherwise(
        F.array().cast("array<int>")
    )
    copies = copies.withColumn("_words", F.explode(F.concat(F.array_repeat(F.lit(0), times.cast("int")), cut_at)))
    shown = F.when(F.col("_words") > 0, first_words(F.col(body), F.col("_words"))).otherwise(F.col(body))
    return copies.withColumn(body, shown).select(*[F.col(n).alias(c) for n, c in zip(names, columns)])
