"""Benchmark decontamination with a distributed positional inverted index, DataFrame functions only."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cropmosaic.llm.common import id_text, stored, with_size_hint

#: What stands between words: all of ASCII but digits and letters; every other character belongs to words.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10
#: Lists intersected for each phrase before the phrase is compared word by word.
LISTS = 3


def tokens(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; NULL has none. Cut at the gaps: far cheaper than one match per word."""
    pieces = F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), GAP)
    return F.filter(pieces, lambda w: w != "")  # a gap at either end leaves an empty piece


def word_count(text: Column) -> Column:
    """size(tokens(text)), without the words themselves."""
    pieces = F.split(F.coalesce(text.cast("string"), F.lit("")), GAP)
    blank = (F.element_at(pieces, 1) == "").cast("int") + (F.element_at(pieces, -1) == "").cast("int")
    return F.greatest(F.size(pieces) - blank, F.lit(0))


def phrases(items: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """phrase, length, items: each distinct run of `window` words and the ids (as text) of the items that hold it.

    An item of fewer words is one phrase; one without words has none.
    """
    words = items.select(id_text(F.col(key)).alias("item"), tokens(F.col(text)).alias("words")).filter("size(words) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - window + 1))
    runs = words.select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, window))).alias("run"))
    return runs.groupBy("run").agg(F.sort_array(F.collect_set("item")).alias("items")).select(
        F.array_join("run", " ").alias("phrase"), F.size("run").alias("length"), "items"
    )


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The positional index: a row (term, doc, body, pos) for each place of one of the terms.

    docs: doc, body (the document's key) and text. terms: a column `term`, distinct.
    """
    words = docs.select("doc", "body", F.posexplode(tokens(F.col("text"))).alias("pos", "term"))
    return words.join(terms, "term")


def rarest_terms(wanted: DataFrame, lengths: DataFrame, lists: int) -> DataFrame:
    """phrase -> r0, r1, ...: its terms with the shortest lists and an offset of each, rarest first.

    A phrase with fewer different terms repeats its last; one with a term that no document has is left out.
    """
    places = wanted.select("phrase", "length", F.posexplode(F.split("phrase", " ")).alias("offset", "term"))
    places = places.groupBy("phrase", "length", "term").agg(F.min("offset").alias("offset"))
    known = places.join(lengths, "term", "left").groupBy("phrase", "length").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("places", F.lit(0)).alias("places"), "term", "offset"))).alias("terms")
    )
    known = known.filter(F.col("terms")[0]["places"] > 0)
    picked = [F.col("terms")[F.least(F.lit(i), F.size("terms") - 1)].alias(f"r{i}") for i in range(lists)]
    return known.select("phrase", "length", *picked)


def candidates(docs: DataFrame, wanted: DataFrame, lists: int = LISTS) -> DataFrame:
    """doc, body, phrase, start: where the rarest terms of a phrase stand at their places.

    The lengths of all lists decide which terms are rarest; only lists that some phrase asks for
    are stored. The shortest list of each phrase gives the starts, the next ones are intersected
    with them at their offsets.
    """
    terms = stored(wanted.select(F.explode(F.split("phrase", " ")).alias("term")).distinct())
    terms = with_size_hint(terms, terms.count(), 128)
    words = docs.select(F.explode(tokens(F.col("text"))).alias("term"))
    lengths = stored(words.join(terms, "term").groupBy("term").agg(F.count(F.lit(1)).alias("places")))
    plan = stored(rarest_terms(wanted, lengths, lists))
    asked = stored(plan.select(F.explode(F.array(*[F.col(f"r{i}")["term"] for i in range(lists)])).alias("term")).distinct())
    index = stored(postings(docs, with_size_hint(asked, asked.count(), 128)))
    starts = plan.withColumn("term", F.col("r0")["term"])
    found = index.join(with_size_hint(starts, plan.count(), 512), "term").withColumn("start", F.col("pos") - F.col("r0")["offset"])
    found = found.filter("start >= 0").drop("pos", "term", "r0")
    for i in range(1, lists):
        found = found.withColumn("term", F.col(f"r{i}")["term"]).withColumn("pos", F.col("start") + F.col(f"r{i}")["offset"])
        found = found.join(index, ["doc", "body", "term", "pos"], "left_semi").drop("pos", "term", f"r{i}")
    return found.select("doc", "body", "phrase", "length", "start").distinct()


def find_phrases(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    out: str = "matches",
) -> DataFrame:
    """docs with `out`: an array of (start, length, items) for every place where a phrase of the items stands.

    Texts are compared whole, word by word, after the index has named the places. A NULL or
    empty text has no matches; rows that repeat id and text each get the same ones; all columns
    of docs stay. An empty benchmark gives empty arrays.
    """
    columns = docs.columns
    rows = docs.toDF(*[f"_c{i}" for i in range(len(columns))])
    name, body = f"_c{columns.index(key)}", f"_c{columns.index(text)}"
    id_, content = id_text(F.col(name)), F.coalesce(F.col(body).cast("string"), F.lit(""))
    wanted = stored(phrases(items, item_key, item_text, window))
    keyed = rows.select(id_.alias("doc"), F.xxhash64(content).alias("body"), content.alias("text"))
    places = candidates(keyed, wanted).join(wanted.select("phrase", "items"), "phrase")
    by_doc = stored(
        places.groupBy("doc", "body").agg(F.collect_list(F.struct("start", "length", "phrase", "items")).alias("_places"))
    )
    size = by_doc.agg(F.coalesce(F.sum(F.size("_places")), F.lit(0))).first()[0]
    by_doc = with_size_hint(by_doc, size, 256)
    rows = rows.withColumn("doc", id_).withColumn("body", F.xxhash64(content)).join(by_doc, ["doc", "body"], "left")
    rows = rows.withColumn("_words", F.when(F.col("_places").isNotNull(), tokens(content)))
    real = F.filter("_places", lambda p: F.array_join(F.slice("_words", p["start"] + 1, p["length"]), " ") == p["phrase"])
    real = F.transform(real, lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length"), p["items"].alias("items")))
    none = F.array().cast("array<struct<start:int,length:int,items:array<string>>>")
    return rows.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(columns)], F.coalesce(real, none).alias(out))


def hit_words(matches: Column) -> Column:
    """Words that stand in at least one match."""
    spans = F.array_sort(F.transform(matches, lambda m: F.struct(m["start"].alias("a"), (m["start"] + m["length"]).alias("b"))))
    first = F.struct(F.lit(0).alias("hit"), F.lit(0).alias("end"))

    def add(acc: Column, s: Column) -> Column:
        new = F.greatest(F.lit(0), s["b"] - F.greatest(s["a"], acc["end"]))
        return F.struct((acc["hit"] + new).alias("hit"), F.greatest(acc["end"], s["b"]).alias("end"))

    return F.aggregate(spans, first, add)["hit"]


def hit_items(matches: Column) -> Column:
    """Ids of the items found, as text, sorted."""
    return F.sort_array(F.array_distinct(F.flatten(F.transform(matches, lambda m: m["items"]))))


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items, contaminated."""
    found = find_phrases(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), items, **options)
    ids = hit_items(F.col("matches"))
    hit = hit_words(F.col("matches")).cast("long")
    return found.select(
        "doc_id",
        word_count(F.col("text")).cast("long").alias("n_words"),
        hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        ids.alias("items"),
        (hit > 0).alias("contaminated"),
    )


def near_phrases(docs: DataFrame, items: DataFrame, within: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Proximity matches: doc_id, item, start, end where all words of an item stand within `within` words, in any order.

    A row for every place `end` of a word of the item such that each of its different words has a
    place from end - within to end; start is the largest that still holds all of them. Documents
    are chosen by the rarest word of each item; only in those are the other words looked up. A
    window holds the places of one item in the last `within` words, never pairs of places.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    keyed = docs.select(id_text(F.col(key)).alias("doc"), F.xxhash64(content).alias("body"), content.alias("text"), F.col(key).alias("_id"))
    whole = items.select(id_text(F.col("item_id")).alias("item"), F.array_distinct(tokens(F.col("text"))).alias("words"))
    whole = stored(whole.filter("size(words) > 0").distinct().withColumn("nth", F.xxhash64("item", "words")))
    places = whole.select("item", "nth", F.size("words").alias("needed"), F.explode("words").alias("term"))
    vocabulary = stored(places.select("term").distinct())
    words = keyed.select(F.explode(tokens(F.col("text"))).alias("term"))
    lengths = words.join(with_size_hint(vocabulary, vocabulary.count(), 128), "term").groupBy("term").agg(F.count(F.lit(1)).alias("places"))
    ranked = places.join(lengths, "term", "left").groupBy("nth").agg(
        F.min(F.struct(F.coalesce("places", F.lit(0)).alias("places"), "term")).alias("rarest")
    )
    ranked = stored(ranked.filter("rarest.places > 0").select("nth", F.col("rarest.term").alias("term")))
    rarest = stored(ranked.select("term").distinct())
    found = postings(keyed, with_size_hint(rarest, rarest.count(), 128)).select("doc", "body", "term").distinct()
    chosen = stored(found.join(with_size_hint(ranked, ranked.count(), 128), "term").select("doc", "body", "nth").distinct())
    some = stored(chosen.select("doc", "body").distinct())
    some = with_size_hint(some, some.count(), 64)
    hits = postings(keyed.dropDuplicates(["doc", "body"]).join(some, ["doc", "body"], "left_semi"), with_size_hint(vocabulary, vocabulary.count(), 128))
    hits = hits.join(places, "term").join(chosen, ["doc", "body", "nth"], "left_semi")
    last = Window.partitionBy("doc", "body", "nth").orderBy("pos").rangeBetween(-within, 0)
    seen = hits.withColumn("_seen", F.collect_list(F.struct("term", "pos")).over(last))
    terms = F.array_distinct(F.transform("_seen", lambda s: s["term"]))
    latest = F.transform(terms, lambda t: F.array_max(F.transform(F.filter("_seen", lambda s: s["term"] == t), lambda s: s["pos"])))
    spans = seen.filter(F.size(terms) == F.col("needed")).select("doc", "body", "item", F.array_min(latest).alias("start"), F.col("pos").alias("end"))
    ids = keyed.select("doc", "body", F.col("_id").alias("doc_id")).distinct()
    return spans.join(ids, ["doc", "body"]).select("doc_id", "item", "start", "end").distinct()
