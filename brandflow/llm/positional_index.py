"""Benchmark decontamination with a positional inverted index, in DataFrame operations only.

Index: one posting (term, row, position) for every occurrence of a term in the
training texts. Every task writes the postings of its input as one segment
sorted by term, so a search reads only the row groups of its terms and building
the index moves no posting between tasks. A closing posting per document, whose
position is the document's length, makes the same table answer for lengths.
When the test texts are known beforehand, only their terms are stored.

Search: a phrase occurs where every term's positions, each less its offset in
the phrase, meet. For every phrase the two rarest terms (by postings) are
looked up and their offset-adjusted lists intersected; what is left is compared
with the document's words. So the long lists of common terms are never moved.
Test items are cut into all their windows of ``WINDOW`` words; windows of an
item that share a rarest word share its look-up.

Defined results: null texts have no words. Items with a null id are not
searched. Items that repeat count once for each id. Rows are told apart by
doc_id and text; rows that repeat both get the same figures. Documents without
a hit, also empty ones, have n_hit 0, n_items 0 and the SHA-256 of no bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import free_name, written

WINDOW = 10
#: Between the words of a text whose A-Z are not yet folded.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Stands after the last word of a document; no word contains it.
END = "\x00"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def folded(word: Column) -> Column:
    """A-Z to lower case, other letters as they are. ``lower`` is the faster way where it can only meet A-Z."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, _UPPER, _LOWER))


def raw_words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    return F.xxhash64(F.col(doc_id), F.col(text))


def build_index(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """Postings (term, row, pos, doc_id) of ``docs`` (doc_id, text); doc_id only in closing postings.

    ``terms`` (term): the only terms to store; all by default.
    """
    tokens = docs.select(
        F.col("doc_id"),
        row_key().alias("row"),
        F.posexplode(F.array_append(raw_words(F.col("text")), END)).alias("pos", "raw"),
    ).select("doc_id", "row", "pos", folded(F.col("raw")).alias("term"))
    if terms is not None:
        wanted = terms.select("term").union(terms.sparkSession.createDataFrame([(END,)], "term string")).distinct()
        tokens = tokens.join(written(wanted, "terms"), "term")
    closing = F.when(F.col("term") == END, F.col("doc_id"))
    return written(tokens.select("term", "row", "pos", closing.alias("doc_id")).sortWithinPartitions("term"), "index")


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, words, at, size): a row for every window of every item (item_id, text). ``item`` numbers texts, not ids."""
    words = F.transform(raw_words(F.col("text")), folded)
    texts = items.where(F.col("item_id").isNotNull()).select(words.alias("words")).where(F.size("words") > 0)
    texts = texts.withColumn("item", F.xxhash64("words")).dropDuplicates(["item"])
    size = F.least(F.lit(window), F.size("words"))
    return texts.select("item", "words", size.alias("size"), F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("at"))


def phrase_matches(docs: DataFrame, index: DataFrame, windows: DataFrame) -> DataFrame:
    """(row, item, start, size): every place in ``docs`` where a window occurs, start counted in words."""
    counts = index.where(F.col("term") != END).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    spread = windows.select("item", "at", "size", F.posexplode(F.slice("words", F.col("at") + 1, F.col("size"))).alias("k", "term"))
    of_window = Window.partitionBy("item", "at")
    ranked = (
        spread.join(counts, "term")
        .withColumn("found", F.count(F.lit(1)).over(of_window))
        .where(F.col("found") == F.col("size"))  # a term that is nowhere: the window is nowhere
        .withColumn("rank", F.row_number().over(of_window.orderBy("n", "k")))
        .where("rank <= 2")
        .select("item", "at", "size", "rank", "term", (F.col("at") + F.col("k")).alias("offset"))
    )
    ranked = written(ranked, "rarest")
    pairs = written(
        ranked.groupBy("item", "at", "size").agg(F.min_by("offset", "rank").alias("first"), F.max_by("offset", "rank").alias("second")),
        "windows",
    )

    def adjusted(rank: int) -> DataFrame:
        asked = ranked.where(F.col("rank") == rank).select("term", "item", "offset").distinct()
        return index.join(asked, "term").select("row", "item", (F.col("pos") - F.col("offset")).alias("shift"), "offset").distinct()

    # windows with one word have the same first and second
    first, second = adjusted(1).withColumnRenamed("offset", "first"), adjusted(2).withColumnRenamed("offset", "second")
    wide = first.join(pairs.where("size > 1").select("item", "first", "second").distinct(), ["item", "first"])
    met = wide.join(second, ["row", "item", "shift", "second"]).select("row", "item", "shift")
    single = first.join(pairs.where("size = 1").select("item", "first").distinct(), ["item", "first"]).select("row", "item", "shift")
    places = written(met.union(single).distinct(), "places")

    texts = docs.select(row_key().alias("row"), "text").join(places.select("row").distinct(), "row", "left_semi")
    texts = texts.dropDuplicates(["row"]).select("row", F.transform(raw_words(F.col("text")), folded).alias("text_words"))
    items = windows.groupBy("item").agg(F.first("words").alias("words"), F.first("size").alias("size"))
    starts = F.expr(
        "filter(sequence(0, size(words) - size), s -> shift + s >= 0 and shift + s + size <= size(text_words)"
        " and slice(text_words, shift + s + 1, size) = slice(words, s + 1, size))"
    )
    return (
        places.join(items, "item")
        .join(texts, "row")
        .select("row", "item", "size", F.transform(starts, lambda s: s + F.col("shift")).alias("starts"))
        .select("row", "item", "size", F.explode("starts").alias("start"))
    )


def proximity_matches(index: DataFrame, pairs: DataFrame, within: int) -> DataFrame:
    """(row, first, second, pos, other): occurrences of ``pairs`` (first, second) of terms at most ``within`` words apart.

    The lists of the two terms are cut into blocks of ``within`` words and met
    block by block, so a common pair costs its neighbours only. ``within`` is 1 or more.
    A term meets itself too, at distance 0; pairs that repeat count once.
    """
    if within < 1:
        raise ValueError("within: 1 or more")
    span = F.lit(within)
    a = index.join(pairs.distinct(), F.col("term") == F.col("first")).select("row", "first", "second", "pos", F.floor(F.col("pos") / span).alias("block"))
    b = index.join(pairs.select("second").distinct(), F.col("term") == F.col("second")).select(
        "row", "second", F.col("pos").alias("other"), F.explode(F.array(*[F.floor(F.col("pos") / span) + d for d in (-1, 0, 1)])).alias("block")
    )
    return a.join(b, ["row", "second", "block"]).where(F.abs(F.col("pos") - F.col("other")) <= span).select("row", "first", "second", "pos", "other")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, row, n_words, n_hit, item_ids of every row of ``docs`` (doc_id, text) against ``items`` (item_id, text).

    A word is hit if it lies in an occurrence of a window of an item.
    """
    windows = written(item_windows(items, window), "item-windows")
    index = build_index(docs, windows.select(F.explode("words").alias("term")).distinct())
    found = written(phrase_matches(docs, index, windows), "matches")

    ids = items.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("string").alias("item_id"), F.xxhash64(F.transform(raw_words(F.col("text")), folded)).alias("item")
    )
    named = found.select("row", "item").distinct().join(ids.distinct(), "item").groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    covered = F.expr("sequence(start, start + size - 1)")
    hit = found.select("row", "start", "size").distinct().select("row", F.explode(covered).alias("pos")).distinct().groupBy("row").agg(F.count(F.lit(1)).alias("n_hit"))
    lengths = index.where(F.col("term") == END).select("doc_id", "row", F.col("pos").cast("long").alias("n_words"))
    return (
        lengths.join(hit.join(named, "row"), "row", "left")
        .withColumn("n_hit", F.coalesce("n_hit", F.lit(0)).cast("long"))
        .withColumn("item_ids", F.coalesce("item_ids", F.array().cast("array<string>")))
    )


def without_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, unchanged, in which no window of an item occurs."""
    windows = written(item_windows(items, window), "item-windows")
    index = build_index(docs, windows.select(F.explode("words").alias("term")).distinct())
    hit = written(phrase_matches(docs, index, windows).select("row").distinct(), "contaminated")
    key = free_name(docs.columns, "row")
    return docs.join(hit.withColumnRenamed("row", key), row_key() == F.col(key), "left_anti")
