"""Benchmark passages in documents: a prefix-filtered join of window token sets. Built-in functions only.

An item's windows of ``window`` consecutive words (the whole item, if shorter) are sets of short word grams. A document
that contains a window contains all of them, so the necessary prefix is one gram, and the rarest is chosen:

1. Grams of all documents are joined with the benchmark's grams; matches (document, position, gram) are stored. Their counts
   over the whole corpus give the order of rarity.
2. Matches of a window's rarest gram say where the window would begin. Positions outside the text are discarded.
3. What is left is compared word by word with the document, and hits are the union of the windows that do occur.

The benchmark's grams are broadcast if there are at most ``broadcast_grams`` of them and shuffled otherwise. A passage that
many documents share costs each of them its matches: documents are never paired with one another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import mark_probable
from tierlake.llm.exact_dedup import FILTER_BITS, unpacked, whole_rows
from tierlake.sources.staging import stage

BREAK = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 10
GRAM = 5
BROADCAST_GRAMS = 1_000_000


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; null has none."""
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, UPPER.lower())
    return F.array_remove(F.split(lowered, BREAK), "")


def row_place(key: Column, text: Column) -> Column:
    """Identity of a row: a digest of its key (null apart from all others) and its whole text (null as empty)."""
    parts = (F.coalesce(key.cast("long").cast("string"), F.lit("")), F.lit(":"), F.coalesce(text.cast("string"), F.lit("")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _gram(words: str, position: str, size: int) -> Column:
    """Hash of ``size`` words from a 0-based position on."""
    return F.xxhash64(*[F.expr("get({}, {} + {})".format(words, position, i)) for i in range(size)])


def item_windows(items: DataFrame, key: str, text: str, window: int, gram: int) -> DataFrame:
    """Distinct windows: ``passage`` (words), ``size``, ``width`` of its grams and ``items`` (keys as text)."""
    words = items.select(F.col(key).cast("string").alias("item"), words_of(F.col(text)).alias("words"))
    words = words.withColumn("size", F.least(F.size("words"), F.lit(window))).filter("size > 0")
    starts = words.withColumn("start", F.explode(F.expr("sequence(0, size(words) - size)")))
    passages = starts.select("item", "size", F.expr("slice(words, start + 1, size)").alias("passage"))
    return passages.groupBy("passage", "size").agg(F.collect_set("item").alias("items")).withColumn("width", F.least("size", F.lit(gram)))


def benchmark_hits(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: ``row_id``, ``n_words``, ``n_hit`` (words inside an occurring window) and ``items`` (sorted keys).

    Null texts and texts without words have no hits, and such items no windows. Repeated rows get the same result each; rows
    that share a key, or have none, are judged by their own text. A null item key counts hits but isn't listed. Empty tables
    give no rows or no hits. Other columns are ignored. Options are those of ``placed_hits``.
    """
    return placed_hits(docs, items, key, text, **options).drop("place")


def placed_hits(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    broadcast_grams: int = BROADCAST_GRAMS,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """The rows of ``benchmark_hits`` with ``place``, each row's identity by key and text (see ``row_place``)."""
    rows = docs.select(F.col(key).cast("long").alias("row_id"), F.col(text).cast("string").alias("body"))
    rows = rows.withColumn("place", row_place(F.col("row_id"), F.col("body")))
    windows = stage(item_windows(items, item_key, item_text, window, gram).withColumn("window_id", F.xxhash64("passage")), "windows")
    widths = [r["width"] for r in windows.select("width").distinct().collect()]  # at most ``gram`` values
    offsets = windows.withColumn("offset", F.explode(F.expr("sequence(0, size - width)")))
    grams = None
    for width in widths or [gram]:
        part = offsets.filter(F.col("width") == width).select("passage", "size", "items", "offset", "width", _gram("passage", "offset", width).alias("gram"))
        grams = part if grams is None else grams.unionByName(part)
    grams = stage(grams.groupBy("passage", "size", "items", "width", "gram").agg(F.min("offset").alias("offset")), "grams")
    wanted = grams.select("gram", "width").distinct()
    if wanted.count() <= broadcast_grams:
        wanted = F.broadcast(wanted)

    words = rows.select("place", words_of(F.col("body")).alias("words"))
    matches = None
    for width in widths or [gram]:
        longest = words.filter(F.size("words") >= width)
        at = longest.select("place", "words", F.explode(F.expr("sequence(0, size(words) - {})".format(width))).alias("position"))
        own = at.select("place", "position", F.size("words").alias("n"), _gram("words", "position", width).alias("gram"))
        own = own.join(wanted.filter(F.col("width") == width), "gram").select("place", "position", "n", "gram", "width")
        matches = own if matches is None else matches.unionByName(own)
    matches = stage(matches, "matches")
    counts = matches.groupBy("gram", "width").agg(F.count(F.lit(1)).alias("seen"))
    rarest = (
        grams.join(counts, ["gram", "width"])
        .groupBy("passage", "size", "items")
        .agg(F.min_by(F.struct("gram", "offset", "width"), F.struct("seen", "gram")).alias("prefix"))
    )
    prefixes = rarest.select("passage", "size", "items", "prefix.*")
    found = matches.join(prefixes, ["gram", "width"]).withColumn("start", F.col("position") - F.col("offset"))
    found = found.filter("start >= 0 and start + size <= n")
    found = found.groupBy("place").agg(F.collect_set(F.struct("start", "size", "passage", "items")).alias("found"))
    found = stage(found, "candidates")

    marked = mark_probable(rows, F.col("place"), found.select("place"), filter_bits, "probable")
    clean = marked.filter("not probable").select(
        "place",
        "row_id",
        F.regexp_count(F.coalesce("body", F.lit("")), F.lit(WORD)).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_hit"),
        F.expr("cast(array() as array<string>)").alias("items"),
    )
    asked = marked.filter("probable").select("row_id", "place", words_of(F.col("body")).alias("words")).join(found, "place", "left")
    occurring = "filter(coalesce(found, array()), f -> slice(words, f.start + 1, f.size) = f.passage)"
    asked = asked.select("place", "row_id", F.size("words").cast("long").alias("n_words"), F.expr("array_sort({})".format(occurring)).alias("found"))
    union = (
        "aggregate(found, named_struct('hit', 0L, 'upto', 0L), (a, f) -> named_struct("
        "'hit', a.hit + greatest(0L, f.start + f.size - greatest(a.upto, cast(f.start as long))), "
        "'upto', greatest(a.upto, cast(f.start + f.size as long)))).hit"
    )
    hits = asked.select(
        "place",
        "row_id",
        "n_words",
        F.expr(union).alias("n_hit"),
        F.expr("array_sort(array_distinct(flatten(transform(found, f -> f.items))))").alias("items"),
    )
    return clean.unionByName(hits)


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", filter_bits: int = FILTER_BITS, **options) -> DataFrame:
    """The documents without any benchmark window, columns as they were; every row is judged by its own text, whatever its key."""
    hits = placed_hits(docs, items, key, text, filter_bits=filter_bits, **options).filter("n_hit > 0")
    hit = stage(hits.select("place").distinct(), "contaminated")
    rows = whole_rows(docs, own=row_place(F.col(key), F.col(text)))
    marked = mark_probable(rows, F.col("own"), hit, filter_bits, "probable")
    asked = marked.filter("probable").join(hit, F.col("own") == F.col("place"), "left_anti")
    return unpacked(marked.filter("not probable").select("row").unionByName(asked.select("row")))
