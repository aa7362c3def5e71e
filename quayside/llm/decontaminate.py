"""Benchmark decontamination in DataFrame functions only.

An item leaks into a document when the document holds at least ``THRESHOLD`` of
the item's distinct five-word shingles, wherever they stand. Words are the
lower-cased runs of letters, marks and digits.

Search: one MinHash order ranks an item's shingles (those that fewer items
share come first, then by hash). A document that holds 80 % of an item's n
shingles lacks at most n - ceil(0.8 n) of them, so it holds at least one of the
item's n - ceil(0.8 n) + 1 smallest: that sketch finds every leak, and its length
follows the item's size. Items are partitioned by size class (powers of two);
a class meets only documents with enough shingles for its smallest item. Rows of a key that repeats
meet every class, as the key's other rows may hold the rest.
Documents meet the sketches by shingle hash, without a shuffle while the
sketches are provably small. Found pairs are then verified by counting the
distinct shingles, as strings, that item and document share.

Defined results: null and empty texts, and texts without words, hold no shingle and never match. A text
of one to four words has one shingle, its whole word sequence. Rows that repeat
a key count as one document with the shingles of all of them; a null key is a key. Repeated item ids
likewise. Only matching pairs are returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.llm.store import shielded, small_side, written

WORDS = 5
THRESHOLD = 0.8
# Stated row widths for the broadcast check: a hash pair, a shingle string with its item, a pair of keys.
HASH_ROW, SHINGLE_ROW, PAIR_ROW = 64, 256, 128


def words(text: str) -> Column:
    return F.filter(
        F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"),
        lambda w: w != "",
    )


def _shingled(value: str) -> Column:
    """Array over the word positions of column ``__w``: ``value`` is SQL over the slice ``s``."""
    each = f"transform(array(slice(__w, i, {WORDS})), s -> {value})[0]"
    return F.expr(f"if(size(__w) = 0, array(), transform(sequence(1, greatest(size(__w) - {WORDS - 1}, 1)), i -> {each}))")


def shingle_hashes() -> Column:
    return _shingled("xxhash64(s)")


def shingle_strings() -> Column:
    return _shingled("array_join(s, ' ')")


def sketches(items: DataFrame, item: str, text: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """All distinct shingles of the items (``item``, ``shingle``, ``n``) and the sketch
    rows (``h``, ``item``, ``need``, ``size_class``)."""
    rows = (
        items.select(F.col(item).alias("item"), words(text).alias("__w"))
        .select("item", F.explode(shingle_strings()).alias("shingle"))
        .distinct()
    )
    sizes = rows.groupBy(F.col("item").alias("sized")).agg(F.count("*").alias("n"))
    shingles = written(
        rows.join(sizes, F.col("item").eqNullSafe(F.col("sized"))).select("item", "shingle", "n"), "item-shingles"
    )
    shared = shingles.groupBy("shingle").agg(F.count("*").alias("items"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy("items", "h", "shingle"))
    sketch = (
        shingles.join(shared, "shingle")
        # hashed as the documents' shingles are: over the words
        .withColumn("h", F.expr("xxhash64(split(shingle, ' '))"))
        .withColumn("need", F.ceil(F.col("n") * F.lit(threshold)))
        .withColumn("size_class", F.expr("int(floor(log2(n)))"))
        .withColumn("rank", rank)
        .filter("rank <= n - need + 1")
        .select("h", "item", "need", "size_class")
    )
    return shingles, sketch


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
    copies: bool = False,
) -> DataFrame:
    """(key, item, n_shared, n_shingles, containment) of every document that holds
    at least ``threshold`` of an item's shingles. ``copies``: rows that repeat a key have the same text."""
    shingles, sketch = sketches(items, item, item_text, threshold)
    sketch = written(sketch, "sketch")
    least = sketch.groupBy("size_class").agg(F.min("need").alias("least"))
    # one row per hash and size class, so that a shingle of many items fans out only for its class
    hashed = small_side(sketch.join(least, "size_class").withColumnRenamed("h", "ih"), HASH_ROW)
    tokens = docs.select(F.col(f"`{key}`").alias("key"), words(text).alias("__w"))
    sized, fits = tokens, F.greatest(F.col("n_words") - (WORDS - 1), F.lit(1)) >= F.col("least")
    if not copies:
        repeated = written(
            docs.groupBy(F.col(f"`{key}`").alias("rk")).agg(F.count("*").alias("rows")).filter("rows > 1").select("rk", F.lit(True).alias("repeats")),
            "repeated-keys",
        )
        if not repeated.isEmpty():
            sized = tokens.join(small_side(repeated, PAIR_ROW), F.col("key").eqNullSafe(F.col("rk")), "left")
            fits = fits | F.col("repeats").isNotNull()
    pairs = (
        sized.select("key", *[c for c in sized.columns if c == "repeats"], F.size("__w").alias("n_words"), F.explode(shingle_hashes()).alias("h"))
        .join(hashed, (F.col("h") == F.col("ih")) & fits)
        .select("key", "item")
        .distinct()
    )
    pairs = written(pairs, "leak-pairs")
    # exact check: only documents that have a candidate are read as strings
    keys = small_side(pairs.select(F.col("key").alias("k")).distinct(), PAIR_ROW)
    strings = (
        tokens.join(keys, F.col("key").eqNullSafe(F.col("k")), "left_semi")
        .select("key", F.explode(F.array_distinct(shingle_strings())).alias("shingle"))
    )
    held = (
        strings.join(small_side(shingles, SHINGLE_ROW), "shingle")
        .join(
            small_side(pairs.select(F.col("key").alias("k"), F.col("item").alias("i")), PAIR_ROW),
            F.col("key").eqNullSafe(F.col("k")) & F.col("item").eqNullSafe(F.col("i")),
            "left_semi",
        )
        .select("key", "item", "n", "shingle")
        .distinct()
        .groupBy("key", "item", "n")
        .agg(F.count("*").alias("n_shared"))
    )
    return held.filter(F.col("n_shared") >= F.ceil(F.col("n") * F.lit(threshold))).select(
        F.col("key").alias(key),
        F.col("item").alias(item),
        "n_shared",
        F.col("n").alias("n_shingles"),
        (F.col("n_shared") / F.col("n")).alias("containment"),
    )


@shielded
def drop_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no item. Copies share one verdict: the text's
    digest is the key, so rows need no id."""
    digest = F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256)
    keyed = docs.select(digest.alias("__digest"), F.col(f"`{text}`").alias("__text"))
    bad = written(
        find_leaks(keyed, items, "__digest", "__text", item, item_text, copies=True).select(F.col("__digest").alias("__bad")).distinct(),
        "leaking-texts",
    )
    kept = docs.withColumn("__digest", digest).join(
        small_side(bad, PAIR_ROW), F.col("__digest") == F.col("__bad"), "left_anti"
    )
    return kept.drop("__digest")
