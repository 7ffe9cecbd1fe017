"""Benchmark decontamination: a prefix-filtered join of item windows with document words.

Every window of an item is a set of words in an order that documents have to hold whole, so the
containment threshold is 1 and the prefix of a window is its rarest word, by the counts of the
item words in the corpus. Documents are joined with the windows on that word alone; a position
bound (the window has to begin and end inside the document) prunes before the words of the window
are compared with those of the document, exactly and in order.

Documents stream through a broadcast join and are never shuffled, only their hits are. Windows
are broadcast in blocks of a fixed number, so memory is bounded for any benchmark.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes that part words, after A-Z have become a-z: all ASCII but digits and letters.
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Never a word, since a space parts words.
_ONCE = " "
#: Windows of one broadcast; at most some hundred bytes each.
BLOCK_WINDOWS = 50_000


def words(text: Column) -> Column:
    """Words in lower case (A-Z only); a null or empty text has none."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, _GAPS), "")


def item_windows(items: DataFrame, size: int, item_col: str, text_col: str) -> DataFrame:
    """Distinct windows with the ids of their items: window, items, n.

    An item of fewer words than the size is one window as a whole; one without words has none.
    """
    own = items.select(
        F.col(f"`{item_col}`").cast("string").alias("item"), words(F.col(f"`{text_col}`")).alias("w")
    ).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1)))
    return (
        own.select("item", F.explode(F.transform(starts, lambda s: F.slice("w", s, size))).alias("window"))
        .groupBy("window")
        .agg(F.collect_set("item").alias("items"))
        .withColumn("n", F.size("window"))
    )


def _explode_words(docs: DataFrame) -> DataFrame:
    return docs.select(F.explode("w").alias("word"))


def anchors(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Windows with their rarest word in the documents (ties: the least word) and its place."""
    vocabulary = windows.select(F.explode("window").alias("word")).distinct()
    if vocabulary.limit(BLOCK_WINDOWS + 1).count() <= BLOCK_WINDOWS:
        vocabulary = F.broadcast(vocabulary)
    found = _explode_words(docs).join(vocabulary, "word").groupBy("word").agg(F.count("*").alias("found"))
    rarest = (
        windows.select("window", F.explode("window").alias("word"))
        .join(found, "word", "left")
        .groupBy("window")
        .agg(F.min(F.struct(F.coalesce("found", F.lit(0)).alias("found"), "word")).alias("rarest"))
    )
    return windows.join(rarest, "window").select(
        "window",
        "items",
        "n",
        F.col("rarest.word").alias("anchor"),
        (F.array_position("window", F.col("rarest.word")).cast("int") - 1).alias("place"),
    )


def hits(docs: DataFrame, anchored: DataFrame) -> DataFrame:
    """Every occurrence of a window: key, n_words, start, n, items; and one row without a window
    for each document, so that no second scan has to count words."""
    once = anchored.sparkSession.range(1).select(
        F.lit(None).cast("array<string>").alias("window"),
        F.lit(None).cast("array<string>").alias("items"),
        F.lit(None).cast("int").alias("n"),
        F.lit(_ONCE).alias("anchor"),
        F.lit(None).cast("int").alias("place"),
    )
    spread = docs.select(
        "doc_id", "key", "w", F.posexplode(F.concat("w", F.array(F.lit(_ONCE)))).alias("at", "anchor")
    )
    start = F.col("at") - F.col("place")
    inside = (start >= 0) & (start + F.col("n") <= F.size("w"))
    same = F.slice("w", F.greatest(start, F.lit(0)) + 1, F.col("n")) == F.col("window")
    return (
        spread.join(F.broadcast(anchored.unionByName(once)), "anchor")
        .where(F.col("window").isNull() | (inside & same))
        .select("doc_id", "key", F.size("w").cast("long").alias("n_words"), start.alias("start"), "n", "items")
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    size: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted ids), contaminated for each document.

    n_hit: words inside an occurrence of any window. A null text has no words. Rows that repeat
    both id and text are one document; items that repeat an id are one item. Without items no
    document is hit; an empty table gives no rows; other columns are not read.
    """
    own = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("key"),
        words(F.col(f"`{text_col}`")).alias("w"),
    )
    windows = item_windows(items, size, item_col, item_text_col)
    anchored = anchors(own, windows)
    blocks = max(1, -(-windows.count() // BLOCK_WINDOWS))
    found = None
    for b in range(blocks):
        some = anchored
        if blocks > 1:
            some = anchored.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == b)
        block = hits(own, some)
        found = block if found is None else found.unionByName(block)

    # Words covered: stretches in order, each beyond the end of those before.
    stretches = F.sort_array(F.collect_set(F.when(F.col("n").isNotNull(), F.struct("start", "n"))))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("hit"))

    def cover(done: Column, s: Column) -> Column:
        end = F.greatest(done["end"], s["start"] + s["n"])
        more = end - F.greatest(done["end"], s["start"])
        return F.struct(end.alias("end"), (done["hit"] + more).alias("hit"))

    return (
        found.groupBy("doc_id", "key")
        .agg(
            F.max("n_words").alias("n_words"),
            stretches.alias("stretches"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        .select(
            "doc_id",
            "n_words",
            F.aggregate("stretches", zero, cover, lambda done: done["hit"]).alias("n_hit"),
            F.size("items").cast("long").alias("n_items"),
            "items",
            (F.size("stretches") > 0).alias("contaminated"),
        )
    )
