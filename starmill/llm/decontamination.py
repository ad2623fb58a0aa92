"""Operator 8: benchmark decontamination by a positional inverted index, in DataFrame operations.

1. A window of an item is a phrase of terms at offsets. The documents' words are counted, which
   tells how long the posting list of each term would be, and ranks the terms of a window.
2. The index: each word of a document that is among the two rarest of some window is a posting
   (row, position, term), and is written. Lists of other words, the frequent ones, aren't needed.
3. The list of a window's rarest term and that of its second, each shifted by its offset, are
   intersected. Of the documents left, the words at the places left are compared with the window.
4. Exact matches have every term at its place. ``proximity_matches`` allows each a few words off.

Every step is a join or an aggregation on rows or terms, and no list is ever gathered. A term
that a third of all rows hold is among the rarest only of windows that have no other terms, and
then salted by row.

Cases: null texts and texts without words have no words and no hits; an item without words has no
window; equal windows of several items are matched once and counted for each; an item with a null
id hits words but isn't counted or listed; documents with equal or null keys are told apart by row;
empty tables give no hits, or no rows; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import cut, freed, fresh, numbered

WINDOW = 10
# Tasks that a term's postings are dealt to.
SALTS = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Fixed value: what lies between words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str) -> Column:
    """The words of a text, in order; none for null."""
    lower = F.translate(F.col(f"`{text}`").cast("string"), UPPER, LOWER)
    parts = F.array_remove(F.split(lower, BETWEEN), "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def windows(items: DataFrame, item: str, text: str, size: int) -> DataFrame:
    """``item`` and ``window`` (its words), once per item and distinct window."""
    n = F.size("words")
    starts = F.sequence(F.lit(0), F.greatest(n - size, F.lit(0)))
    return (
        items.select(F.col(item).alias("item"), words(text).alias("words"))
        .where(n > 0)
        .select("item", "words", F.explode(starts).alias("start"))
        .select("item", F.slice("words", F.col("start") + 1, size).alias("window"))
        .distinct()
    )


class Index:
    """Postings of the rarest words of the benchmark's windows in all documents, and the windows.

    ``docs`` is read several times; its column ``row`` tells its rows apart.
    """

    def __init__(
        self,
        docs: DataFrame,
        items: DataFrame,
        row: str,
        text: str = "text",
        item: str = "item_id",
        size: int = WINDOW,
    ):
        spark = docs.sparkSession
        self.docs = docs.select(F.col(f"`{row}`").alias("row"), F.col(f"`{text}`").alias("text"))
        self.items = cut(
            windows(items, item, text, size).withColumn(
                "id", F.unhex(F.md5(F.array_join("window", " ")))
            )
        )
        each = (
            self.items.select("id", "window")
            .distinct()
            .select("id", F.size("window").alias("n"), F.posexplode("window").alias("offset", "word"))
        )
        terms = cut(each.select("word").distinct())
        # How long each list would be. Counted where the texts are read before anything moves.
        counts = (
            self.docs.select(F.explode(words("text")).alias("word"))
            .groupBy("word")
            .agg(F.count("*").alias("df"))
            .join(terms, "word")
        )
        by_rarity = F.sort_array(F.collect_list(F.struct("df", "offset", "word")))  # size at most
        ranked = each.join(counts, "word").groupBy("id", "n").agg(by_rarity.alias("ranked"))
        first, second = F.col("ranked")[0], F.try_element_at("ranked", F.lit(2))
        # A window can only occur if each of its words does. One of a single word has no second.
        self.windows = cut(
            ranked.where(F.size("ranked") == F.col("n")).select(
                "id",
                "n",
                first["offset"].alias("offset"),
                first["word"].alias("word"),
                F.coalesce(second["word"], first["word"]).alias("other"),
                F.coalesce(second["offset"] - first["offset"], F.lit(0)).alias("apart"),
            )
        )
        # The empty word stands for the document itself: each has one in front, so its number of
        # words comes from the same reading of the text as its postings.
        blank = spark.range(1).select(F.lit("").alias("word"))
        rare = cut(
            self.windows.select("word")
            .unionAll(self.windows.select("other"))
            .unionAll(blank)
            .distinct()
        )
        listed = (
            self.docs.select("row", words("text").alias("words"))
            .select(
                "row",
                F.size("words").alias("n_words"),
                F.posexplode(F.concat(F.array(F.lit("")), "words")).alias("pos", "word"),
            )
            .join(rare, "word")
            .select("row", "n_words", (F.col("pos") - 1).alias("pos"), "word")
        )
        listed = cut(listed)
        self.rows = listed.where("pos = -1").select("row", "n_words")
        self.postings = listed.where("pos >= 0").select("row", "pos", "word")

    def starts(self, slack: int = 0) -> DataFrame:
        """``row``, ``id``, ``n`` and ``start`` of all places that a window's two rarest words
        allow, the second at most ``slack`` words off."""
        # Windows that overlap mostly share these two, so lists are intersected once for them.
        pairs = self.windows.select("word", "other", "apart").distinct()
        # A word that very many rows hold is dealt to several tasks.
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        firsts = self.postings.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
        shifts = F.explode(F.sequence(F.lit(-slack), F.lit(slack)))
        wanted = firsts.join(pairs.select("*", salts), ["word", "salt"]).select(
            "row", "word", "other", "apart", F.col("pos").alias("first"), shifts.alias("shift")
        )
        there = self.postings.select("row", "pos", F.col("word").alias("other"))
        met = (
            wanted.withColumn("pos", F.col("first") + F.col("apart") + F.col("shift"))
            .join(there, ["row", "pos", "other"], "left_semi")
            .select("row", "first", "word", "other", "apart")
        )
        met = met.distinct() if slack else met
        return (
            met.join(self.windows, ["word", "other", "apart"])
            .select("row", "id", "n", "offset", (F.col("first") - F.col("offset")).alias("start"))
            .where(F.lit(True) if slack else F.col("start") >= 0)
        )

    def exact_matches(self) -> DataFrame:
        """``row``, ``id``, ``n`` and ``start`` of all occurrences of windows."""
        starts = cut(self.starts().drop("offset"))
        found = self.docs.join(starts, "row").select(
            *starts.columns, F.slice(words("text"), F.col("start") + 1, F.col("n")).alias("window")
        )
        known = self.items.select("id", "window").distinct()
        return found.join(known, ["id", "window"]).select("row", "id", "n", "start")

    def proximity_matches(self, slack: int) -> DataFrame:
        """``row``, ``id``, ``n`` and ``start`` where each word of a window lies at most ``slack``
        words from its place as seen from the rarest word."""
        starts = cut(self.starts(slack))
        known = self.items.select("id", "window").distinct()
        # The rarest word is where the start says it is, the others around their places.
        place = lambda i: F.col("start") + i + 1
        near = lambda i: F.when(i == F.col("offset"), F.lit(0)).otherwise(slack)
        low = lambda i: F.greatest(F.lit(1), place(i) - near(i))
        high = lambda i: place(i) + near(i)
        around = lambda i: F.slice("words", low(i), F.greatest(F.lit(0), high(i) - low(i) + 1))
        there = F.forall(
            F.sequence(F.lit(0), F.col("n") - 1),
            lambda i: F.array_contains(around(i), F.get("window", i)),
        )
        return (
            self.docs.join(starts, "row")
            .select(*starts.columns, words("text").alias("words"))
            .join(known, "id")
            .where(there)
            .select("row", "id", "n", "start")
        )


def covered(matches: DataFrame) -> DataFrame:
    """``row`` and ``n_hit``, the words inside any match, and nothing of overlaps twice."""
    end = F.col("start") + F.col("n")
    before = Window.partitionBy("row").orderBy("start", "n")
    reached = F.max(end).over(before.rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), end - F.greatest("start", F.coalesce(reached, F.lit(0))))
    return (
        matches.select("row", "start", "n")
        .distinct()
        .withColumn("new", new)
        .groupBy("row")
        .agg(F.sum("new").alias("n_hit"))
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    size: int = WINDOW,
) -> DataFrame:
    """Per document its key, ``n_words``, ``n_hit`` and ``items``, the sorted ids (as strings) of
    the items with a window in it."""
    rows = cut(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(f"`{key}`").alias("key"),
            F.col(f"`{text}`").alias("text"),
        )
    )
    index = Index(rows.withColumnRenamed("text", text), items, "row", text, item, size)
    freed(docs.sparkSession)
    matches = cut(index.exact_matches())
    freed(docs.sparkSession)
    named = (
        matches.select("row", "id")
        .distinct()
        .join(index.items.select("id", F.col("item").cast("string").alias("item")), "id")
        .groupBy("row")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    hits = covered(matches).join(named, "row")
    none = F.array().cast("array<string>")
    numbers = index.rows.join(hits, "row", "left")
    return rows.select("row", "key").join(numbers, "row").select(
        F.col("key").alias(key),
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", none).alias("items"),
    )


def without_passages(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item: str = "item_id",
    size: int = WINDOW,
) -> DataFrame:
    """The rows and columns of ``docs`` without a window of an item."""
    row = fresh(docs, "row_number")
    rows = numbered(docs, row)
    index = Index(rows, items, row, text, item, size)
    hit = cut(index.exact_matches().select(F.col("row").alias(row)).distinct())
    freed(docs.sparkSession)
    return rows.join(hit, row, "left_anti").drop(row)
