"""Operator 11: what each of five filters removes, alone and in every order.

1. Conditions A to D are expressions over a text; each failing document is a row (document, bit).
2. Condition E, "the text of a document with a smaller id", is an existential self-join: a document
   fails it if a row with its hash, its exact text and a smaller id exists. The right side is
   folded to the smallest id of each text first, so a text that a third of all rows share is one
   row there, and the left side takes only documents whose hash occurs again. Hashes that hold
   many rows are known by then (``HOT`` at most, so they can be broadcast); their documents are
   salted and their right rows repeated for each salt.
3. The ids that fail E are united with those that fail A to D, and the bits of a document are
   combined. Of the bit combinations only counts per part are kept, 32 rows a part at most; all
   orders, steps and Shapley sums are read from these, without going back to documents.

Cases: a null text is empty; an empty text fails A alone (and E if a smaller id is empty too); a
null language is the part ''; a document with a null id can't have or be a smaller id, and has no
labels; documents are rows, so repeated ids count each, and equal ids are not smaller; a document
labelled more than once is good or toxic if any of its labels says so; an empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import cut

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
BIT = {letter: 1 << i for i, letter in enumerate(FILTERS)}
# What lies between words, capitals, and marks that fail a text.
BETWEEN = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = r"[#$%&*|]"
# Hashes that hold more than one in HOT of all rows are salted; there are HOT of them at most.
HOT = 20_000
# Rows of a hot hash per salt.
SALT_ROWS = 1_000


def text_bits(text: Column) -> Column:
    """The bits of A to D that a text fails, as one number."""
    words = F.filter(F.split(text, BETWEEN), lambda w: w != "")
    n_words, distinct = F.size(words), F.size(F.array_distinct(words))
    chars = F.char_length(text)
    capitals = chars - F.char_length(F.translate(text, CAPITALS, ""))
    fails = {
        "A": n_words < 100,
        "B": 100 * distinct.cast("long") < 80 * n_words.cast("long"),
        "C": 100 * capitals.cast("long") > 10 * chars.cast("long"),
        "D": text.rlike(MARKS),
    }
    return sum((F.when(c, F.lit(BIT[k])).otherwise(0) for k, c in fails.items()), F.lit(0))


def copies_of_smaller_ids(base: DataFrame) -> DataFrame:
    """Rows of ``base`` (row, doc_id, text, h) whose text occurs with a smaller doc_id."""
    groups = cut(
        base.filter("doc_id is not null")
        .groupBy("h")
        .agg(F.count("*").alias("n"), F.min("doc_id").alias("a"), F.max("doc_id").alias("z"))
        .filter("a < z")
        .select("h", "n")
    )
    # One number: how many rows lie in groups; what is hot is measured by it.
    total = groups.agg(F.sum("n")).first()[0] or 0
    salts = F.when(
        F.col("n") * HOT > total, F.ceil(F.col("n") / SALT_ROWS).cast("int")
    ).otherwise(F.lit(1))
    groups = groups.select("h", salts.alias("salts"))
    hot = groups.filter("salts > 1")
    repeated = groups.select("h", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    salted = base.join(F.broadcast(hot), "h", "left").withColumn(
        "salt",
        F.when(F.col("salts").isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64("row"), F.col("salts")).cast("int")
        ),
    )
    left = salted.join(repeated, ["h", "salt"], "left_semi")
    right = (
        left.filter("doc_id is not null")
        .groupBy("h", "text")
        .agg(F.min("doc_id").alias("first"), F.max(F.coalesce("salts", F.lit(1))).alias("salts"))
        .select(
            "h", "text", "first", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
        )
    )
    same = ["h", "salt", "text"]
    on = [left[c] == right[c] for c in same] + [right["first"] < left["doc_id"]]
    return left.join(right, on, "left_semi")


def failures(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` its doc_id, part and mask of failed filters."""
    base = cut(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).withColumn("h", F.xxhash64("text"))
    )
    plain = base.select("row", "doc_id", "part", text_bits(F.col("text")).alias("bits"))
    copies = copies_of_smaller_ids(base).select(
        "row", "doc_id", "part", F.lit(BIT["E"]).alias("bits")
    )
    # Every document is a row of ``plain``, failing or not, so none gets lost.
    return (
        plain.unionByName(copies)
        .groupBy("row")
        .agg(F.max("doc_id").alias("doc_id"), F.max("part").alias("part"), F.bit_or("bits").alias("mask"))
    )


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part and mask of failed filters: documents, good ones and toxic ones."""
    # Folded by id before the join: rows without an id, however many, are a few here.
    counted = failures(docs).groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n"))
    marks = (
        labels.filter("doc_id is not null")
        .groupBy("doc_id")
        .agg(
            F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
            F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
        )
    )
    return (
        counted.join(marks, "doc_id", "left")
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
        )
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, with the counts of that step."""
    masks = F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks")  # 32 at most
    steps = (
        combinations(docs, labels)
        .groupBy("part")
        .agg(masks)
        .withColumn("filter_order", F.explode(F.array(*[F.lit(o) for o in ORDERS])))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    )
    order, step = F.col("filter_order"), F.col("step")
    letter = F.substring(order, step, F.lit(1))
    earlier = F.substring(order, F.lit(1), step - 1)
    own = sum((F.when(letter == k, b).otherwise(0) for k, b in BIT.items()), F.lit(0))
    before = sum((F.when(earlier.contains(k), b).otherwise(0) for k, b in BIT.items()), F.lit(0))
    steps = steps.withColumn("own", own).withColumn("before", before)
    own, before = F.col("own"), F.col("before")

    def total(field: str, condition, weight=lambda m: F.lit(1)) -> Column:
        add = lambda m: F.when(condition(m), m[field] * weight(m)).otherwise(0)
        return F.aggregate("masks", F.lit(0).cast("long"), lambda a, m: a + add(m).cast("long"))

    fails = lambda m: m["mask"].bitwiseAND(own) != 0
    gone = lambda m: m["mask"].bitwiseAND(before) != 0
    here = lambda m: fails(m) & ~gone(m)
    # Of all orders, the filter comes first among the m that a document fails in one of m.
    orders = lambda m: F.lit(len(ORDERS)) / F.bit_count(m["mask"])
    return steps.select(
        "part",
        "filter_order",
        F.col("step").cast("int").alias("step"),
        total("n", lambda m: ~fails(m) & ~gone(m)).alias("kept"),
        total("n", here).alias("removed"),
        total("n", lambda m: fails(m) & gone(m)).alias("redundant"),
        total("n", lambda m: m["mask"] == own).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
        total("n", fails, orders).alias("shapley"),
    )
