"""Operator 12: a Merkle manifest of documents, with a proof climbed for every leaf.

1. Leaves are hashed in one pass over the texts, as they are and as tampered with; only hashes go
   on. Leaves are dealt by ranges of (source, id) and numbered within their source by counts per
   range, so a source that holds a third of all rows is numbered by many tasks.
2. Levels are built bottom up: every ``FAN`` nodes in a row become the digest of their digests,
   until each source has one node; those nodes, in order of the sources, are the leaves of one more
   tree. A node is stored with its children's digests, its place among its parent's children, and a
   link to the parent.
3. A recursive Spark query climbs from the lowest runs of leaves along the parent links. All leaves
   of a run share what lies above it, so one row climbs for up to ``FAN`` leaves: each step appends
   the siblings to the proof once and folds every leaf's digest into the parent's. Nodes with many
   runs below them are repeated under salts, so the way through a root is spread over tasks too.

Digests are bytes while they climb; texts that are hashed hold them as lowercase hex.

Cases: a null value is '-' in a leaf; a null source is a tree of its own and comes first; a null id
comes first in its source and is never tampered with; rows with equal ids are ordered by their
leaves, and equal rows are leaves each; a source with one document has its leaf as its node, and a
table with one document a root equal to its leaf and an empty proof; an empty table gives no rows;
other columns are not looked at.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmill.llm.common import cut

FAN = 16
# Runs of leaves per repetition of a node above them.
SALT_RUNS = 256
# Levels of the tree over sources are numbered from here; no source needs as many.
TOP = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def shown(digests: Column) -> Column:
    """Digests, one or several joined, as lowercase hex."""
    return F.lower(F.hex(digests))


def leaf_text(fields: list[Column]) -> Column:
    """The values, each with its length in bytes before it."""
    texts = [f.cast("string") for f in fields]
    return F.concat(
        *[F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts]
    )


def ranked(df: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``df`` written with ``idx``, the number of a row in its tree from 0 on, and ``n``, the rows
    of the tree, in the order of the other columns."""
    dealt = cut(df.repartitionByRange(tree, *order).withColumn("part", F.spark_partition_id()))
    counts = dealt.groupBy(tree, "part").agg(F.count("*").alias("rows"))
    # As many rows for a tree as it has ranges.
    earlier = Window.partitionBy(tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(tree)
    counts = counts.select(
        tree,
        "part",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
        F.sum("rows").over(whole).alias("n"),
    )
    here = Window.partitionBy(tree, "part").orderBy(*order)
    return cut(
        dealt.join(counts, [tree, "part"])
        .withColumn("idx", F.col("before") + F.row_number().over(here) - 1)
        .drop("before", "part")
    )


def joined(digests: str | Column) -> Column:
    return F.array_join(F.transform(digests, shown), "")


def level_above(nodes: DataFrame) -> DataFrame:
    """Every FAN nodes of a tree in a row as one, of trees that have several."""
    node = F.struct("idx", "hash")
    return cut(
        nodes.filter("n > 1")
        .withColumn("run", F.floor(F.col("idx") / FAN).cast("long"))
        .groupBy("src", "level", "run", "n")
        .agg(
            F.transform(F.array_sort(F.collect_list(node)), lambda c: c["hash"]).alias("children"),
            F.sum("below").alias("below"),
        )
        .select(
            "src",
            (F.col("level") + 1).alias("level"),
            F.col("run").alias("idx"),
            F.ceil(F.col("n") / FAN).cast("long").alias("n"),
            digest(joined("children")).alias("hash"),
            "below",
            "children",
        )
    )


def levels_above(nodes: DataFrame) -> list[DataFrame]:
    """All levels above the nodes. What comes to the driver is the size of the largest tree."""
    found, largest = [], nodes.agg(F.max("n")).first()[0] or 0
    while largest > 1:
        nodes = level_above(nodes)
        found.append(nodes)
        largest = -(-largest // FAN)
    return found


def salts(below: Column) -> Column:
    return F.ceil(below / SALT_RUNS).cast("int")


def linked(nodes: DataFrame, above: DataFrame | None) -> DataFrame:
    """Nodes with a link to their parent, which is null for the last node of a tree."""
    inner = F.col("n") > 1
    nodes = nodes.withColumns(
        {
            "p_src": F.when(inner, F.col("src")),
            "p_level": F.when(inner, F.col("level") + 1),
            "p_idx": F.when(inner, F.floor(F.col("idx") / FAN).cast("long")),
            "place": F.pmod("idx", F.lit(FAN)).cast("int"),
        }
    )
    if above is None:
        return nodes.withColumn("p_salts", F.lit(None).cast("int"))
    parents = above.select(
        F.col("src").alias("p_src"), F.col("idx").alias("p_idx"), salts(F.col("below")).alias("p_salts")
    )
    return nodes.join(parents, ["p_src", "p_idx"], "left")


LINK = ("p_src", "p_level", "p_idx", "p_salts", "place")
NODE = ("src", "level", "idx", "n", "hash", "below", *LINK)


def stored_tree(lowest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lowest nodes with their links, and all nodes above them as parent-linked rows."""
    levels = [lowest, *levels_above(lowest)]
    stored = [linked(*pair) for pair in zip(levels, [*levels[1:], None])]
    ends = [level.filter("n = 1").select("src", "hash", "below") for level in levels]
    last = ends[0]
    for more in ends[1:]:
        last = last.unionByName(more)
    # The last nodes of all sources, in the order of these, are a tree of their own.
    last = last.select(F.lit("").alias("src"), F.col("src").alias("own"), "hash", "below")
    last = ranked(last, "src", ["own"]).withColumn("level", F.lit(TOP))
    upper = levels_above(last)
    roots = linked(last, upper[0] if upper else None).select(
        F.col("own").alias("src"), *[F.col(c).alias(f"r_{c}") for c in LINK]
    )

    def rooted(nodes: DataFrame, *more: str) -> DataFrame:
        own = [
            F.when(F.col("n") > 1, F.col(c)).otherwise(F.col(f"r_{c}")).alias(c) for c in LINK
        ]
        kept = [c for c in NODE if c not in LINK]
        return nodes.join(roots, "src", "left").select(*kept, *own, *more)

    nodes = [rooted(level, "children") for level in stored[1:]]
    nodes += [
        linked(*pair).select(*NODE, "children") for pair in zip(upper, [*upper[1:], None])
    ]
    empty = rooted(stored[0]).withColumn("children", F.array(F.col("hash"))).filter(F.lit(False))
    return rooted(stored[0], "leaves"), reduce(DataFrame.unionByName, nodes, empty)


# One row climbs for the leaves of a run. A parent takes a run's salt, so that its rows meet a
# number of runs that doesn't grow. The last node climbed to has no parent.
CLIMB = """
WITH RECURSIVE climb (run, src, level, idx, salts, place, folded, proof, hash, subroot) AS (
  SELECT run, p_src, p_level, p_idx, p_salts, place, folded, X'', hash, hash FROM {start}
  UNION ALL
  SELECT c.run, p.p_src, p.p_level, p.p_idx, p.p_salts, p.place,
    transform(c.folded, f -> unhex(sha2(concat(
      array_join(transform(slice(p.children, 1, c.place), x -> lower(hex(x))), ''),
      lower(hex(f)),
      array_join(transform(slice(p.children, c.place + 2, {fan}), x -> lower(hex(x))), '')), 256))),
    concat(c.proof, unhex(array_join(transform(concat(slice(p.children, 1, c.place),
      slice(p.children, c.place + 2, {fan})), x -> hex(x)), ''))),
    p.hash, CASE WHEN p.level < {top} THEN p.hash ELSE c.subroot END
  FROM climb c JOIN {nodes} p
    ON p.src = c.src AND p.level = c.level AND p.idx = c.idx AND p.salt = pmod(c.run, c.salts)
)
SELECT run, folded, proof, hash AS root, subroot FROM climb WHERE idx IS NULL
"""


@contextmanager
def any_number_of_rows(spark: SparkSession):
    """Lifts Spark's limit on the rows of a recursive query, and puts it back."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def climbed(lowest: DataFrame, nodes: DataFrame) -> DataFrame:
    """Per lowest run what its leaves fold to, the proof they share, root and subroot."""
    spark = lowest.sparkSession
    nodes = cut(
        nodes.withColumn("salt", F.explode(F.sequence(F.lit(0), salts(F.col("below")) - 1)))
    )
    name = f"starmill_{uuid.uuid4().hex}"
    views = {"start": f"{name}_start", "nodes": f"{name}_nodes"}
    lowest.createOrReplaceTempView(views["start"])
    nodes.createOrReplaceTempView(views["nodes"])
    try:
        with any_number_of_rows(spark):
            return cut(spark.sql(CLIMB.format(**views, fan=FAN, top=TOP)))
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)


def without(digests: str, place: Column) -> Column:
    return F.concat(F.slice(digests, F.lit(1), place), F.slice(digests, place + 2, F.lit(FAN)))


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Per document doc_id and, as bytes, leaf, subroot, root, proof and folded_root.

    ``tampered`` is the text found where it isn't the text of the manifest, else null; by default
    every fifth id by its checksum has its capitals A to Z lowered. The proof is the digests of all
    siblings up to the root.
    """
    text = F.col("text").cast("string")
    if tampered is None:
        crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
        tampered = F.when(crc % 5 == 0, F.translate(text, UPPER, LOWER))
    rest = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    source = F.col("source").cast("string")
    leaves = docs.select(
        "doc_id",
        # Null comes before all texts, the empty one too; texts stay in the order of their bytes.
        F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source)).alias("src"),
        digest(leaf_text([*rest, text])).alias("hash"),
        F.when(tampered.isNotNull(), digest(leaf_text([*rest, tampered]))).alias("found"),
    ).withColumn("found", F.coalesce("found", "hash"))
    # Written before they are dealt, as ranges are drawn from a reading of their own.
    leaves = ranked(cut(leaves), "src", ["doc_id", "hash"])

    leaf = F.struct((F.col("idx") % FAN).cast("int").alias("place"), "doc_id", "hash", "found")
    lowest = cut(
        leaves.withColumn("run", F.floor(F.col("idx") / FAN).cast("long"))
        .groupBy("src", "run", "n")
        .agg(F.array_sort(F.collect_list(leaf)).alias("leaves"))
        .select(
            "src",
            F.lit(1).alias("level"),
            F.col("run").alias("idx"),
            F.ceil(F.col("n") / FAN).cast("long").alias("n"),
            F.when(F.col("n") == 1, F.col("leaves")[0]["hash"])
            .otherwise(digest(joined(F.transform("leaves", lambda e: e["hash"]))))
            .alias("hash"),
            F.lit(1).cast("long").alias("below"),
            "leaves",
        )
    )
    lowest, nodes = stored_tree(lowest)
    children = F.transform("leaves", lambda e: e["hash"])
    lowest = lowest.withColumn("children", children)
    fold = lambda e: digest(
        F.concat(
            joined(F.slice("children", F.lit(1), e["place"])),
            shown(e["found"]),
            joined(F.slice("children", e["place"] + 2, F.lit(FAN))),
        )
    )
    # A source of one document has its leaf as its node.
    alone = (F.col("n") == 1) & (F.size("leaves") == 1)
    folded = F.transform("leaves", lambda e: F.when(alone, e["found"]).otherwise(fold(e)))
    lowest = cut(
        lowest.withColumn("folded", folded).withColumn("run", F.monotonically_increasing_id())
    )
    ends = climbed(lowest.drop("leaves", "children"), nodes)
    return (
        lowest.select("run", "leaves", "children")
        .join(ends, "run")
        .select("children", "folded", "proof", "root", "subroot", F.explode("leaves").alias("e"))
        .select(
            F.col("e.doc_id").alias("doc_id"),
            F.col("e.hash").alias("leaf"),
            "subroot",
            "root",
            F.unhex(F.concat(joined(without("children", F.col("e.place"))), F.hex("proof"))).alias("proof"),
            F.col("folded")[F.col("e.place")].alias("folded_root"),
        )
    )
