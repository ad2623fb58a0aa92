"""Operator 10: URL rules by a sort-merge range join, in DataFrame operations.

A rule's key is its host with the labels reversed, a slash, then its path: ``example.com/en/``
becomes ``com.example//en/``. All paths it fits on that host lie in one interval of keys, from the key to
the key and a byte no text contains. Intervals of rules nest or are apart. A URL becomes a point
per suffix of its host, the whole host and the empty one included, as a rule holds for subdomains.

Sorted together, the ends of the intervals carry the innermost rule that is open after them: a
start its own rule, an end the rule around it, which is what a stack of open rules would have on
top. A point then takes the last end before it. The sweep runs in range partitions: keys are dealt
out by range, a salt behind them splits a key that many URLs share, and each partition starts with
the last end of the partitions before it, one row of each.

Cases: a null URL or one without ``://`` has an empty host and path; without a rule for it a URL
gets ``default``; the longest rule wins, by characters of host and path, then the one with more
labels; equal rules with two verdicts block; equal rows and rows with equal or null keys are judged
one by one; without rules all get ``default``; an empty table gives an empty one; other columns
are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP = "struct<size:int,labels:int,rule:string,verdict:string>"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Of a URL: what lies between the first ``://`` and ``/``, ``?``, ``#`` or the end, in lower
    case, and what follows up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def labels(host: Column) -> Column:
    """Labels from the last on; none for an empty host."""
    split = F.reverse(F.split(host, r"\.", -1))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(split)


def key_of(reversed_labels: Column, path: Column) -> Column:
    """Bytes that start alike only for one host and paths that start alike: no label holds a
    dot, no host a slash."""
    return F.encode(F.concat(F.array_join(reversed_labels, "."), F.lit("/"), path), "UTF-8")


def ends_of(rules: DataFrame) -> DataFrame:
    """``key`` and ``top``: both ends of each rule's interval with the rule open after them."""
    own = F.struct(
        F.length(F.concat("host", "path")).alias("size"),
        F.size("labels").alias("labels"),
        F.concat("host", "path").alias("rule"),
        F.col("verdict"),
    ).cast(TOP)
    each = (
        rules.select(
            F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("host"),
            F.coalesce("path", F.lit("")).alias("path"),
            "verdict",
        )
        .where(~F.col("host").rlike("[/?#]"))  # no URL has such a host
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("labels", labels(F.col("host")))
        .withColumn("top", own)
    )
    # The rule around a rule is the longest one on a shorter path of the same host.
    shorter = each.select(
        "host",
        "path",
        F.explode(
            F.when(
                F.length("path") > 0, F.sequence(F.lit(0), F.length("path") - 1)
            ).otherwise(F.array().cast("array<int>"))
        ).alias("n"),
    ).select("host", "path", F.substring("path", F.lit(1), F.col("n")).alias("outer"))
    around = (
        shorter.join(each.select("host", F.col("path").alias("outer"), "top"), ["host", "outer"])
        .groupBy("host", "path")
        .agg(F.max("top").alias("around"))
    )
    none = F.struct(F.lit(-1), F.lit(-1), F.lit(None), F.lit(None)).cast(TOP)
    key = key_of(F.col("labels"), F.col("path"))
    both = F.array(
        F.struct(key.alias("key"), F.col("top").alias("top")),
        F.struct(
            F.concat(key, F.unhex(F.lit("FF"))).alias("key"),
            F.coalesce("around", none).alias("top"),
        ),
    )
    return each.join(around, ["host", "path"], "left").select(F.inline(both))


def judge(
    pages: DataFrame,
    rules: DataFrame,
    key: str = "page_id",
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """Per row of ``pages`` its key, ``host``, ``path``, ``rule`` (null if none fits) and
    ``verdict``. ``rules``: ``host``, ``path`` and ``verdict``."""
    host, path = host_and_path(F.col(url).cast("string"))
    suffixes = F.transform(
        F.sequence(F.lit(0), F.size("labels")), lambda n: F.slice("labels", 1, n)
    )
    points = (
        pages.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(key).alias("own"),
            host.alias("host"),
            path.alias("path"),
        )
        .withColumn("labels", labels(F.col("host")))
        .select("row", "own", "host", "path", F.explode(suffixes).alias("suffix"))
        .select(
            key_of(F.col("suffix"), F.col("path")).alias("key"),
            F.lit(None).cast(TOP).alias("top"),
            F.lit(True).alias("point"),
            "row",
            "own",
            "host",
            "path",
        )
    )
    ends = ends_of(rules).select(
        "key",
        "top",
        F.lit(False).alias("point"),
        *[F.lit(None).cast(t).alias(c) for c, t in points.dtypes[3:]],
    )
    salt = F.xxhash64("row")
    placed = cut(
        points.unionAll(ends)
        .repartitionByRange("key", "point", salt)
        .withColumn("part", F.spark_partition_id())
    )
    last = (
        placed.where("not point")
        .groupBy("part")
        .agg(F.max_by("top", "key").alias("last"))
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the sweep.
    carried = (
        placed.groupBy("part")
        .agg(F.count("*").alias("n"))
        .join(last, "part", "left")
        .select("part", F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    )
    sweep = (
        Window.partitionBy("part")
        .orderBy("key", "point")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    open_rule = F.coalesce(F.last("top", ignorenulls=True).over(sweep), "carried")
    return (
        placed.join(carried, "part")
        .withColumn("open", open_rule)
        .where("point")
        .groupBy("row", "own", "host", "path")
        .agg(F.max("open").alias("best"))
        .select(
            F.col("own").alias(key),
            "host",
            "path",
            F.col("best.rule").alias("rule"),
            F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        )
    )
