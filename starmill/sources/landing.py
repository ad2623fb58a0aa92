"""Landing tables: every cell kept as text, plus a row id and the load time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from starmill.config import LANDING_HEADERS
from starmill.operators.keys import dense_key
from starmill.sources.store import written

MALFORMED = "malformed_line"
# Fixed value: a text that no cell holds, as it is no character.
NO_CELL = "\uffff"


def land_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Mapping[str, str] = LANDING_HEADERS,
    null_tokens: Sequence[str] = (),
    multi_line: bool = False,
    header: bool = True,
) -> DataFrame:
    """CSV to text columns named by ``columns`` (name -> header).

    The header is kept in each column's metadata. Cells equal to one of ``null_tokens`` become
    NULL. A line with too many or too few cells is kept whole in ``malformed_line``, beside the
    cells that could be read; see :func:`malformed_rows`.

    Row ids are 1, 2, 3, ... in the order of the files' paths, then of their lines, however Spark
    splits the files. Without ``header`` the files hold no header line. Where cells hold line
    breaks, ``multi_line`` is needed; large files are read by many tasks then, too, see
    :func:`quoted_records`.
    """
    paths = path if isinstance(path, str) else list(path)
    read = quoted_records if multi_line else single_lines
    rows = read(spark, paths, list(columns.values()), header)

    def cell(name: str, header: str) -> Column:
        c = F.col(f"`{header}`")
        if null_tokens:
            c = F.when(~c.isin(*null_tokens), c)
        return c.alias(name, metadata={"header": header})

    return rows.select(
        "raw_id",
        *[cell(name, header) for name, header in columns.items()],
        MALFORMED,
        F.current_timestamp().alias("imported_at"),
    )


def cells_schema(headers: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(h, T.StringType()) for h in (*headers, MALFORMED)])


# How cells are written. An empty cell in quotes is an empty text, one without them
# is missing; by default the reader takes both for missing, as its mark for missing is ''.
CELLS = {
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": MALFORMED,
    "nullValue": NO_CELL,
}


def placed(lines: DataFrame) -> DataFrame:
    """Lines as they are read, with the split they lie in and their place in its task."""
    return lines.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_place"),
    )


def split_starts(lines: DataFrame) -> DataFrame:
    """One row per split of a file: where it starts among all lines, and at which place its task
    found its first line. Written, as its size then tells Spark how to join it."""
    earlier = W.Window.orderBy("_file", "_start").rowsBetween(W.Window.unboundedPreceding, -1)
    return written(
        lines.groupBy("_file", "_start")
        .agg(F.count("*").alias("_lines"), F.min("_place").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)))
    )


def line_number() -> Column:
    """The number of a line among all lines, from 0 on, over lines and :func:`split_starts`."""
    return F.col("_before") + F.col("_place") - F.col("_first")


def single_lines(
    spark: SparkSession, paths: str | list[str], headers: list[str], header: bool
) -> DataFrame:
    """Rows of files whose cells hold no line breaks: ``raw_id``, cells, the malformed line."""
    reader = spark.read.schema(cells_schema(headers)).options(**CELLS).option("header", header)
    # All cells are read even to count lines, so that a line is judged alike every time. Column
    # order must be checked against the header line, not assumed.
    reader = reader.option("columnPruning", False).option("enforceSchema", not header)
    lines = placed(reader.csv(paths))
    return lines.join(split_starts(lines), ["_file", "_start"]).withColumn(
        "raw_id", line_number() + 1
    )


def quoted_records(
    spark: SparkSession, paths: str | list[str], headers: list[str], header: bool
) -> DataFrame:
    """Rows of files whose quoted cells may hold line breaks: ``raw_id``, cells, the malformed
    record. No file is read by one task alone for that.

    A record goes on in the next line while the quotes so far are odd in number. So only lines
    with an odd number of quotes matter: in the order of a file the first one opens a cell over
    its end of line, the second closes it, and so on. Lines are numbered by counts per split; the
    lines with odd quotes are numbered in the same way, two by two they are the spans of lines
    that belong together, and only lines of such spans are gathered to records.

    Quotes must be doubled inside quoted cells and must not stand in cells without quotes. A cell
    that is never closed ends with its file. A carriage return before a line feed isn't kept.
    """
    lines = placed(spark.read.option("lineSep", "\n").text(paths))
    splits = split_starts(lines)
    lines = lines.join(splits, ["_file", "_start"]).select(
        "_file", "_start", line_number().alias("_line"), "value"
    )
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    odd = written(lines.where(quotes % 2 == 1).select("_file", "_start", "_line"))
    ends = splits.groupBy("_file").agg(
        F.min("_before").alias("_top"), (F.max(F.col("_before") + F.col("_lines")) - 1).alias("_last")
    )
    spans = written(_spans(odd, ends))
    inside = spans.select(
        F.col("_open").alias("_record"),
        F.explode(F.sequence("_open", "_close")).alias("_line"),
    )
    known = lines.join(inside, "_line", "left")
    whole = known.where("_record is null").select("_file", F.col("_line").alias("_record"), "value")
    several = (
        known.where("_record is not null")
        .groupBy("_file", "_record")
        .agg(F.array_sort(F.collect_list(F.struct("_line", "value"))).alias("_parts"))
        .select(
            "_file",
            "_record",
            F.array_join(F.transform("_parts", lambda p: p["value"]), "\n").alias("value"),
        )
    )
    # Line ends of two characters count as one, inside cells too.
    text = F.regexp_replace(F.replace("value", F.lit("\r\n"), F.lit("\n")), "\r$", "")
    records = whole.unionAll(several).withColumn("value", text)
    # The first line of a file is its header; files without a line have none.
    first = F.col("_record") == F.col("_top")
    records = records.join(ends.select("_file", "_top"), "_file")
    schema = ", ".join(f"`{h}` string" for h in (*headers, MALFORMED))
    cells = F.from_csv("value", F.lit(schema), {**CELLS, "multiLine": "true"})
    if header:
        _check_headers(records.where(first).select(cells.alias("c")).select("c.*"), headers)
        records = records.where(~first)
    rows = dense_key(
        records.where("value <> ''").select("_record", cells.alias("_cells")), "raw_id", ["_record"]
    )
    return rows.select("raw_id", "_cells.*")


def _spans(odd: DataFrame, ends: DataFrame) -> DataFrame:
    """``_open`` and ``_close``, the lines at the ends of each span of lines that belong together:
    the odd lines of each file, two by two."""
    counts = odd.groupBy("_file", "_start").agg(F.count("*").alias("_odd"))
    earlier = W.Window.partitionBy("_file").orderBy("_start")
    earlier = earlier.rowsBetween(W.Window.unboundedPreceding, -1)
    counts = counts.select(
        "_file", "_start", F.coalesce(F.sum("_odd").over(earlier), F.lit(0)).alias("_earlier")
    )
    own = F.row_number().over(W.Window.partitionBy("_file", "_start").orderBy("_line"))
    return (
        odd.withColumn("_own", own)
        .join(counts, ["_file", "_start"])
        .select("_file", "_line", (F.col("_earlier") + F.col("_own") - 1).alias("_number"))
        .groupBy("_file", F.floor(F.col("_number") / 2).alias("_pair"))
        .agg(F.min("_line").alias("_open"), F.max("_line").alias("_close"), F.count("*").alias("_n"))
        .join(ends.select("_file", "_last"), "_file")
        .select("_open", F.when(F.col("_n") == 2, F.col("_close")).otherwise(F.col("_last")).alias("_close"))
    )


def _check_headers(found: DataFrame, headers: list[str]) -> None:
    """Raise if a file's header isn't the expected one."""
    other = F.col(f"`{MALFORMED}`").isNotNull()
    for h in headers:
        other = other | ~F.col(f"`{h}`").eqNullSafe(F.lit(h))
    wrong = found.where(other).head(1)
    if wrong:
        raise ValueError(f"a CSV header is not as expected: {wrong[0]}")


def malformed_rows(raw: DataFrame) -> DataFrame:
    """The landed lines with too many or too few cells: what could be read, and the whole line.

    Over files that aren't landed as a table yet, Spark wants some cell to be selected, too.
    """
    return raw.where(F.col(MALFORMED).isNotNull())


def land_orders(orders: DataFrame, customer: DataFrame, lineitem: DataFrame, part: DataFrame):
    """Orders written the way the catalogue extract is: dirty text, one row per order.

    The order's distinct part types are its list of genres. Lines are folded to one row per
    order and type before they are gathered, so a list is never longer than the number of types,
    however many lines an order has.
    """
    typed = lineitem.select("l_orderkey", "l_partkey").join(
        part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey")
    )
    lists = (
        typed.groupBy("l_orderkey", "p_type")
        .agg(F.count("*"))
        .where(F.col("p_type").isNotNull())
        .groupBy("l_orderkey")
        .agg(F.array_sort(F.collect_list("p_type")).alias("types"))
    )
    rows = (
        orders.select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
            "o_orderpriority",
        )
        .join(
            customer.select("c_custkey", "c_name", "c_mktsegment"),
            F.col("o_custkey") == F.col("c_custkey"),
        )
        .join(lists, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    )
    k = F.col("o_orderkey")
    text = lambda c: c.cast("string")
    shifted = k % 1000 == 999
    status, types = F.col("o_orderstatus"), F.array_join("types", ";")
    priced = F.concat(F.lit("$"), text(F.col("o_totalprice").cast("decimal(12,2)")))
    day = F.date_format(F.col("o_orderdate").cast("date"), "d-MMM-yy")
    # The rules that make the rows dirty.
    return rows.select(
        k.cast("bigint").alias("raw_id"),
        F.when(shifted, "SHIFTED ROW")
        .when(k % 3 == 0, F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")))
        .when(k % 3 == 1, F.upper("c_name"))
        .otherwise(F.col("c_name"))
        .alias("app"),
        F.when(shifted, "1.9").otherwise(F.col("c_mktsegment")).alias("category"),
        F.when(k % 7 == 0, "NaN")
        .when(k % 11 == 0, "")
        .otherwise(F.concat(text(k % 6), F.lit("."), text(k % 10)))
        .alias("rating"),
        F.when(shifted, "3.0M").otherwise(text(k % 5000)).alias("reviews"),
        F.when(k % 5 == 0, "Varies with device")
        .when(k % 5 == 1, F.concat(text(k % 100), F.lit("."), text(k % 10), F.lit("M")))
        .when(k % 5 == 2, F.concat(text(k % 900), F.lit("k")))
        .when(k % 5 == 3, F.when(k % 2 == 0, "").otherwise("1,000+"))
        .otherwise(F.concat(text(k % 200), F.lit("m")))
        .alias("size"),
        F.concat(text(k % 9 + 1), F.lit(",000+")).alias("installs"),
        F.when(shifted, "0").when(status == "F", "Free").when(status == "O", "Paid").alias("type"),
        F.when(shifted, "Everyone")
        .when(k % 101 == 0, "$4.99")
        .when((status == "O") & (k % 103 != 0), priced)
        .otherwise("0")
        .alias("price"),
        F.when(shifted, "")
        .otherwise(F.expr("substring(o_orderpriority, 3)"))
        .alias("content_rating"),
        F.when(shifted, "11-Feb-18")
        .when(k % 13 == 0, F.concat(types, F.lit(";")))
        .when(k % 17 == 0, F.lower(F.replace(types, F.lit(";"), F.lit(" ; "))))
        .otherwise(types)
        .alias("genres"),
        F.when(k % 997 == 0, "").otherwise(day).alias("last_updated"),
        F.when(k % 50 == 0, "NaN")
        .when(k % 51 == 0, "n/a")
        .otherwise(F.concat(F.lit("1."), text(k % 10)))
        .alias("current_ver"),
        F.when(k % 53 == 0, "null")
        .when(k % 59 == 0, "  ")
        .otherwise(F.concat(F.lit("4."), text(k % 4), F.lit(" and up")))
        .alias("android_ver"),
    )
