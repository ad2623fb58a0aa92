"""Master tables: one row per normalised name found in the landing rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.config import Config
from starmill.functions.text import name_key
from starmill.operators.keys import dense_key


def build_domain(
    raw: DataFrame, column: str, entity: str, sentinels: Sequence[str] = (), row_id: str = "raw_id"
) -> DataFrame:
    """Distinct non-blank names of ``column`` except the sentinels.

    The spelling kept for a normalised name is that of its first row, and that row's id is the
    id of the member: unique, equal on every rerun, and known without numbering anything.
    """
    name = F.trim(F.col(column))
    spelled = raw.select(F.col(row_id).alias("first_row"), name.alias("name")).where(
        (F.col("name") != "") & ~F.col("name").isin(*sentinels)
    )
    return _first_spelling(spelled).select(
        F.col("first_row").alias(f"{entity}_id"),
        F.col("name").alias(f"{entity}_name"),
        F.col("name_norm").alias(f"{entity}_name_norm"),
    )


def build_multi_value(
    raw: DataFrame, column: str, entity: str, cfg: Config, row_id: str = "raw_id"
) -> DataFrame:
    """Distinct names in the separated lists of ``column``, blank and date-like ones left out.

    One row can bring several new names, so ids are dense in order of first row, then name.
    """
    spelled = open_lists(raw, row_id, column, cfg).toDF("first_row", "name")
    members = _first_spelling(spelled)
    return dense_key(members, f"{entity}_id", ["first_row", "name_norm"]).select(
        f"{entity}_id",
        F.col("name").alias(f"{entity}_name"),
        F.col("name_norm").alias(f"{entity}_name_norm"),
    )


def open_lists(df: DataFrame, key: str, column: str, cfg: Config) -> DataFrame:
    """(key, value) per element of a separated list, trimmed; blank and date-like ones left out."""
    elements = F.explode(F.split(F.col(column), rf"\Q{cfg.list_separator}\E"))
    values = df.select(key, elements.alias("_element")).select(
        key, F.trim("_element").alias("value")
    )
    return values.where((F.col("value") != "") & ~F.col("value").rlike(cfg.date_like))


def insert_if_absent(
    target: DataFrame,
    new: DataFrame,
    keys: list[str],
    first_by: Sequence[str] = (),
    number: str | None = None,
) -> DataFrame:
    """``target`` plus the rows of ``new`` whose key it lacks, one row per new key.

    Of several new rows with one key the lowest by ``first_by``, then by the other columns, wins.
    ``number`` names a bigint id that ``new`` counts on its own: added rows get the ids after the
    highest of ``target``, in the order of the ids they had, so no id is handed out twice.
    """
    return target.unionByName(new_members(target, new, keys, number, first_by))


def new_members(
    target: DataFrame,
    new: DataFrame,
    keys: list[str],
    number: str | None = None,
    first_by: Sequence[str] = (),
) -> DataFrame:
    """The rows that :func:`insert_if_absent` adds to ``target``."""
    rest = [*first_by, *[c for c in new.columns if c not in keys and c not in first_by]]
    if rest:
        firsts = new.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_first"))
        firsts = firsts.select(*keys, "_first.*")
    else:
        firsts = new.select(*keys).distinct()
    added = firsts.join(target.select(*keys), keys, "left_anti")
    if number:
        highest = target.agg(F.coalesce(F.max(number), F.lit(0)).alias("_n")).select("_n").scalar()
        placed = dense_key(added.withColumnRenamed(number, "_old"), "_place", ["_old", *keys])
        added = placed.withColumn(number, highest + F.col("_place"))
    return added.select(*target.columns)


def _first_spelling(spelled: DataFrame) -> DataFrame:
    """(first_row, name) pairs to one row per normalised name.

    Rows are first folded per exact spelling with a plain minimum, which hash aggregation can
    combine before the shuffle however often a name occurs; only the folded pairs are compared
    as structs.
    """
    folded = spelled.groupBy("name").agg(F.min("first_row").alias("first_row"))
    return (
        folded.groupBy(name_key(F.col("name")).alias("name_norm"))
        .agg(F.min(F.struct("first_row", "name")).alias("first"))
        .select("first.first_row", "first.name", "name_norm")
    )
