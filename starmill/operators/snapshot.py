"""Typed snapshots: one row per landing row whose app is known."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.functions import parse
from starmill.functions.text import name_key

# Landing column, parser and kind of every typed measure.
TYPED = {
    "rating": ("rating", parse.parse_rating, None),
    "reviews_count": ("reviews", parse.parse_count, "count"),
    "size_bytes": ("size", parse.parse_size, "size"),
    "installs_count": ("installs", parse.parse_installs, "installs"),
    "price_usd": ("price", parse.parse_price, "price"),
    "last_updated_date": ("last_updated", parse.parse_date, "date"),
    "current_version": ("current_ver", parse.parse_text, None),
    "android_version_text": ("android_ver", parse.parse_text, None),
}


# Masters in the order of their lookups. The app comes first, as it leaves rows out.
LOOKUPS = {"app": "inner", "category": "left", "app_type": "left", "content_rating": "left"}


def type_rows(raw: DataFrame) -> DataFrame:
    """Landing rows with typed measures and the normalised names to look up. No shuffle."""
    return raw.select(
        "raw_id",
        name_key(F.col("app")).alias("app_name_norm"),
        name_key(F.col("category")).alias("category_name_norm"),
        name_key(F.col("type")).alias("app_type_name_norm"),
        name_key(F.col("content_rating")).alias("content_rating_name_norm"),
        *[parser(F.col(source)).alias(name) for name, (source, parser, _) in TYPED.items()],
    )


def build_snapshot(raw: DataFrame, masters: dict[str, DataFrame]) -> DataFrame:
    """Typed rows with the ids of their masters.

    The inner join on the app master is what leaves malformed rows out: their app was kept out
    of the master. A landing row gives at most one snapshot, so the row's id also is the
    snapshot's.

    The measures stay where the landing rows are: only :func:`master_ids` goes through lookups,
    and what it found meets the measures on the row id, on the partitioning by that id.
    """
    typed = type_rows(raw)
    measures = typed.select("raw_id", *TYPED)
    # A merge join, as a broadcast one could leave the partitioning of the landing rows.
    found = master_ids(typed, masters).hint("merge")
    return measures.join(found, "raw_id").select(
        F.col("raw_id").alias("snapshot_id"),
        "raw_id",
        "app_id",
        "category_id",
        "app_type_id",
        "content_rating_id",
        *TYPED,
    )


def master_ids(typed: DataFrame, masters: dict[str, DataFrame]) -> DataFrame:
    """``raw_id`` and the master ids of the rows whose app is known.

    A lookup is a sort-merge join when the master is large, and one very frequent name is then
    split by AQE. Masters that are small by the size of their files are broadcast by Spark. Each
    name gives way to its id as soon as it is looked up, so what is shuffled gets narrower.
    """
    rows = typed.select("raw_id", *[f"{entity}_name_norm" for entity in LOOKUPS])
    for entity, how in LOOKUPS.items():
        ids = masters[entity].select(f"{entity}_name_norm", f"{entity}_id")
        rows = rows.join(ids, f"{entity}_name_norm", how).drop(f"{entity}_name_norm")
    return rows


def unreadable_cells(raw: DataFrame) -> DataFrame:
    """Cells of the right shape that no type can hold: (raw_id, column_name, raw_value).

    A strict cast would end the whole load at the first of them; here they load as NULL and are
    listed.
    """
    cells = F.array(
        *[
            F.when(
                parse.unreadable(F.col(source), kind),
                F.struct(F.lit(name).alias("column_name"), F.col(source).alias("raw_value")),
            )
            for name, (source, _, kind) in TYPED.items()
            if kind
        ]
    )
    return raw.select("raw_id", F.inline(cells)).where(F.col("column_name").isNotNull())
