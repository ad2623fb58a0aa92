"""The layers from landing rows to the star schema, each table built on first use."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.config import MASTER_SOURCES, Config
from starmill.operators.audit import audit_log
from starmill.operators.bridge import bridge_weights, build_bridge
from starmill.operators.clean import clean_snapshot
from starmill.operators.domains import build_domain, build_multi_value, new_members
from starmill.operators.snapshot import build_snapshot
from starmill.operators.star import build_date_dim, build_dim, build_dw_bridge, build_fact
from starmill.sources.store import LayerStore

MASTERS = ("app", "category", "app_type", "content_rating")
DIMENSIONS = (*MASTERS, "last_updated_date", "genre")


@dataclass(frozen=True)
class LayerTable:
    build: Callable[["Layers"], DataFrame]
    comment: str
    key: str | None = None
    equal_to_key: tuple[str, ...] = ()
    in_place: bool = False


class Layers:
    """Tables by name (``layers["clean"]``) over one landing DataFrame.

    With a store every table is written once and read back; without one the tables are plain
    lazy DataFrames, which suits small inputs and tests. ``given`` replaces tables by name.
    """

    def __init__(
        self,
        raw: DataFrame,
        config: Config | None = None,
        store: LayerStore | None = None,
        given: dict[str, DataFrame] | None = None,
    ):
        self.config = config or Config()
        self.store = store
        self._source = raw
        self._tables: dict[str, DataFrame] = dict(given or {})

    @classmethod
    def written(cls, store: LayerStore, config: Config | None = None) -> Layers:
        """Layers written by an earlier run, from a catalog that still knows their tables."""
        tables = {
            name: store.read(name, spec.key, spec.equal_to_key) for name, spec in TABLES.items()
        }
        return cls(tables["raw"], config, store, tables)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            spec = TABLES[name]
            df = spec.build(self)
            if self.store:
                df = self.store.write(
                    df, name, spec.key, spec.equal_to_key, spec.in_place, spec.comment
                )
            self._tables[name] = df
        return self._tables[name]

    @property
    def source(self) -> DataFrame:
        """The landing rows as their reader delivers them."""
        return self._source

    def masters(self) -> dict[str, DataFrame]:
        return {entity: self[entity] for entity in MASTERS}

    def dims(self) -> dict[str, DataFrame]:
        return {entity: self[f"dim_{entity}"] for entity in DIMENSIONS}

    def append(self, more: DataFrame) -> None:
        """Load a further extract into the written layers, without touching what is there.

        ``more`` is landing rows with ids of their own, such as :meth:`after` gives them. Every
        table gets the rows that both extracts loaded at once would have given besides: names,
        days and genres that are known keep their ids and keys, and new ones go on from the
        highest, that of an Unknown member included. No stored row is read but names and days,
        and no stored file is written again: new files go to the buckets of the new rows.

        All new rows are computed and written aside first, so a load that fails there leaves
        every table as it was.
        """
        if not self.store:
            raise ValueError("only layers with a store can be appended to")
        self.build_all()
        new = Layers(more, self.config)

        def aside(name: str, rows: DataFrame) -> None:
            spec = TABLES[name]
            new._tables[name] = self.store.write(rows, _aside(name), spec.key, spec.equal_to_key)

        def members(name: str, found: DataFrame, keys: list[str], number: str | None = None):
            aside(name, new_members(self[name], found, keys, number))

        def together(name: str) -> DataFrame:
            return self[name].unionByName(new._tables[name])

        aside("raw", more)

        def master(entity: str) -> None:
            sentinels = self.config.sentinels(entity)
            found = build_domain(new["raw"], MASTER_SOURCES[entity], entity, sentinels)
            members(entity, found, [f"{entity}_name_norm"])

        def genre() -> None:
            found = build_multi_value(new["raw"], "genres", "genre", self.config)
            members("genre", found, ["genre_name_norm"], "genre_id")

        at_once(*[partial(master, entity) for entity in MASTERS], genre)
        known = {name: together(name) for name in (*MASTERS, "genre")}
        rows = Layers(new["raw"], self.config, given={**known, "raw": new["raw"]})

        def table(name: str) -> None:
            aside(name, TABLES[name].build(rows))
            rows._tables[name] = new[name]

        def dimension(entity: str) -> None:
            found = build_dim(known[entity], entity)
            members(f"dim_{entity}", found, [f"{entity}_id"], f"{entity}_key")

        def days() -> None:
            found = build_date_dim(new["clean"], "last_updated_date")
            members("dim_last_updated_date", found, ["full_date"], "last_updated_date_key")

        at_once(partial(table, "snapshot"), *[partial(dimension, e) for e in (*MASTERS, "genre")])
        table("bridge")
        at_once(partial(table, "clean"), partial(table, "clean_bridge"))
        at_once(partial(table, "audit_log"), days)
        rows._tables |= {f"dim_{name}": together(f"dim_{name}") for name in DIMENSIONS}
        table("fact")
        table("dw_bridge")

        def add(name: str) -> None:
            spec = TABLES[name]
            self._tables[name] = self.store.append(
                new[name], name, spec.key, spec.equal_to_key, in_place=True
            )
            self.store.drop(_aside(name))

        at_once(*[partial(add, name) for name in TABLES])

    def after(self, more: DataFrame) -> DataFrame:
        """Landing rows numbered from 1 on, with ids that go on from the highest stored one."""
        highest = self["raw"].agg(F.coalesce(F.max("raw_id"), F.lit(0)).alias("_n"))
        return more.withColumn("raw_id", F.col("raw_id") + highest.select("_n").scalar())

    def build_all(self) -> None:
        """Build every table; those that do not read one another are written at the same time."""
        for wave in WAVES:
            at_once(*[partial(self.__getitem__, name) for name in wave])


def at_once(*steps: Callable[[], object]) -> None:
    """Run steps that don't read one another's tables at the same time."""
    with ThreadPoolExecutor(len(steps)) as pool:
        for done in [pool.submit(step) for step in steps]:
            done.result()


def _aside(name: str) -> str:
    return f"{name}__aside"


def _master(entity: str) -> LayerTable:
    def build(ly: Layers) -> DataFrame:
        sentinels = ly.config.sentinels(entity)
        return build_domain(ly["raw"], MASTER_SOURCES[entity], entity, sentinels)

    return LayerTable(build, f"Names of {entity}, one row per normalised name.")


def _dimension(entity: str) -> LayerTable:
    def build(ly: Layers) -> DataFrame:
        return build_dim(ly[entity], entity, entity in ly.config.unknown_members)

    return LayerTable(build, f"Dimension {entity} under a dense key.")


TABLES: dict[str, LayerTable] = {
    "raw": LayerTable(lambda ly: ly._source, "Landing rows, every cell as text.", "raw_id"),
    "category": _master("category"),
    "app_type": _master("app_type"),
    "content_rating": _master("content_rating"),
    "app": _master("app"),
    "snapshot": LayerTable(
        lambda ly: build_snapshot(ly["raw"], ly.masters()),
        "Typed version of each landing row whose app is known.",
        "raw_id",
        ("snapshot_id",),
        in_place=True,
    ),
    "genre": LayerTable(
        lambda ly: build_multi_value(ly["raw"], "genres", "genre", ly.config),
        "Genres found in the separated lists.",
    ),
    "bridge": LayerTable(
        lambda ly: build_bridge(ly["raw"], ly["snapshot"], ly["genre"], ly.config),
        "Snapshots and their genres.",
        "snapshot_id",
        in_place=True,
    ),
    "clean": LayerTable(
        lambda ly: clean_snapshot(
            ly["snapshot"], ly["raw"], ly["app_type"], ly["bridge"], ly.config
        ),
        "Snapshots with quality flags and status.",
        "raw_id",
        ("snapshot_id",),
        in_place=True,
    ),
    "clean_bridge": LayerTable(
        lambda ly: bridge_weights(ly["bridge"]),
        "Snapshots and their genres, weighted so that each snapshot counts once.",
        "snapshot_id",
        in_place=True,
    ),
    "audit_log": LayerTable(
        lambda ly: audit_log(ly["clean"], ly["raw"]), "One row per cleaning decision."
    ),
    "dim_app": _dimension("app"),
    "dim_category": _dimension("category"),
    "dim_app_type": _dimension("app_type"),
    "dim_content_rating": _dimension("content_rating"),
    "dim_genre": _dimension("genre"),
    "dim_last_updated_date": LayerTable(
        lambda ly: build_date_dim(
            ly["clean"],
            "last_updated_date",
            "last_updated_date" in ly.config.unknown_members,
        ),
        "Days of update.",
    ),
    "fact": LayerTable(
        lambda ly: build_fact(ly["clean"], ly.dims(), ly.config.unknown_members),
        "One row per clean snapshot, on dimension keys.",
        "raw_id",
        ("app_snapshot_key", "snapshot_id"),
        in_place=True,
    ),
    "dw_bridge": LayerTable(
        lambda ly: build_dw_bridge(ly["clean_bridge"], ly["fact"], ly["dim_genre"]),
        "Facts and their genres with weights.",
        "app_snapshot_key",
        in_place=True,
    ),
}

# Tables by the step in which all they read is there.
WAVES = (
    ("raw",),
    (*MASTERS, "genre"),
    ("snapshot", *[f"dim_{entity}" for entity in (*MASTERS, "genre")]),
    ("bridge",),
    ("clean", "clean_bridge"),
    ("dim_last_updated_date", "audit_log"),
    ("fact",),
    ("dw_bridge",),
)
