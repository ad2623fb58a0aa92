"""The whole pipeline over order tables written as a dirty catalogue extract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmill.config import Config
from starmill.plans.layers import Layers
from starmill.sources.landing import land_orders
from starmill.sources.store import LayerStore, bucket_count, file_state

TABLES = ("orders", "customer", "lineitem", "part")
CONFIG = Config(app_sentinels=("SHIFTED ROW",), app_sentinel_prefixes=("SHIFTED",))

_built: dict[str, Layers] = {}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(_path(folder, name))


def landing(spark: SparkSession, folder: str) -> DataFrame:
    return land_orders(*[read_table(spark, folder, t) for t in TABLES])


def layers(spark: SparkSession, folder: str) -> Layers:
    """The layers over the tables in ``folder``, each built at most once per application.

    They are keyed by the state of the files, so changed tables give new layers.
    """
    files, size = file_state(spark, [_path(folder, t) for t in TABLES])
    namespace = f"starmill_{spark.sparkContext.applicationId}_{files}".replace("-", "_").lower()
    if namespace not in _built:
        store = LayerStore(spark, namespace, bucket_count(spark, size), comment="Order tables")
        store.drop_at_exit()
        _built[namespace] = Layers(landing(spark, folder), CONFIG, store)
    return _built[namespace]


def _path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.parquet"
