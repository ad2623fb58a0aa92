"""The whole pipeline over a catalogue extract in CSV files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from starmill.config import Config
from starmill.plans.layers import Layers
from starmill.sources.landing import land_csv
from starmill.sources.store import LayerStore, bucket_count, file_state


def from_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    namespace: str,
    config: Config | None = None,
    null_tokens: Sequence[str] = (),
    multi_line: bool = False,
    location: str | None = None,
) -> Layers:
    """Layers of the extract at ``path`` (paths and globs), written as tables of database
    ``namespace``.

    The tables lie under ``location``, by default in the folder of checkpoints, which suits trial
    runs. A second run with the same namespace replaces every table whole.
    """
    raw = land_csv(spark, path, null_tokens=null_tokens, multi_line=multi_line)
    _, size = file_state(spark, [path] if isinstance(path, str) else path)
    comment = "Layers from landing rows to star schema"
    store = LayerStore(spark, namespace, bucket_count(spark, size), location, comment)
    return Layers(raw, config, store)
