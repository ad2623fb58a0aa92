"""Helpers the operators share: tables, cuts of the lineage, Arrow batches in small pieces."""

from __future__ import annotations

import ctypes
import gc
import os
import time
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.sources.store import written

# Characters of text that a Python task holds unpacked at a time, and rows at most.
PIECE_CHARS = 1_000_000
PIECE_ROWS = 1_000
# What a worker keeps for further tasks of a stage: by key the stage and the thing.
_held: dict[Any, tuple[int | None, Any]] = {}
# Only some C libraries have it.
TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def share_library(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it, if it isn't
    installed for them."""
    own = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if own not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [own, known]))


def cut(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the folder all executors share, and read back.

    It ends the lineage: executors lost later cost no work that lies before the cut.
    """
    return written(df)


def freed(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of steps that nothing refers to any more, which it otherwise
    does when the driver happens to collect its garbage."""
    for _ in range(2):  # what the first round lets go of, the second finds unused
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def plainly_named(df: DataFrame) -> DataFrame:
    """``df`` with other names for columns whose names hold a dot or a backtick, which Spark's
    functions over Arrow batches can't look up; ``toDF`` gives the names back."""
    names: list[str] = []
    for name in df.columns:
        odd = "." in name or "`" in name
        names.append(fresh(df, f"column_{len(names)}") if odd else name)
    return df.toDF(*names)


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` written with a column ``name`` that tells its rows apart, whatever their keys."""
    return cut(docs.withColumn(name, F.monotonically_increasing_id()))


def lowest(rows: DataFrame, rank: str, sample: int) -> DataFrame:
    """``sample`` rows at most, those of the lowest ``rank``, without that column.

    They are chosen by executors and written, so that no more than these can meet on the driver,
    however many rows have one rank.
    """
    return cut(rows.orderBy(rank).limit(sample)).drop(rank)


def stage() -> int | None:
    """The stage of the task that runs in this process, if any."""
    task = TaskContext.get()
    return task.stageId() if task else None


def held(key: Any, make: Callable[[], Any]) -> Any:
    """What ``make`` returns, made once per worker process for all tasks of a stage. Workers go
    on to other stages, where it would lie beside what they need; there it goes."""
    dropped()
    if key not in _held:
        _held[key] = stage(), make()
    return _held[key][1]


def dropped() -> None:
    """Forgets what was held for other stages than this one."""
    for key in [k for k, (of, _) in _held.items() if of != stage()]:
        del _held[key]


def given_back() -> None:
    """Returns the memory of batches that are gone, and of what other stages held, to the system.
    Arrow's pool and the C library would keep it as long as the worker lives, beside whatever the
    worker does next."""
    dropped()
    pa.default_memory_pool().release_unused()
    if TRIM:
        TRIM(0)


def returning(run: Callable) -> Callable:
    """A function for ``mapInArrow`` that gives its memory back after the last batch: a worker
    waits with it otherwise while the stages that need none run in the JVM."""

    @wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        given_back()

    return whole


def pieces(batch: pa.RecordBatch, text: str = "text") -> Iterator[dict[str, list]]:
    """A batch as dicts of Python lists, each of a few rows and a few million characters."""
    given_back()
    sizes = batch.column(text).cast(pa.large_string())
    sizes = [n or 0 for n in pc.binary_length(sizes).to_pylist()]
    start = chars = 0
    for i, n in enumerate(sizes):
        chars += n
        if chars >= PIECE_CHARS or i + 1 - start >= PIECE_ROWS or i + 1 == len(sizes):
            part = batch.slice(start, i + 1 - start)
            yield {name: part.column(name).to_pylist() for name in batch.schema.names}
            start, chars = i + 1, 0
