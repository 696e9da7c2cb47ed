"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

#: Rows that are handed to Python at a time, and rows of them that are turned into Python objects at a time; whole texts are long rows,
#: so the session's usual 10,000 would hold hundreds of megabytes in the executor and again in its worker.
BATCH, ROWS = 500, 256
_BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"

_HELD: dict[str, dict] = {}


def held_by_worker(operator: str) -> dict:
    """What a Python worker keeps between the tasks of one operator (models and memos). A task of another operator drops it."""
    return _HELD.setdefault(operator, {})


def drop_others(keeps: str) -> None:
    for operator, state in _HELD.items():
        if operator != keeps:
            state.clear()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, *more: str) -> DataFrame:
    """Only the columns an operator reads; any other column of ``docs`` is ignored, whatever its name."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def map_arrow(df: DataFrame, schema: str | StructType, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[dict]], keeps: str = "") -> DataFrame:
    """``mapInArrow`` whose function yields dicts of columns (lists, numpy or Arrow arrays).

    ``keeps`` names the operator whose state a worker keeps. The session's Arrow batches are cut to ``BATCH`` rows if they are larger.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH_KEY)) <= BATCH:
        conf.set(_BATCH_KEY, BATCH)
    struct = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(struct)

    def run(batches):
        drop_others(keeps)
        for columns in fn(slices(batches)):
            arrays = [as_array(columns[f.name], f.type) for f in arrow]
            if len(arrays[0]):
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, struct)


def as_array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def octets(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A text column as UTF-8 bytes, null as empty."""
    return [x or b"" for x in batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()]


def longs(batch: pa.RecordBatch, name: str = "doc_id") -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit mixer (the finaliser of splitmix64), vectorised."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + _GOLD * np.uint64(seed + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Memo:
    """A bounded memo of two generations: what is used stays, what is not used for a generation goes."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def values(self, keys: list, compute: Callable[[list], list]) -> list:
        """The values of ``keys``, in their order; those not known are computed together. No value is None."""
        found = list(map(self.young.get, keys))
        if None in found:
            young, old, missing = self.young, self.old, []
            for key in {k for k, v in zip(keys, found, strict=True) if v is None}:
                if key in old:
                    young[key] = old[key]
                else:
                    missing.append(key)
            young.update(zip(missing, compute(missing), strict=True))
            found = list(map(young.__getitem__, keys))
            if len(young) > self.limit:
                self.young, self.old = {}, young
        return found
