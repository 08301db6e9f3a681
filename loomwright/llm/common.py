"""Shared helpers: Arrow maps with bounded batches, column names that cannot clash; scratch tables and components are the
library's own."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, MutableMapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.graph import alone, components, temporary, written

__all__ = ["BATCH_ROWS", "CACHES", "alone", "arrow_map", "begin", "components", "free_name", "give_back", "marked", "short_batches", "temporary", "without", "written"]

#: Rows in an Arrow batch; whole texts can be long, so batches are short.
BATCH_ROWS = 512
#: Bits of the broadcast map that rows are sifted by: 2 MB at most, whatever the input.
SIFT_BITS = 1 << 24
#: What a Python worker keeps from task to task, by operator (module).
CACHES: dict[str, MutableMapping] = {}
_begun = [""]


def begin(operator: str) -> None:
    """A Python worker lives on from stage to stage: when a map of another operator begins, what the others keep goes."""
    if _begun[0] == operator:
        return
    _begun[0] = operator
    for name, cache in CACHES.items():
        if name != operator:
            cache.clear()
    gc.collect()
    give_back()


def give_back() -> None:
    """Return memory that is not in use; a worker lives on and would keep it for later stages."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that begins like ``name`` and that ``df`` does not have, whatever the case of letters."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def short_batches(df: DataFrame) -> None:
    """Let Spark send at most BATCH_ROWS rows to Python at once. The setting is read when a plan is made and there is none
    for a single map, so it stays for the session: later maps get short batches too, with the same rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(df.sparkSession.conf.get(key)) > BATCH_ROWS:
        df.sparkSession.conf.set(key, str(BATCH_ROWS))


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with one output batch per input batch of at most BATCH_ROWS rows."""
    operator = fn.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(operator)
        for batch in batches:
            for k in range(0, batch.num_rows, BATCH_ROWS):
                if (out := fn(batch.slice(k, BATCH_ROWS))) is not None:
                    yield out
        give_back()

    short_batches(df)
    return df.mapInArrow(run, schema)


def marked(rows: DataFrame, key: Column, ids: DataFrame, flag: str) -> DataFrame:
    """``rows`` with a column ``flag``: false where the key (a long) is surely not among the only column of ``ids``. A bit
    map of hashed ids, of at most SIFT_BITS, is broadcast. Hashes that meet make it true, so an exact join has to follow."""
    id_, bucket, bits = (free_name(rows, n) for n in ("id", "bucket", "bits"))
    hashed = lambda c: F.pmod(F.xxhash64(c.cast("long")), F.lit(SIFT_BITS)) + 1
    maps = ids.toDF(id_).select(hashed(F.col(id_)).alias(id_)).groupBy(F.bitmap_bucket_number(id_).alias(bucket)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(id_)).alias(bits))
    at = F.bitmap_bit_position(hashed(key))
    byte = F.conv(F.hex(F.substr(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    j = rows.join(F.broadcast(maps), F.bitmap_bucket_number(hashed(key)) == F.col(bucket), "left")
    hit = F.col(bucket).isNotNull() & (F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1)
    return j.withColumn(flag, F.coalesce(hit, F.lit(False))).drop(bucket, bits)


def without(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """``rows`` whose key (a long) is not among the only column of ``ids``, all columns. Only rows that the sift marks are
    shuffled. Rows without a key stay."""
    flag, gone = free_name(rows, "sift"), free_name(rows, "gone")
    m = marked(rows, F.col(key), ids, flag)
    rest = m.where(flag).join(ids.toDF(gone).distinct(), F.col(key) == F.col(gone), "left_anti")
    return m.where(~F.col(flag)).unionByName(rest).select(*[F.col(f"`{c}`") for c in rows.columns])
