"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Groups attached by broadcast instead of by shuffle: the largest ones only,
# so the broadcast is bounded and every other group is below 1/1000 of all rows.
HOT_GROUPS = 1000


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage with a table that survives lost executors, and gives the
    planner real sizes to choose joins by.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._shared_path = path
    return out


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that begins here go as it ends, not when the
    driver happens to collect its garbage: for tables that are written and read
    back.  A frame that is returned to the caller should not be made here."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by :func:`written` that no later plan reads."""
    for df in tables:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._shared_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def give_back() -> None:
    """Return to the system what freed arrays left with the allocators of this
    Python worker: workers outlive their tasks and wait for later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def tidy(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``rows`` for ``mapInArrow``, with :func:`give_back` after the last batch."""
    @functools.wraps(rows)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from rows(batches)
        give_back()

    return run


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def fresh(name: str) -> str:
    """A column name that no table of a user has."""
    return f"_{uuid.uuid4().hex}_{name}"


def attach_group(rows: DataFrame, facts: DataFrame, key: str, size: str, how: str = "inner") -> DataFrame:
    """Join one fact row per ``key`` onto ``rows`` without a hot key's rows
    meeting in one task.

    The facts of the ``HOT_GROUPS`` largest groups (by ``size``) are
    broadcast; the rest join by shuffle, where no group can hold more than
    one thousandth of the rows.  ``rows`` is read twice.
    """
    hot = F.broadcast(facts.orderBy(F.col(size).desc(), F.col(key)).limit(HOT_GROUPS))
    return (rows.join(hot, key)
            .unionByName(rows.join(hot.select(key), key, "left_anti").join(facts, key, how)))


def in_groups(encode, texts: list[str], chars: int = 4_000_000) -> Iterator[bytes]:
    """Apply ``encode`` to runs of texts of about ``chars`` characters."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= chars:
            yield from encode(group)
            group, size = [], 0
    yield from encode(group)


#: Bits of a bitmap that marks keys: a fixed 1 MB, whatever the number of keys.
BITMAP_BITS = 1 << 23
_BUCKET_BITS = 32768  # of Spark's bitmap functions


def bitmap_of(keys: DataFrame, *cols: str, bits: int = BITMAP_BITS) -> DataFrame:
    """A set of keys as a bitmap of fixed size, one row per 4 KB."""
    spot = F.pmod(F.xxhash64(*cols), F.lit(bits))
    return (keys.select((spot / _BUCKET_BITS).cast("int").alias("_bucket"),
                        F.pmod(spot, F.lit(_BUCKET_BITS)).alias("_bit"))
            .groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bitmap")))


def with_mark(df: DataFrame, bitmap: DataFrame, name: str, *cols: str, bits: int = BITMAP_BITS) -> DataFrame:
    """Add boolean ``name``: true for every key in the bitmap (and, rarely,
    for another).  The bitmap is broadcast; its size is fixed."""
    spot = F.pmod(F.xxhash64(*cols), F.lit(bits))
    bucket, marks = fresh("bucket"), fresh("bitmap")
    byte = F.conv(F.hex(F.substring(marks, (F.pmod(spot, F.lit(_BUCKET_BITS)) / 8).cast("int") + 1,
                                    F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, F.pmod(spot, F.lit(8)).cast("int")) == 1, F.lit(False))
    parts = bitmap.select(F.col("_bucket").alias(bucket), F.col("_bitmap").alias(marks))
    return (df.withColumn(bucket, (spot / _BUCKET_BITS).cast("int"))
            .join(F.broadcast(parts), bucket, "left").withColumn(name, hit).drop(bucket, marks))


#: Beyond so many bits (32 MB) a bitmap is not made larger: more keys give more
#: false hits, which cost work but change nothing.
MOST_BITS = 1 << 28


def mark_bits(n_keys: int) -> int:
    """Bits of a bitmap for about ``n_keys`` keys: 16 or more a key, up to
    ``MOST_BITS``."""
    return min(MOST_BITS, max(1 << 20, 1 << max(0, 16 * n_keys - 1).bit_length()))


def marked_by(df: DataFrame, keys: DataFrame, name: str, *cols: str, bits: int) -> DataFrame:
    """Add boolean ``name``: true for every row whose ``cols`` occur in ``keys``
    (and, rarely, for another)."""
    return with_mark(df, bitmap_of(keys, *cols, bits=bits), name, *cols, bits=bits)
