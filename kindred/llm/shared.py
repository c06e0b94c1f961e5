"""Tables, working folders and broadcasts that the text operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.sources.scratch import Scratch, hadoop_path, local_dir, shared_dir  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a table was written there to its end."""
    system, p = hadoop_path(spark, f"{path}/_SUCCESS")
    return system.exists(p)


#: Bytes of a batch that goes to a Python worker: ten thousand whole texts at once would be too many.
BATCH_BYTES = 8 << 20
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def by_batches(frame: DataFrame, work, schema, limit: int = BATCH_BYTES) -> DataFrame:
    """``frame.mapInArrow`` with batches of about ``limit`` bytes at most (one row at least).

    Spark has this bound as a setting of the session only, which is read when the frame runs: where
    the session has none of its own, it is set to ``BATCH_BYTES`` here and stays so. A larger bound
    that the session sets itself is kept; batches are sliced to ``limit`` before ``work`` sees them.
    """
    spark = frame.sparkSession
    if ARROW_BYTES not in spark.conf.getAll:
        spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, parts = batch.num_rows, max(1, round(batch.nbytes / limit))
            step = max(1, -(-rows // parts))
            for at in range(0, rows, step):
                yield batch.slice(at, step) if parts > 1 else batch

    return frame.mapInArrow(lambda batches: work(sliced(batches)), schema)


#: Rows of a key table (one long each) that may be broadcast: 32 MB. Larger ones are joined by a shuffle.
BROADCAST_KEYS = 4_000_000


def small_or_shuffled(frame: DataFrame, rows: int, limit: int = BROADCAST_KEYS) -> DataFrame:
    """``frame`` with a broadcast hint if its counted ``rows`` keep within ``limit``; else as it is."""
    return F.broadcast(frame) if rows <= limit else frame


#: Rows of one key from which a join is planned so that its rows can be read by several tasks.
HEAVY_ROWS = 1000


def join_heavy(left: DataFrame, right: DataFrame, keys: list[str], most: int, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` (one row a key), a key having ``most`` rows on the left at most.

    Adaptive execution splits a skewed partition only where both sides come straight from a shuffle.
    An aggregate by the same keys would lend the join its own partitions, so that with heavy keys the
    right side is dealt out once more.
    """
    if most > HEAVY_ROWS:
        right = right.repartition(*(F.hash(F.col(c)) for c in right.columns))
    return left.join(right, keys, how)


def fold(column: str, parts: int):
    """The fold of an id that the contracts state: crc32 of its text, modulo ``parts``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


def bounded_sample(frame: DataFrame, rows: int, seed: int, key: str = "doc_id") -> DataFrame:
    """``rows`` rows at most, in the order of a hash of ``key``: the same for the same table, however it is split.

    Rows that surely come later are filtered out first, so that tasks send about what is kept.
    """
    here = frame.count()
    mark = F.xxhash64(F.col(key), F.lit(seed))
    if here > rows:
        frame = frame.where(F.pmod(mark, F.lit(1 << 30)) < int(min(1.0, 1.2 * rows / here + 100 / here) * (1 << 30)))
    return frame.orderBy(F.pmod(mark, F.lit(1 << 30)), *frame.columns).limit(rows)
