"""What the training-data operators share: reading, shared intermediate tables, sizing."""

from __future__ import annotations

import ctypes
import math
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Most rows and bytes of one Arrow batch handed to Python (one longer row is a batch of its own).
BATCH_ROWS, BATCH_BYTES = 1000, 4_000_000
#: Bytes of a row group of intermediate tables, which a writing task holds in memory.
GROUP_BYTES = 16_000_000
#: Bytes from which glibc maps an allocation of its own, given back when freed, and the number of that setting (fixed).
MAPPED_BYTES, _MMAP_THRESHOLD = 4_000_000, -3
#: Shards up to which a chunk of texts sends each its own message; beyond, messages go to groups of shards first.
DIRECT = 1 << 10
#: Bytes of messages that a relay takes together.
RELAY_BYTES = 8_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table NAME.parquet (a file or a folder) below sf_dir, through Spark's reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def short_batches(spark: SparkSession) -> None:
    """Keep Arrow batches short, in rows and bytes, so that a task's memory doesn't follow the longest texts.

    Plans take these settings when they run, after the caller has got its DataFrame, so
    they stay for the session; smaller ones of the caller's are left alone.
    """
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        now = int(spark.conf.get(key).rstrip("bB"))
        if not 0 < now <= most:
            spark.conf.set(key, str(most))


def lean(batches: Iterator) -> Iterator:
    """batches, in a Python worker that gives freed memory back to the system.

    Workers live on between tasks and share an executor's memory with its JVM; what they
    keep for later counts against it. Where the C library isn't glibc, nothing is done.
    """
    libc = ctypes.CDLL(None)
    known = hasattr(libc, "mallopt") and hasattr(libc, "malloc_trim")
    if known:
        libc.mallopt(_MMAP_THRESHOLD, MAPPED_BYTES)
    for batch in batches:
        yield batch
        del batch
        if known:
            pa.default_memory_pool().release_unused()
            libc.malloc_trim(0)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a temporary one in local mode, an error on a cluster."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="tablewright-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends at files that outlive executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("parquet.block.size", GROUP_BYTES).parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Folders of this process that stored() has written.
_written: list[str] = []


def release(spark: SparkSession) -> int:
    """Delete the tables that stored() has written so far, and say how many; for when all results built on them are written."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        gone += path.getFileSystem(conf).delete(path, True)
    return gone


# --- messages between chunks of texts and shards -------------------------------


def groups_for(n_shards: int) -> int:
    """Groups that shards form for the way to them: as many as shards, or about their root where a chunk can't address each."""
    return n_shards if n_shards <= DIRECT else math.isqrt(n_shards - 1) + 1


def dealt(to: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each number that occurs in to, with its places; only numbers that occur cost anything."""
    if not len(to):
        return
    order = np.argsort(to.astype(np.uint16) if to.max() < 1 << 16 else to, kind="stable")
    every = to[order]
    edge = np.concatenate([[0], np.flatnonzero(every[1:] != every[:-1]) + 1, [len(to)]]).tolist()
    for a, b in zip(edge, edge[1:]):
        yield int(every[a]), order[a:b]


def relayed(messages: DataFrame, n_shards: int, again: Callable[[int, int, list[tuple[int, bytes]]], Iterator[tuple[int, int, int, bytes]]], name: str) -> DataFrame:
    """messages (shard, kind, chunk, data) at their shards.

    Up to DIRECT shards they are so addressed already. With more, chunks have addressed
    groups of shards (shard modulo groups_for()), so that a chunk sends at most about the
    root of n_shards messages; here each group's are taken RELAY_BYTES at a time and dealt
    to its shards: again(kind, number, [(chunk, data)]) gives the new rows, number telling
    the batches of a group and kind apart. So the messages grow with the input, not with chunks times shards.
    """
    if n_shards <= DIRECT:
        return messages
    columns, n_groups = ["shard", "kind", "chunk", "data"], groups_for(n_shards)

    def relay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, at, number = [], 0, None, 0

        def out() -> Iterator[pd.DataFrame]:
            rows = list(again(at[1], number * n_groups + at[0], held))
            for k in range(0, len(rows), 256):
                yield pd.DataFrame(rows[k : k + 256], columns=columns)

        for batch in batches:
            for shard, kind, chunk, data in zip(batch.shard, batch.kind, batch.chunk, batch.data):
                if held and ((shard, kind) != at or size + len(data) > RELAY_BYTES):
                    yield from out()
                    number = number + 1 if (shard, kind) == at else 0
                    held, size = [], 0
                at = shard, kind
                held.append((chunk, data))
                size += len(data)
        if held:
            yield from out()

    # stored: the batches of a group depend on the order in which its messages came, and must not be made twice
    return stored(messages.repartition("shard").sortWithinPartitions("shard", "kind").mapInPandas(relay, "shard long, kind int, chunk long, data binary"), name)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(text, UPPER, LOWER)


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the column's text (null: empty) modulo n."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % n


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
