"""A uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Rows lie in P partitions by a seeded hash. The driver knows each partition's count and
each shard's size (equal, or one more in the first shards) and draws how many rows go
from each partition to each shard, as drawing without replacement would: row after row
of the matrix, multivariate hypergeometric. Each partition permutes its rows by a second
hash and deals them out by those counts; after the exchange the rows of a shard are
permuted again by a third hash, which numbers them from 0.

The matrix has at most MAX_PARTITIONS rows. The second permutation works on blocks of a
shard, cut by the leading bits of the hash, whose counts give each block's first number:
no task holds a whole shard. Orders end at a hash of all columns, so that a task run
again deals the same; rows equal in all columns can't be told apart.

Defined cases: a null text has size 1 and crc32 0; a null doc_id is a value as others; an empty table
gives an empty result; repeated rows are dealt out one by one. Equal texts aren't held
together: that belongs to laws that weigh groups.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHARDS = 8
SEED = 20_240_601
#: Rows that a partition or a block of a shard is meant to hold, and the most partitions.
BLOCK_ROWS, MAX_PARTITIONS = 5_000, 1 << 16


def communication_matrix(counts: list[int], n_shards: int, seed: int = SEED) -> np.ndarray:
    """How many rows go from each partition to each shard: row sums are counts, column sums differ by one at most."""
    n = sum(counts)
    room = np.array([n // n_shards + (i < n % n_shards) for i in range(n_shards)], dtype=np.int64)
    draw, out = np.random.Generator(np.random.PCG64(seed)), np.zeros((len(counts), n_shards), dtype=np.int64)
    for p, c in enumerate(counts):
        out[p] = _draw(draw, room, c)
        room -= out[p]
    return out


def _draw(draw: np.random.Generator, room: np.ndarray, c: int) -> np.ndarray:
    """One multivariate hypergeometric draw, a shard at a time."""
    out, rest = np.zeros_like(room), int(room.sum())
    for i, r in enumerate(room):
        rest -= int(r)
        if c and r:
            out[i] = hypergeometric(draw, int(r), rest, c) if rest else c
            c -= int(out[i])
    return out


def hypergeometric(draw: np.random.Generator, good: int, bad: int, c: int) -> int:
    """How many of c rows drawn from good + bad are good: numpy's draw, which takes less than 10**9 rows, or the same law by inversion."""
    return int(draw.hypergeometric(good, bad, c)) if good + bad < 10**9 else inverted(draw.random(), good, bad, c)


def inverted(u: float, good: int, bad: int, c: int) -> int:
    """The hypergeometric quantile of u.

    Probabilities relative to the mode's follow from one another by ratios of integers,
    to which a double's rounding adds about 1e-16 a step; 12 standard deviations on
    either side of the mode leave out less than any double can tell.
    """
    least, most, n = max(0, c - bad), min(good, c), good + bad
    mode = min(max((good + 1) * (c + 1) // (n + 2), least), most)
    reach = int(12 * math.sqrt(c * (good / n) * (bad / n) * max(n - c, 1) / max(n - 1, 1))) + 40
    up = np.arange(mode, min(most, mode + reach), dtype=np.float64)
    down = np.arange(mode, max(least, mode - reach), -1, dtype=np.float64)
    above = np.cumprod((good - up) / (up + 1) * ((c - up) / (bad - c + up + 1)))
    below = np.cumprod(down / (good - down + 1) * ((bad - c + down) / (c - down + 1)))
    weight = np.concatenate([below[::-1], [1.0], above])
    total = np.cumsum(weight)
    return mode - len(below) + min(int(np.searchsorted(total, u * total[-1], "right")), len(weight) - 1)


def _whole_row(docs: DataFrame, seed: int) -> Column:
    """A hash of seed and every column that can be hashed."""
    return F.xxhash64(F.lit(seed), *[docs[f.name] for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()])


def sharded(docs: DataFrame, n_shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """docs with shard int (0 to n_shards - 1) and slot long (0, 1, ... within the shard); a column of docs with such a name is replaced."""
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    row = _whole_row(docs, seed)
    n = docs.count()
    n_parts = max(1, min(MAX_PARTITIONS, math.ceil(n / BLOCK_ROWS)))
    keyed = docs.select(*[docs[c] for c in kept], row.alias("__sh_row")).withColumn("__sh_part", F.pmod(F.xxhash64(F.lit(1), "__sh_row"), F.lit(n_parts)).cast("int"))
    counts = dict(keyed.groupBy("__sh_part").count().collect())
    matrix = communication_matrix([counts.get(p, 0) for p in range(n_parts)], n_shards, seed).cumsum(axis=1)
    ends = spark.createDataFrame([(p, ends) for p, ends in enumerate(matrix.tolist())], T.StructType([T.StructField("__sh_part", T.IntegerType()), T.StructField("__sh_ends", T.ArrayType(T.LongType()))]))
    local = W.partitionBy("__sh_part").orderBy(F.xxhash64(F.lit(2), "__sh_row"), "__sh_row")
    rank = F.row_number().over(local) - 1
    dealt = keyed.withColumn("__sh_rank", rank).join(ends, "__sh_part").withColumn("shard", F.size(F.filter("__sh_ends", lambda end: end <= F.col("__sh_rank"))))
    bits = max(1, math.ceil(math.log2(max(2, n / n_shards / BLOCK_ROWS))))
    dealt = dealt.withColumn("__sh_key", F.xxhash64(F.lit(3), "__sh_row")).withColumn("__sh_block", F.shiftrightunsigned("__sh_key", 64 - bits))
    blocks = dealt.groupBy("shard", "__sh_block").agg(F.count("*").alias("__sh_n"))
    first = blocks.withColumn("__sh_first", F.coalesce(F.sum("__sh_n").over(W.partitionBy("shard").orderBy("__sh_block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("__sh_n")
    again = W.partitionBy("shard", "__sh_block").orderBy("__sh_key", "__sh_row")
    numbered = dealt.withColumn("__sh_at", F.row_number().over(again) - 1).join(first, ["shard", "__sh_block"])
    return numbered.select(*kept, F.col("shard").cast("int").alias("shard"), (F.col("__sh_first") + F.col("__sh_at")).cast("long").alias("slot"))


def assignments(docs: DataFrame, n_shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Per row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law)."""
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return sharded(narrow, n_shards, seed).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
