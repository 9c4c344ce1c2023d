"""Mixing sources to target weights by capped water-filling, in DataFrame operations only.

Each source gets a target amount of words: its weight's share of the whole, but at most
``max_epochs`` times what it holds; what the clamped sources leave over is shared again
by weight. A source's rows are then taken ``floor(target / size)`` times whole, and a
seeded choice of them once more, so that the sum comes within half a document of the target.

The choice orders a source's rows by a digest of doc_id and takes those below a threshold.
The threshold is found digit by digit from sums by (source, prefix): no step orders or
gathers a source's rows, so one source may hold most of them.

Defined cases: null text or one without words has size 0 and is taken 0 words; a null
source is a source of its own, ordered last; an empty table gives an empty result; rows
that repeat a doc_id share one decision; all sizes 0 gives targets of 0 and each row once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SEED = "mix-1"
#: Hexadecimal digits fixed in each round of the search for a threshold, and rounds.
DIGITS, ROUNDS = 3, 4
#: Parts into which a source's rows are dealt where they meet its plan, so that one source may hold most rows.
SALTS = 64


def words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(doc_id: Column, seed: str = SEED) -> Column:
    """Seeded digest of an id, of which DIGITS * ROUNDS hexadecimal digits count."""
    return F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))), 1, DIGITS * ROUNDS)


def water_fill(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """sources (src, src_null, source_size), one row a source, with ``target`` added.

    Sorted by cap over weight, the clamped sources are a prefix: the k-th is clamped if
    the level that the rest would reach without it is at least its own ratio.
    """
    by_name, by_ratio = W.orderBy("src_null", "src"), W.orderBy("ratio", "src_null", "src")
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ranked = (
        sources.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("level", (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    )
    level = F.min(F.when(F.col("level") < F.col("ratio"), F.struct("ratio", "src_null", "src", "level"))).over(whole)["level"]
    return ranked.withColumn("target", F.coalesce(F.least(F.col("cap"), level * F.col("weight")), F.col("cap"))).select("src", "src_null", "source_size", "target")


def plan(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """For each source of sized (src, src_null, size, key): source_size, target, whole repetitions, and the key below which rows are taken once more."""
    sums = sized.groupBy("src", "src_null", F.substring("key", 1, DIGITS).alias("prefix")).agg(F.sum("size").alias("amount"))
    sources = water_fill(sums.groupBy("src", "src_null").agg(F.sum("amount").alias("source_size")), weights, max_epochs)
    state = sources.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(1)).cast("long"))
    state = state.withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
    keep = ["src", "src_null", "source_size", "target", "whole", "left"]
    below = W.partitionBy("src", "src_null").orderBy("prefix").rowsBetween(W.unboundedPreceding, -1)
    for k in range(1, ROUNDS + 1):
        if k == 1:
            level = sums.join(state, ["src", "src_null"])
        else:
            at = sized.withColumn("at", F.substring("key", 1, DIGITS * (k - 1)))
            level = at.join(state.withColumnRenamed("prefix", "at"), ["src", "src_null", "at"]).groupBy(*keep, F.substring("key", 1, DIGITS * k).alias("prefix")).agg(F.sum("size").alias("amount"))
        level = level.withColumn("lower", F.coalesce(F.sum("amount").over(below), F.lit(0)))
        hit = (F.col("lower") <= F.col("left")) & (F.col("left") < F.col("lower") + F.col("amount"))
        state = level.filter(hit).withColumn("left", F.col("left") - F.col("lower")).select(*keep, "prefix", "amount")
    #: The last group of keys goes along if that comes nearer to the target.
    return state.select("src", "src_null", F.when(2 * F.col("left") >= F.col("amount"), F.concat("prefix", F.lit("~"))).otherwise(F.col("prefix")).alias("threshold")).join(
        sources.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(1)).cast("long")), ["src", "src_null"], "right"
    )


def measured(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The narrow table (doc_id, src, src_null, size, key) of docs."""
    return docs.select("doc_id", F.coalesce("source", F.lit("")).alias("src"), F.col("source").isNull().alias("src_null"), words(F.col("text")).alias("size"), order_key(F.col("doc_id"), seed).alias("key"))


def copies(whole: Column, key: Column, threshold: Column, max_epochs: int = MAX_EPOCHS) -> Column:
    """Repetitions of a row beside its source's whole repetitions and threshold: never more than max_epochs, whatever its size."""
    return whole + F.when((whole < max_epochs) & (key < threshold), 1).otherwise(0)


def _salt(key: Column) -> Column:
    return F.conv(F.substring(key, 1, 4), 16, 10).cast("int") % SALTS


def _salted(plans: DataFrame, name: str) -> DataFrame:
    """Each source's plan once a salt."""
    return plans.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def taken(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """Per row of docs: doc_id, size, source_size, target, taken (words, repeats counted) and copies."""
    sized = stored(measured(docs, seed), "mix-sizes")
    plans = stored(plan(sized, weights, max_epochs), "mix-plan")
    joined = sized.withColumn("salt", _salt(F.col("key"))).join(_salted(plans, "salt"), ["src", "src_null", "salt"], "left")
    n = copies(F.col("whole"), F.col("key"), F.col("threshold"), max_epochs)
    return joined.select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target", (F.col("size") * n).alias("taken"), n.alias("copies"))


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """docs with each row repeated as often as the mix takes it; its columns are kept as they are."""
    sized = stored(measured(docs, seed), "mix-sizes")
    # stored, its size is known before the join is planned: a small plan is broadcast and no text is shuffled
    plans = stored(plan(sized, weights, max_epochs), "mix-plan").select(F.col("src").alias("__mix_src"), F.col("src_null").alias("__mix_null"), F.col("whole").alias("__mix_whole"), F.col("threshold").alias("__mix_threshold"))
    plans = _salted(plans, "__mix_salt")
    on = (_salt(order_key(docs["doc_id"], seed)) == F.col("__mix_salt")) & (F.coalesce(docs["source"], F.lit("")) == F.col("__mix_src")) & (docs["source"].isNull() == F.col("__mix_null"))
    n = copies(F.col("__mix_whole"), order_key(docs["doc_id"], seed), F.col("__mix_threshold"), max_epochs)
    times = F.explode(F.sequence(F.lit(1), n.cast("int"))).alias("__mix_copy")
    return docs.join(plans, on).filter(n > 0).select(*[docs[c] for c in docs.columns], times).drop("__mix_copy")
