"""Quality by compression: two zstandard dictionaries, from good and from bad labelled texts.

A text is cut into blocks of BLOCK bytes; every block is compressed once beside each
dictionary. The difference of the two sizes over all blocks, normalised by the text's
bytes, says which dictionary the text resembles; the logarithm of the mean ratio of
compression tells prose from repetition, which both dictionaries compress alike. A
logistic curve, fitted on labelled rows that neither dictionary has seen, turns both into
the probability of label 1. PRIOR_BYTES keeps short texts, which show little, near 0.

Learning uses at most SAMPLE_BYTES of texts and SAMPLE_ROWS rows of each label for the
dictionaries, and as much for the curve, picked by a digest of doc_id among labelled rows
that the caller doesn't hold out; texts over SAMPLE_BYTES / 8 are left out of the sample.
The model (two dictionaries of DICTIONARY_BYTES and two numbers) goes to the tasks.

Defined cases: a null or empty text has both features 0; with one label only, or none, every score
is that label's smoothed share (0.5 without labels); null labels and labels of absent
documents teach nothing; of several labels of one document the smallest counts; extra
columns of either table play no part; a repeated row is scored as often as it stands.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import crc_mod, lean, short_batches, stored

BLOCK, DICTIONARY_BYTES, LEVEL = 2048, 65_536, 3
PRIOR_BYTES = 64
SAMPLE_BYTES, SAMPLE_ROWS = 4_000_000, 2_000
THRESHOLD = 0.7
HELD_OUT_OF, HELD_OUT = 4, 2


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slopes: tuple[float, float]
    offset: float


def _blocks(raw: bytes) -> list[bytes]:
    return [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary, or raw content where there is too little to train on."""
    samples = [b for t in texts for b in _blocks(t)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


class Scorer:
    """Scores texts with a model, in one process."""

    def __init__(self, model: Model):
        self.model = model
        self.sides = []
        for raw in (model.good, model.bad):
            known = zstandard.ZstdCompressionDict(raw)
            known.precompute_compress(level=LEVEL)
            self.sides.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_dict_id=False).compress)
        self.frames = [len(side(b"")) for side in self.sides]

    def features(self, text: str | None) -> tuple[float, float]:
        """The normalised difference and the logarithm of the ratio of compression."""
        raw, good, bad = (text or "").encode("utf-8", "replace"), 0, 0
        for b in _blocks(raw):
            good += len(self.sides[0](b)) - self.frames[0]
            bad += len(self.sides[1](b)) - self.frames[1]
        return (bad - good) / (len(raw) + PRIOR_BYTES), math.log((good + bad + PRIOR_BYTES / 2) / (2 * len(raw) + PRIOR_BYTES / 2))

    def score(self, text: str | None) -> float:
        z = self.model.offset + sum(w * x for w, x in zip(self.model.slopes, self.features(text)))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[tuple[float, float], float]:
    """Slopes and offset by Newton steps, with a slight pull to 0."""
    scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
    design, w = np.column_stack([x / scale, np.ones(len(x))]), np.zeros(3)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -60, 60)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(3), design.T @ (y - p) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return (float(w[0] / scale[0]), float(w[1] / scale[1])), float(w[2])


def _sample(docs: DataFrame, labels: DataFrame, usable: Column) -> list[tuple[int, str, int]]:
    """(fold, text, label) of the bounded learning sample; fold 0 is for the curve."""
    label = labels.select("doc_id", "quality").dropna().groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sizes = docs.filter(usable).select("doc_id", F.octet_length("text").alias("size")).dropna()
    fold = F.when(F.crc32(F.concat(F.lit("fold:"), F.col("doc_id").cast("string"))) % 3 == 0, 0).otherwise(1)
    pool = sizes.filter((F.col("size") > 0) & (F.col("size") <= SAMPLE_BYTES // 8)).join(label, "doc_id").groupBy("doc_id", "quality").agg(F.max("size").alias("size"))
    pool = stored(pool.withColumn("fold", fold), "quality-pool")
    picked: dict[int, tuple[int, int]] = {}
    for f in (0, 1):
        for q in (0, 1):
            room = SAMPLE_BYTES
            rows = pool.filter((F.col("fold") == f) & (F.col("quality") == q)).orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id", "size").limit(SAMPLE_ROWS)
            for r in rows.collect():
                if r.doc_id not in picked and r["size"] <= room:
                    picked[r.doc_id], room = (f, q), room - r["size"]
    if not picked:
        return []
    # at most 4 * SAMPLE_ROWS ids; a doc_id that stands in many rows gives its smallest text, found by partial minima
    ids = docs.sparkSession.createDataFrame([(i,) for i in picked], docs.select("doc_id").schema)
    fits = (F.octet_length("text") > 0) & (F.octet_length("text") <= SAMPLE_BYTES // 8)
    texts = docs.filter(fits).select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).collect()
    out = {r.doc_id: r.text for r in texts}
    return [(picked[i][0], out[i], picked[i][1]) for i in sorted(out)]


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None) -> Model:
    """A model from the labelled rows of docs for which usable holds (by default those not held out)."""
    usable = crc_mod("doc_id", HELD_OUT_OF) != HELD_OUT if usable is None else usable
    rows = _sample(docs, labels, usable)
    n = [sum(q == v for _, _, q in rows) for v in (0, 1)]
    if not all(n):
        return Model(b"", b"", (0.0, 0.0), math.log((n[1] + 1) / (n[0] + 1)))
    learn = {q: [t.encode("utf-8", "replace") for f, t, k in rows if k == q and f == 1] or [t.encode("utf-8", "replace") for _, t, k in rows if k == q] for q in (0, 1)}
    model = Model(_dictionary(learn[1]), _dictionary(learn[0]), (1.0, 0.0), 0.0)
    curve = [r for r in rows if r[0] == 0]
    if len({q for _, _, q in curve}) < 2:
        curve = rows
    scorer = Scorer(model)
    slopes, offset = _logistic(np.array([scorer.features(t) for _, t, _ in curve]), np.array([float(q) for _, _, q in curve]))
    return Model(model.good, model.bad, slopes, offset)


def score(text: Column, model: Model) -> Column:
    """The score of a text column; the model, under 150 kB, goes along with the function."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model) if model.good or model.bad else None
        constant = 1 / (1 + math.exp(-model.offset))
        for texts in lean(batches):
            yield pd.Series([scorer.score(t) if scorer else constant for t in texts], dtype="float64")

    return scored(text)


def scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of docs: doc_id, held_out, score, predicted."""
    short_batches(docs.sparkSession)
    model = fit(docs, labels)
    out = docs.select("doc_id", (crc_mod("doc_id", HELD_OUT_OF) == HELD_OUT).alias("held_out"), score(F.col("text"), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score at least threshold, as they are."""
    short_batches(docs.sparkSession)
    model = fit(docs, labels)
    return docs.filter(score(docs["text"], model) >= threshold)
