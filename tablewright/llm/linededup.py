"""Reversible line dedup: sharded cuckoo filters in front of exact reference-count tables.

A LineIndex holds three tables in the shared folder: counts, exact reference counts (key,
how many postings it has, the smallest and largest of their documents) as one row for each
increment that brought the key; postings, a row (shard, key, doc_id) for each distinct line key of each
document, from which a deletion works; and filters, a cuckoo filter of 16-bit marks for
each shard's keys.

Documents go in by increments, INCREMENTS of them an insertion. Each shard takes them in
turn: its filter tells which of an increment's keys something earlier may hold, and the
others' marks are added. Only the keys that a filter may hold, and those that an increment
itself holds more than once, meet the count table, which alone decides; all other keys are
held once and never looked up. Deleting documents corrects the counts of their keys from
the postings that stay, and takes the marks of keys that nobody holds any longer out of
the filters, so that an insertion and its deletion leave the index as it was.

A key held by two documents or more loses its lines everywhere but in the smallest doc_id
that holds it. Keys are 128-bit digests of the stripped, lower-cased line, of at least
MIN_CHARS code points.

Defined cases: null or empty text is one empty line; rows that repeat a doc_id are one
document and lose the same lines; a null doc_id counts as larger than all others; an
empty table gives an empty result; extra columns play no part.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import LOWER, UPPER, mix64, short_batches, stored

MIN_CHARS = 10
#: Text bytes that a shard of the filters is meant for.
SHARD_BYTES = 32_000_000
#: Increments in which a shard takes in the documents of one insertion.
INCREMENTS = 8
#: Parts into which a key's rows are dealt where they meet its counts: a line may stand in most documents.
SALTS = 32
_FOLD = str.maketrans(UPPER, LOWER)
_SPACE = " \t\n\x0b\x0c\r"
_LAST = (1 << 63) - 1
SLOTS = 4


class CuckooFilter:
    """Approximate multiset of 64-bit hashes: no false negatives, deletions, growth by chained tables."""

    def __init__(self, capacity: int = 1024):
        self.tables = [self._table(capacity)]

    @staticmethod
    def _table(capacity: int) -> np.ndarray:
        return np.zeros((1 << max(4, math.ceil(math.log2(max(1, capacity) / SLOTS / 0.85))), SLOTS), np.uint16)

    @staticmethod
    def _mark(h: np.ndarray) -> np.ndarray:
        mark = (h >> np.uint64(48)).astype(np.uint16)
        return np.where(mark == 0, np.uint16(1), mark)

    @staticmethod
    def _other(bucket: np.ndarray, mark: np.ndarray, table: np.ndarray) -> np.ndarray:
        return bucket ^ (mix64(mark.astype(np.uint64)) & np.uint64(len(table) - 1)).astype(np.int64)

    def contains(self, h: np.ndarray) -> np.ndarray:
        mark, out = self._mark(h), np.zeros(len(h), bool)
        for t in self.tables:
            one = (h & np.uint64(len(t) - 1)).astype(np.int64)
            out |= (t[one] == mark[:, None]).any(axis=1) | (t[self._other(one, mark, t)] == mark[:, None]).any(axis=1)
        return out

    def insert(self, h: np.ndarray) -> None:
        """Add distinct hashes; what the last table has no room for goes to a new, larger one."""
        while len(h):
            t = self.tables[-1]
            room = int((t == 0).sum() - 0.1 * t.size)
            part, h = h[: max(0, room)], h[max(0, room) :]
            rest = self._place(t, part)
            if len(rest[0]) or len(h):
                self.tables.append(self._table(max(2 * t.size, len(h) + len(rest[0]))))
            if len(rest[0]):
                h = np.concatenate([h, rest[2]])

    def _place(self, t: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place hashes by rounds: a bucket's free slots are dealt out, then one comer a bucket evicts."""
        mark, at = self._mark(h), (h & np.uint64(len(t) - 1)).astype(np.int64)
        undo = t.copy()
        for turn in range(400):
            if not len(at):
                return at, mark, h[:0]
            order = np.argsort(at, kind="stable")
            at, mark = at[order], mark[order]
            first = np.concatenate([[True], at[1:] != at[:-1]])
            nth = np.arange(len(at)) - np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
            free = t[at] == 0
            fits = nth < free.sum(axis=1)
            slot = np.argmax(np.cumsum(free, axis=1) == (nth + 1)[:, None], axis=1)
            t[at[fits], slot[fits]] = mark[fits]
            at, mark, nth = at[~fits], mark[~fits], nth[~fits]
            if turn % 2 == 0:
                at = self._other(at, mark, t)
                continue
            lead = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.zeros(0, np.int64)
            slot = (mix64(at[lead].astype(np.uint64) + np.uint64(turn)) % np.uint64(SLOTS)).astype(np.int64)
            victim = t[at[lead], slot].copy()
            t[at[lead], slot] = mark[lead]
            mark[lead] = victim
            at = self._other(at, mark, t)
        t[:] = undo  # too full: all of them go to the next table
        return at, mark, h

    def delete(self, h: np.ndarray) -> None:
        """Take out one mark for each of the distinct hashes, which must have been inserted."""
        for x, mark in zip(h, self._mark(h)):
            for t in reversed(self.tables):
                one = int(x & np.uint64(len(t) - 1))
                for b in (one, int(self._other(np.array([one]), np.array([mark]), t)[0])):
                    slot = np.flatnonzero(t[b] == mark)
                    if len(slot):
                        t[b, slot[0]] = 0
                        break
                else:
                    continue
                break

    def dump(self) -> bytes:
        return b"".join(np.int64(len(t)).tobytes() + t.tobytes() for t in self.tables)

    @classmethod
    def load(cls, raw: bytes) -> CuckooFilter:
        out, at = cls.__new__(cls), 0
        out.tables = []
        while at < len(raw):
            n = int(np.frombuffer(raw, np.int64, 1, at)[0])
            out.tables.append(np.frombuffer(raw, np.uint16, n * SLOTS, at + 8).reshape(n, SLOTS).copy())
            at += 8 + 2 * n * SLOTS
        return out


def line_key(line: str) -> bytes | None:
    """Digest of the line's key; None for keys that are too short to count."""
    key = line.strip(_SPACE).translate(_FOLD)
    return hashlib.blake2b(key.encode("utf-8", "surrogatepass"), digest_size=16).digest() if len(key) >= MIN_CHARS else None


def _hashes(keys: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(keys), np.uint64)[::2] if len(keys) else np.zeros(0, np.uint64)


_POSTING = "shard int, key binary, doc_id long"
_COUNT = "shard int, key binary, n long, least long, last long"


def _sums() -> list[Column]:
    return [F.count("*").alias("n"), F.min("doc_id").alias("least"), F.max("doc_id").alias("last")]


@dataclass(frozen=True)
class LineIndex:
    """Postings (shard, key, doc_id), counts (shard, key, n, least, last) by increment, filters (shard, filter), and the number of shards."""

    postings: DataFrame
    counted: DataFrame
    filters: DataFrame
    n_shards: int

    @classmethod
    def empty(cls, spark, n_shards: int) -> LineIndex:
        return cls(*(spark.createDataFrame([], schema) for schema in (_POSTING, _COUNT, "shard int, filter binary")), n_shards)

    def _postings(self, docs: DataFrame) -> DataFrame:
        n = self.n_shards

        def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                ids, keys = [], []
                for doc, text in zip(b.doc_id, b.text):
                    own = {line_key(x) for x in (text or "").split("\n")} - {None}
                    ids += [doc] * len(own)
                    keys += own
                k = pd.Series(keys, dtype=object)
                yield pd.DataFrame({"shard": (_hashes(k) % np.uint64(n)).astype(np.int32), "key": k, "doc_id": np.array(ids, dtype=np.int64)})

        return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc_id"), "text").mapInPandas(rows, _POSTING)

    def _touched(self, keys: DataFrame, do: str) -> DataFrame:
        """Filters (kind 0) after "add", "force" or "delete" of keys (shard, key, increment, n).

        "add" takes a shard's increments in turn and returns the keys that more than one
        posting may have: an increment holds them twice, or the filter may hold them from
        before. Kind 2 are those that it seemed to hold before their first increment, so
        that their marks weren't added; kind 1 the others.
        """

        def touch(_, new: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
            f = CuckooFilter.load(old["filter"].iloc[0]) if len(old) else CuckooFilter(len(new))
            h, kind = _hashes(new.key), np.full(len(new), -1)
            if do == "add":
                step, n, first = new.increment.to_numpy(), new.n.to_numpy(), np.zeros(len(new), bool)
                order = np.lexsort((step, h))
                first[order[np.concatenate([[True], h[order][1:] != h[order][:-1]])] if len(new) else order] = True
                for k in np.unique(step):
                    own = np.flatnonzero(step == k)
                    held = f.contains(h[own])
                    f.insert(h[own[~held]])
                    kind[own] = np.where(held & first[own], 2, np.where(held | (n[own] > 1), 1, -1))
            elif do == "force":
                f.insert(np.unique(h))
            else:
                f.delete(h)
            shard = int((new if len(new) else old).shard.iloc[0])
            named = pd.DataFrame({"kind": kind, "shard": shard, "value": new.key})[kind > 0]
            return pd.concat([pd.DataFrame({"kind": [0], "shard": [shard], "value": [f.dump()]}), named])

        out = keys.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInPandas(touch, "kind int, shard int, value binary")
        return stored(out, "line-filters")

    @staticmethod
    def _filters(touched: DataFrame) -> DataFrame:
        return touched.filter("kind = 0").select((F.col("shard") + 0).alias("shard"), F.col("value").alias("filter"))

    def insert(self, docs: DataFrame) -> tuple[LineIndex, DataFrame]:
        """The index with docs in it, and the keys (shard, key) that more than one document may hold, as the filters tell.

        A key that an old filter only seems to hold gets its mark after the count table
        has told so; else deleting the key it was taken for would hide it.
        """
        new = stored(self._postings(docs), "line-postings")
        step = F.pmod(F.xxhash64("doc_id"), F.lit(INCREMENTS)).cast("int").alias("increment")
        summed = stored(new.groupBy("shard", "key", step).agg(*_sums()), "line-counts")
        touched = self._touched(summed, "add")
        maybe = touched.filter("kind > 0").select("shard", F.col("value").alias("key")).distinct()
        grown = LineIndex(self.postings.unionByName(new), self.counted.unionByName(summed.drop("increment")), self._filters(touched), self.n_shards)
        seeming = touched.filter("kind = 2").select("shard", F.col("value").alias("key")).join(self.counted.select("key"), "key", "left_anti")
        return grown._with(seeming.select("shard", "key"), "force"), maybe

    def _with(self, keys: DataFrame, do: str) -> LineIndex:
        """The index with keys (shard, key) added to its filters or deleted from them."""
        one = keys.withColumn("increment", F.lit(0)).withColumn("n", F.lit(1).cast("long"))
        return LineIndex(self.postings, self.counted, self._filters(self._touched(one, do)), self.n_shards)

    def delete(self, ids: DataFrame) -> LineIndex:
        """The index without the documents of ids (doc_id)."""
        gone = ids.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc_id")).distinct()
        kept = stored(self.postings.join(gone, "doc_id", "left_anti").select("shard", "key", "doc_id"), "line-postings")
        touched = stored(self.postings.join(gone, "doc_id", "left_semi").select("shard", "key").distinct(), "line-gone")
        again = kept.join(touched.select("key"), "key", "left_semi").groupBy("shard", "key").agg(*_sums())
        again = stored(again, "line-counts")
        counted = self.counted.join(touched.select("key"), "key", "left_anti").unionByName(again)
        free = touched.join(again.select("key"), "key", "left_anti").select("shard", "key")
        return LineIndex(kept, counted, self.filters, self.n_shards)._with(free, "delete")

    def counts(self, maybe: DataFrame | None = None) -> DataFrame:
        """Exact (key, n, keeper) of the keys that two documents or more hold; only of the keys in maybe, if given."""
        rows = self.counted if maybe is None else self.counted.join(maybe.select("key"), "key", "left_semi")
        return rows.groupBy("key").agg(F.sum("n").alias("n"), F.min("least").alias("keeper"), F.max("last").alias("last")).filter("keeper < last").drop("last")

    def drops(self, maybe: DataFrame | None = None) -> DataFrame:
        """(doc_id, keys): the keys that each document loses."""
        rows = self.postings.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
        counts = self.counts(maybe).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        return rows.join(counts, ["key", "salt"]).filter("doc_id > keeper").groupBy("doc_id").agg(F.collect_set("key").alias("keys"))


def shards_for(docs: DataFrame) -> int:
    return max(1, math.ceil((docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / SHARD_BYTES))


def _kept(text: Column, keys: Column, digest: bool) -> Column:
    """struct(n_lines, n_dropped, kept): kept is the remaining text, or its SHA-256."""

    @F.pandas_udf("n_lines long, n_dropped long, kept string")
    def done(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, drops in batches:
            rows = []
            for text, drop in zip(texts, drops):
                lines = (text or "").split("\n")
                gone = set(drop) if drop is not None else ()
                left = [x for x in lines if line_key(x) not in gone] if gone else lines
                out = "\n".join(left)
                rows.append((len(lines), len(lines) - len(left), hashlib.sha256(out.encode("utf-8", "surrogatepass")).hexdigest() if digest else out))
            yield pd.DataFrame(rows, columns=["n_lines", "n_dropped", "kept"])

    return done(text, keys)


def _with_drops(docs: DataFrame) -> DataFrame:
    short_batches(docs.sparkSession)
    index, maybe = LineIndex.empty(docs.sparkSession, shards_for(docs)).insert(docs)
    drops = index.drops(maybe).select(F.col("doc_id").alias("__ld_id"), F.col("keys").alias("__ld_keys"))
    return docs.join(drops, F.coalesce(docs["doc_id"].cast("long"), F.lit(_LAST)) == F.col("__ld_id"), "left")


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs with the repeated lines gone from text; its columns are kept as they are."""
    out = _with_drops(docs).withColumn("__ld", _kept(docs["text"], F.col("__ld_keys"), False))
    return out.select(*[F.when(docs["text"].isNotNull(), F.col("__ld.kept")).alias(c) if c == "text" else docs[c] for c in docs.columns])


def dropped_lines(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_lines, n_dropped, kept_sha256."""
    narrow = docs.select("doc_id", "text")
    out = _with_drops(narrow).select("doc_id", _kept(narrow["text"], F.col("__ld_keys"), True).alias("k"))
    return out.select("doc_id", "k.n_lines", "k.n_dropped", F.col("k.kept").alias("kept_sha256"))
