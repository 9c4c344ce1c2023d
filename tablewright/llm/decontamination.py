"""Benchmark decontamination with an FM-index over each training shard.

A shard is about SHARD_BYTES of documents inside a task. Its words, all of them, become
numbers in the shard's own vocabulary; over these sequences, each closed by an end mark,
stand a suffix array, its Burrows-Wheeler transform in a wavelet matrix, and sampled
suffix positions. All windows of the benchmark are searched backwards at once through
wavelet ranks; what is found is located by steps to the nearest sampled position, and
overlapping occurrences merge into removal spans. Where spans are cut out, the texts that
closed up are searched again, together, until nothing is found.

The benchmark goes to the tasks as arrays (words as 64-bit hashes, windows as ranges of
them), in blocks of at most about BLOCK_BYTES of text, four times that as arrays; a larger
one takes several passes over the documents, so what is sent at once has a bound.

Defined cases: a null text has no words; an item without words has no windows; an item of
fewer than WINDOW words is one window; rows with the same item_id are one item; a null
item_id is written "null"; an empty benchmark hits nothing; extra columns play no part.
"""

from __future__ import annotations

import functools
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import lean, short_batches, stored
from tablewright.llm.tokens import word_hashes

WINDOW = 10
BLOCK_BYTES = 4_000_000
SHARD_BYTES = 2_000_000
SAMPLE_EVERY = 8
#: Bytes outside words become spaces and A-Z become a-z; bytes of other letters stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_WORD = re.compile(rb"[^ ]+")


def fold(text: str | None) -> bytes:
    """The text's bytes with words in lower case and single bytes of space for all else."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)


def suffix_order(sequences: np.ndarray) -> np.ndarray:
    """Order of the suffixes of sequences, each closed by a 0; of equal ones, the earlier stands first.

    As many symbols as 63 bits hold are sorted at once; then only suffixes that are equal
    so far are sorted on, by the ranks of what follows, over twice the length each time.
    """
    n, bits = len(sequences), max(1, int(sequences.max(initial=0)).bit_length())
    size = max(1, min(63 // bits, n))
    key, open_ = np.zeros(n, np.uint64), np.ones(n, bool)
    for k in range(size):
        symbol = np.zeros(n, np.uint64)
        symbol[: n - k] = sequences[k:]
        open_ &= symbol > 0  # beyond an end mark nothing counts
        key = (key << np.uint64(bits)) | np.where(open_, symbol, np.uint64(0))
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], key[order][1:] != key[order][:-1]]) | ~open_[order]
    slots, step = np.arange(n), size
    rank = np.empty(n, np.int64)
    rank[order] = slots[np.maximum.accumulate(np.where(new, slots, 0))]
    while True:
        slots = slots[~(new & np.concatenate([new[1:], [True]]))]
        if not len(slots):
            return order
        at = order[slots]
        group, after = rank[at], rank[at + step]
        again = np.lexsort((after, group))
        at, group, after = at[again], group[again], after[again]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (after[1:] != after[:-1])])
        order[slots] = at
        rank[at] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        step *= 2


class FMIndex:
    """Full-text index of sequences of symbols from 1 up; a pattern never spans two sequences."""

    def __init__(self, sequences: np.ndarray, starts: np.ndarray):
        """sequences: all symbols, with a 0 after each sequence; starts: where each begins."""
        n, order = len(sequences), suffix_order(sequences)
        sampled = np.zeros(n, bool)
        sampled[::SAMPLE_EVERY] = sampled[starts] = True
        self.is_sampled = sampled[order]
        self.sample_at, self.samples = np.cumsum(self.is_sampled, dtype=np.int32) - 1, order[self.is_sampled]
        bwt = sequences[order - 1].astype(np.int32)
        self.depth = max(1, int(sequences.max(initial=0)).bit_length())
        counts = np.bincount(sequences, minlength=(1 << self.depth))
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.ones, self.zeros = [], []
        for level in range(self.depth - 1, -1, -1):
            bit = (bwt & (1 << level)) != 0
            ones = np.zeros(n + 1, np.int32)
            np.cumsum(bit, dtype=np.int32, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(n - int(ones[-1]))
            bwt = np.concatenate([bwt[~bit], bwt[bit]])
        # the last level has the symbols in the order of their bits read backwards
        turned = np.zeros(1, np.int64)
        for _ in range(self.depth):
            turned = np.concatenate([turned * 2, turned * 2 + 1])
        self.leaf = np.empty(1 << self.depth, np.int64)
        self.leaf[turned] = np.cumsum(counts[turned]) - counts[turned]

    def _down(self, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        for k, level in enumerate(range(self.depth - 1, -1, -1)):
            one = self.ones[k][at]
            at = np.where((symbol >> level) & 1, self.zeros[k] + one, at - one)
        return at

    def ranks(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands among the first at symbols of the transform."""
        return self._down(at, symbol) - self.leaf[symbol]

    def back(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix that begins one symbol earlier."""
        at, symbol = row, np.zeros(len(row), np.int64)
        for k in range(self.depth):
            one, bit = self.ones[k][at], self.ones[k][at + 1] - self.ones[k][at]
            symbol, at = symbol * 2 + bit, np.where(bit, self.zeros[k] + one, at - one)
        return self.first[symbol] + at - self.leaf[symbol]

    def search(self, symbols: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of patterns, each so many symbols from its start; a symbol below 1 or unknown occurs nowhere."""
        lo, hi = np.zeros(len(start), np.int64), np.full(len(start), self.first[-1])
        alive, k = np.arange(len(start)), 0
        while True:
            done = length[alive] <= k
            alive = alive[~done]
            if not len(alive):
                return lo, hi
            symbol = symbols[start[alive] + length[alive] - 1 - k]
            known = (symbol > 0) & (symbol < 1 << self.depth)
            lo[alive[~known]] = hi[alive[~known]] = 0
            alive, symbol = alive[known], symbol[known]
            lo[alive], hi[alive] = self.first[symbol] + self.ranks(symbol, lo[alive]), self.first[symbol] + self.ranks(symbol, hi[alive])
            alive, k = alive[hi[alive] > lo[alive]], k + 1

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows."""
        out, steps, row, open_ = np.zeros(len(rows), np.int64), 0, rows.copy(), np.arange(len(rows))
        while len(open_):
            done = self.is_sampled[row]
            out[open_[done]] = self.samples[self.sample_at[row[done]]] + steps
            open_, row, steps = open_[~done], self.back(row[~done]) if not done.all() else row[:0], steps + 1
        return out


class Phrases:
    """The windows of a block of benchmark items: their words in one sequence, and where each window stands in it."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        hashes, first = word_hashes([fold(text) for _, text in items]) if items else (np.zeros(0, np.uint64), np.zeros(1, np.int64))
        size = np.diff(first)
        n = np.where(size > 0, np.maximum(1, size - window + 1), 0)
        self.words, words = np.unique(hashes, return_inverse=True)
        self.sequence = words.astype(np.int32)
        begin = np.concatenate([[0], np.cumsum(n)])
        self.start = (np.repeat(first[:-1] - begin[:-1], n) + np.arange(begin[-1])).astype(np.int32)
        self.length = np.repeat(np.minimum(size, window), n).astype(np.int32)
        self.names = sorted({i for i, _ in items})
        name = {i: k for k, i in enumerate(self.names)}
        self.item = np.repeat(np.array([name[i] for i, _ in items], np.int32), n)

    def find(self, texts: list[bytes]) -> tuple[list[int], list[tuple[np.ndarray, list[str]]]]:
        """Word counts of the folded texts of a shard, and for each its hit words (sorted positions) and items."""
        nothing = (np.zeros(0, np.int64), [])
        found = [nothing] * len(texts)
        if not texts:
            return [], found
        hashes, first = word_hashes(texts)
        counts = np.diff(first).tolist()
        if not len(self.start) or not len(hashes):
            return counts, found
        known, ids = np.unique(hashes, return_inverse=True)
        # each text's words from 1 up, with a 0 after them
        text = np.zeros(len(hashes) + len(texts), np.int64)
        text[np.arange(len(hashes)) + np.repeat(np.arange(len(texts)), counts)] = ids + 1
        starts = first[:-1] + np.arange(len(texts))
        index = FMIndex(text, starts)
        at = np.minimum(np.searchsorted(known, self.words), len(known) - 1)
        symbols = np.where(known[at] == self.words, at + 1, 0)[self.sequence]
        lo, hi = index.search(symbols, self.start, self.length)
        hits = np.flatnonzero(hi > lo)
        if not len(hits):
            return counts, found
        n = (hi - lo)[hits]
        rows = np.repeat(lo[hits] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        where, which = index.locate(rows), np.repeat(hits, n)
        edge = np.zeros(len(text) + 1, np.int64)
        np.add.at(edge, where, 1)
        np.add.at(edge, where + self.length[which], -1)
        hit = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
        doc = np.searchsorted(starts, where, "right") - 1
        pairs = np.unique(doc * len(self.names) + self.item[which])
        by_doc = defaultdict(list)
        for d, i in zip((pairs // len(self.names)).tolist(), (pairs % len(self.names)).tolist()):
            by_doc[d].append(self.names[i])
        cut = np.searchsorted(hit, np.append(starts, len(text)))
        for d, items in by_doc.items():
            found[d] = (hit[cut[d] : cut[d + 1]] - starts[d], items)
        return counts, found


def n_blocks(benchmark: DataFrame) -> int:
    """Blocks of the benchmark of about BLOCK_BYTES."""
    return max(1, math.ceil((benchmark.agg(F.sum(F.octet_length("text") + 32)).first()[0] or 0) / BLOCK_BYTES))


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[str, str | None]]]:
    """The benchmark's rows, one bounded block at a time."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text")
    n = n_blocks(benchmark)
    for k in range(n):
        yield [(r.item, r.text) for r in items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).collect()]


def _shards(batches: Iterator[pd.Series]) -> Iterator[list[str | None]]:
    """Texts of about SHARD_BYTES at a time; an empty list for an empty batch."""
    held, size = [], 0
    for texts in lean(batches):
        for t in texts:
            n = len(t) if t else 0
            if held and size + n > SHARD_BYTES:
                yield held
                held, size = [], 0
            held.append(t)
            size += n
    yield held


def hits(text: Column, phrases: Phrases) -> Column:
    """struct(n_words, hit: positions of hit words, items) of a text column."""

    @F.pandas_udf("n_words long, hit array<int>, items array<string>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in _shards(batches):
            counts, spans = phrases.find([fold(t) for t in texts])
            yield pd.DataFrame({"n_words": np.array(counts, dtype=np.int64), "hit": pd.Series([s[0].astype(np.int32) for s in spans], dtype=object), "items": pd.Series([s[1] for s in spans], dtype=object)})

    return found(text)


def _live(removed: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """The ranges of n bytes between removed ones, which are in order."""
    out, at = [], 0
    for a, b in removed:
        if a > at:
            out.append((at, a))
        at = max(at, b)
    return [*out, (at, n)] if at < n else out


def cut(texts: list[str | None], phrases: Phrases) -> list[tuple[str | None, list[tuple[int, int]]]]:
    """A shard's texts without the spans of their hit words, and those spans in bytes of each text; texts that close up are searched again."""
    raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    removed: list[list[tuple[int, int]]] = [[] for _ in texts]
    open_ = list(range(len(texts)))
    while open_:
        live = {i: _live(removed[i], len(raws[i])) for i in open_}
        _, found = phrases.find([b" ".join(raws[i][a:b].translate(_FOLD) for a, b in live[i]) for i in open_])
        hit = [(i, f[0]) for i, f in zip(open_, found) if len(f[0])]
        for i, places in hit:
            words = [(m.start() + a, m.end() + a, k) for k, (a, b) in enumerate(live[i]) for m in _WORD.finditer(raws[i][a:b].translate(_FOLD))]
            spans, last = [], None
            for k in places.tolist():
                a, b, piece = words[k]
                if last is not None and last == (k - 1, piece):
                    spans[-1] = (spans[-1][0], b)
                else:
                    spans.append((a, b))
                last = k, piece
            removed[i] = sorted(removed[i] + spans)
        open_ = [i for i, _ in hit]
    whole = [b" ".join(filter(None, (raw[a:b].strip(b" ") for a, b in _live(gone, len(raw))))) if gone else raw for raw, gone in zip(raws, removed)]
    return [(None if t is None else w.decode("utf-8", "surrogatepass"), gone) for t, w, gone in zip(texts, whole, removed)]


def cleaned(text: Column, phrases: Phrases) -> Column:
    """struct(hit, text, gone) of a text column: where spans were found, the text without them; gone if those held all its words."""

    @F.pandas_udf("hit boolean, text string, gone boolean")
    def done(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in _shards(batches):
            new = cut(texts, phrases)
            hit = np.array([len(spans) > 0 for _, spans in new], bool)
            left = pd.Series([t if h else None for (t, _), h in zip(new, hit)], dtype=object)  # untouched texts don't travel back
            yield pd.DataFrame({"hit": hit, "text": left, "gone": np.array([t is not None and not fold(t).split() for t in left], bool)})

    return done.asNondeterministic()(text)  # else a filter on gone would move below the column and cut every text twice


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs with the removal spans cut out of text; rows left without a word by that go. Other columns stay.

    With several blocks, what a later one cuts may close up to a window of an earlier one:
    all blocks are passed until one whole round finds nothing.
    """
    short_batches(docs.sparkSession)
    columns, many = docs.columns, n_blocks(benchmark) > 1

    def passed(rows: DataFrame, phrases: Phrases) -> DataFrame:
        out = rows.withColumn("__dc_new", cleaned(rows["text"], phrases)).filter(~F.col("__dc_new.gone"))
        text = F.when(F.col("__dc_new.hit"), F.col("__dc_new.text")).otherwise(F.col("text")).alias("text")
        mark = [(F.col("__dc_hit") | F.col("__dc_new.hit")).alias("__dc_hit")] if many else []
        return out.select(*[text if c == "text" else F.col(f"`{c}`") for c in columns], *mark)

    if not many:
        return passed(docs, Phrases(next(iter(blocks(benchmark)))))
    out = docs
    while True:
        out = out.select(*[F.col(f"`{c}`") for c in columns], F.lit(False).alias("__dc_hit"))
        for items in blocks(benchmark):
            out = stored(passed(out, Phrases(items)), "decontaminated")
        if not out.filter("__dc_hit").take(1):
            return out.drop("__dc_hit")


def removal_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, start, stop) of each span to remove, in bytes of the text; several blocks of a benchmark may give spans that overlap."""
    short_batches(docs.sparkSession)

    def of(phrases: Phrases) -> Column:
        @F.pandas_udf("array<struct<start: int, stop: int>>")
        def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in _shards(batches):
                yield pd.Series([[{"start": a, "stop": b} for a, b in spans] for _, spans in cut(texts, phrases)], dtype=object)

        return spans(docs["text"])

    parts = [docs.select("doc_id", F.explode(of(Phrases(items))).alias("s")).select("doc_id", "s.start", "s.stop") for items in blocks(benchmark)]
    return functools.reduce(DataFrame.unionByName, parts)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    short_batches(docs.sparkSession)
    out = None
    for items in blocks(benchmark):
        phrases = Phrases(items)
        if out is None:
            out = docs.select("doc_id", "text", hits(F.col("text"), phrases).alias("f")).select("doc_id", "text", "f.*")
            continue
        # a benchmark of several blocks: each pass joins its hits to those found so far
        out = stored(out, "contamination").withColumn("f", hits(F.col("text"), phrases))
        out = out.select("doc_id", "text", "n_words", F.array_distinct(F.concat("hit", "f.hit")).alias("hit"), F.array_distinct(F.concat("items", "f.items")).alias("items"))
    return out.select(
        "doc_id", "n_words", F.size("hit").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")).cast("binary"), 256).alias("items_sha256"), (F.size("hit") > 0).alias("contaminated"),
    )
