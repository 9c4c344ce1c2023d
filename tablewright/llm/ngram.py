"""N-gram scoring with sharded tries in Elias-Fano levels.

Model. Words and one end mark a text are tokens; a trigram model is smoothed by
interpolated absolute discounting,

    P3(w | u v) = max(c(u v w) - D, 0) / c(u v) + D n(u v) / c(u v) * P2(w | v)
    P2(w | v)   = max(c(v w) - D, 0) / c(v) + D n(v) / c(v) * P1(w)

where n counts different successors. P1 adds one to the count of each word and to that of
an unknown one, at every size: P1(w) = (c(w) + 1) / (N + V + 1). A v so frequent that its
tokens would fill more than a part of a shard is split: its contexts v' are v with one of
some classes of the word before it, and each v' goes to a shard of its own (v' is v for all
others). The counts in P2 stay those of the whole v: c(v w) is summed over all classes and
sent to the classes that meet (v, w).

Three passes over the texts. The first counts words; only the counts of the head of the
vocabulary, its at most HEAD most frequent words, are known to all tasks. The second tells
each shard of the vocabulary which shards of contexts hold its rare words, and each shard
of pairs which of them hold (v, w) of a split v and how often; the counts are sent there.
The third packs each chunk of texts, for every shard of contexts that it meets, into one
compressed message of (u, v, w); a text's first word, if rare, goes to a shard by itself.
Beyond common.DIRECT shards, messages go to groups of shards and are dealt out again
there, and answers return the same way, so that their number grows with the tokens.

A shard's task puts the training tokens into a trie - contexts v', below them words w
(bigrams) and words u (contexts), below those words w (trigrams). A level's entries are
one Elias-Fano sequence, in which the words of a parent's children stand above the last
one of the parent before; a second Elias-Fano sequence points to where each parent's
children begin; 16-bit codes hold logarithms. Levels are written to a file of the task's
own and read through a memory map. A query takes the two pointers of its context, and from
them the offset that makes its word comparable, and looks for that number's successor
between them. The answer is three numbers a text, summed over shards; no task needs
another's trie and no model is sent around. Only the head of the vocabulary goes to the
tasks; its size has a bound. What is shuffled grows with the tokens.

Words are 64-bit hashes where they are counted and predicted; as contexts, rare words are
numbers of 32 bits (two with one number are one context).

Defined cases: null and empty texts are one end mark; an empty training set gives every
token the unknown word's probability; rows that are equal in doc_id and text have equal scores;
extra columns play no part.
"""

from __future__ import annotations

import hashlib
import math
import os
import struct
import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import crc_mod, dealt, groups_for, mix64, relayed, short_batches, stored
from tablewright.llm.tokens import word_hashes

HELD_OUT_OF, HELD_OUT = 7, 2
DISCOUNT = 0.75
#: Most words in the head of the vocabulary; tokens a shard is meant for; share of a shard that one context may fill.
HEAD, SHARD_TOKENS, PART = 1 << 17, 1_000_000, 4
#: Bytes of text in one chunk of the later passes, and distinct words counted before they are handed on in the first.
CHUNK_BYTES, FLUSH_WORDS = 4_000_000, 1_000_000
#: Logarithms are stored as multiples of this.
STEP = 14 / 65535
END = np.uint64(0x656E64)
#: The number that stands for no word, before a text's first.
_NO_WORD = (1 << 32) - 1
#: Bits of a context's number that hold its class.
_CLASS_BITS = 31


# --- Elias-Fano ------------------------------------------------------------


class EliasFano:
    """A sorted sequence of numbers in about 2 + log2(universe / length) bits each."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.l, self.low, self.high = n, low_bits, low, high
        zeros = 64 - np.bitwise_count(high).astype(np.int64)
        self.zeros_before = np.concatenate([[0], np.cumsum(zeros)])

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        l = max(0, (universe // max(1, n)).bit_length() - 1)  # noqa: E741
        v = values.astype(np.uint64)
        low = np.zeros(n * l // 64 + 2, np.uint64)
        if l and n:
            part = v & np.uint64((1 << l) - 1)
            at = np.arange(n, dtype=np.int64) * l
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            low[word[first]] = np.bitwise_or.reduceat(part << shift, first)
            over = np.flatnonzero((at & 63) + l > 64)
            low[word[over] + 1] |= part[over] >> (np.uint64(64) - shift[over])
        size = n + (universe >> l) + 2
        bits = np.zeros((size + 63) // 64 * 64, np.uint8)
        bits[(v >> np.uint64(l)).astype(np.int64) + np.arange(n)] = 1
        return cls(n, l, low, np.packbits(bits, bitorder="little").view(np.uint64))

    def parts(self) -> list[np.ndarray]:
        return [self.low, self.high]

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.l:
            return np.zeros(len(i), np.uint64)
        at = i * self.l
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        carry = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return ((self.low[word] >> shift) | carry) & np.uint64((1 << self.l) - 1)

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Places of the k-th zeros (from 0) of the unary part."""
        word = np.searchsorted(self.zeros_before, k, "right") - 1
        left, bits, at = k - self.zeros_before[word], ~self.high[word], np.zeros(len(k), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            here = np.bitwise_count(bits & np.uint64((1 << width) - 1)).astype(np.int64)
            up = left >= here
            left, at = np.where(up, left - here, left), np.where(up, at + width, at)
            bits = np.where(up, bits >> np.uint64(width), bits)
        return word * 64 + at

    def _one(self, k: np.ndarray) -> np.ndarray:
        """Places of the k-th ones of the unary part."""
        ones_before = np.arange(len(self.zeros_before)) * 64 - self.zeros_before
        word = np.searchsorted(ones_before, k, "right") - 1
        left, bits, at = k - ones_before[word], self.high[word], np.zeros(len(k), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            here = np.bitwise_count(bits & np.uint64((1 << width) - 1)).astype(np.int64)
            up = left >= here
            left, at = np.where(up, left - here, left), np.where(up, at + width, at)
            bits = np.where(up, bits >> np.uint64(width), bits)
        return word * 64 + at

    def at(self, i: np.ndarray) -> np.ndarray:
        """The i-th values."""
        return ((self._one(i) - i).astype(np.uint64) << np.uint64(self.l)) | self._low(i)

    def find(self, x: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
        """Index of each x in the sequence, through its successor, which is sought between places first and last (exclusive) where they are given; -1 where the successor is another number. x must be sorted: equal upper parts are looked up once."""
        out = np.full(len(x), -1, np.int64)
        most = (int(self.zeros_before[-1]) << self.l) - 1  # beyond lies no successor
        n = int(np.searchsorted(x, np.uint64(min(most, (1 << 64) - 1)), "right")) if self.n else 0
        if not n:
            return out
        high, low = (x[:n] >> np.uint64(self.l)).astype(np.int64), x[:n] & np.uint64((1 << self.l) - 1)
        new = np.concatenate([[True], high[1:] != high[:-1]])
        h, at = high[new], np.cumsum(new) - 1
        zero, before = _and_before(self._zero, h)
        lo, hi = ((before - h + 1) * (h > 0))[at], (zero - h)[at]
        if first is not None:
            lo, hi = np.maximum(lo, first[:n]), np.minimum(hi, last[:n])
        open_ = np.flatnonzero(lo < hi)
        lo, hi, low = lo[open_], hi[open_], low[open_]
        end = hi.copy()
        while True:
            go = np.flatnonzero(lo < hi)
            if not len(go):
                break
            mid = (lo[go] + hi[go]) >> 1
            less = self._low(mid) < low[go]
            lo[go[less]], hi[go[~less]] = mid[less] + 1, mid[~less]
        there = np.flatnonzero(lo < end)
        hit = there[self._low(lo[there]) == low[there]]
        out[open_[hit]] = lo[hit]
        return out


def _and_before(f: Callable[[np.ndarray], np.ndarray], k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """f at each of the rising numbers k, and at the number before each: its neighbour's where that is next to it."""
    at = f(k)
    before = np.concatenate([at[:1], at[:-1]])
    alone = np.concatenate([[True], k[1:] != k[:-1] + 1])
    before[alone] = f(np.maximum(k[alone] - 1, 0))
    return at, before


def _codes(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10 / STEP), 0, 65535).astype(np.uint16)


class Level:
    """One level of a trie: the children of each parent in order, their codes, and pointers to where each parent's begin (none at the top).

    Parent p's child of word w is the number base(p) + w, where base(p) is one above the
    last number before p's: 0 or more lies between, so that the sequence stays monotone
    and its universe small, but a number means a word only beside its parent's pointers.
    """

    def __init__(self, keys: EliasFano, codes: np.ndarray, pointers: EliasFano | None = None):
        self.keys, self.codes, self.pointers = keys, codes, pointers

    @classmethod
    def of(cls, parent: np.ndarray, word: np.ndarray, n_parents: int, codes: np.ndarray) -> Level:
        """From children in order of parent and word."""
        start = np.searchsorted(parent, np.arange(n_parents + 1))
        room = np.where(start[1:] > start[:-1], word[np.maximum(start[1:], 1) - 1].astype(np.int64) + 1, 0) if len(word) else np.zeros(n_parents, np.int64)
        base = np.concatenate([[0], np.cumsum(room)])
        return cls(EliasFano.of(base[parent] + word.astype(np.int64), int(base[-1]) + 1), codes, EliasFano.of(start, len(parent) + 1))

    def find(self, parent: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Place of each (parent, word), in this order, or -1."""
        out = np.full(len(parent), -1, np.int64)
        if not self.keys.n or not len(parent):
            return out
        new = np.concatenate([[True], parent[1:] != parent[:-1]])
        p, at = parent[new], np.cumsum(new) - 1
        last, first = (x.astype(np.int64) for x in _and_before(self.pointers.at, p + 1))
        end = self.keys.at(np.maximum(last - 1, 0)).astype(np.int64)
        begin = np.concatenate([end[:1], end[:-1]])  # of the parent before, if that is next to it
        alone = np.concatenate([[True], p[1:] != p[:-1] + 1])
        begin[alone] = self.keys.at(np.maximum(first[alone] - 1, 0)).astype(np.int64)
        base, top = np.where(first > 0, begin + 1, 0), np.where(last > first, end, -1)
        x = base[at] + word.astype(np.int64)
        near = np.flatnonzero(x <= top[at])
        out[near] = self.keys.find(x[near].astype(np.uint64), first[at[near]], last[at[near]])
        return out

    def log10(self, i: np.ndarray) -> np.ndarray:
        return -STEP * self.codes[i]


class Ranked:
    """Tokens (v', u, w) as ranks in each level: distinct keys in order, and each token's place among them."""

    def __init__(self, context: np.ndarray, before: np.ndarray, word: np.ndarray, n_words: int):
        n = self.n = np.uint64(max(1, n_words))
        self.context, a = np.unique(context, return_inverse=True)
        key = a.astype(np.uint64) * n
        self.bigram, g = np.unique(key + word, return_inverse=True)
        self.longer, b = np.unique(key + before, return_inverse=True)
        self.trigram, first, self.place = np.unique(b.astype(np.uint64) * n + word, return_index=True, return_inverse=True)
        self.bigram_of = g[first]  # of each trigram
        self.parent = {"bigram": (self.bigram // n).astype(np.int64), "longer": (self.longer // n).astype(np.int64), "trigram": (self.trigram // n).astype(np.int64)}

    def counts(self, chosen: np.ndarray) -> dict[str, np.ndarray]:
        """How many of the chosen tokens stand below each key."""
        three = np.bincount(self.place, chosen, minlength=len(self.trigram))
        two = np.bincount(self.bigram_of, three, minlength=len(self.bigram))
        longer = np.bincount(self.parent["trigram"], three, minlength=len(self.longer))
        return {"trigram": three, "bigram": two, "longer": longer, "context": np.bincount(self.parent["longer"], longer, minlength=len(self.context))}


@dataclass(frozen=True)
class Whole:
    """Which of a shard's contexts are classes of a split word; that word's c(v) and n(v), by context, and c(v w), by bigram."""

    split: np.ndarray
    context: np.ndarray
    after: np.ndarray
    bigram: np.ndarray


class Trie:
    """A shard's trie; built in memory, written to a file and used through its memory map."""

    def __init__(self, levels: dict[str, Level]):
        self.levels = levels

    @classmethod
    def build(cls, tokens: Ranked, chosen: np.ndarray, log_p1: np.ndarray, whole: Whole | None = None) -> Trie:
        """From the chosen tokens, log10 P1 of each word and the counts of split contexts."""
        n, c = tokens.n, tokens.counts(chosen)
        after = np.bincount(tokens.parent["bigram"], c["bigram"] > 0, minlength=len(tokens.context))
        if whole is not None:
            c["context"], after = np.where(whole.split, whole.context, c["context"]), np.where(whole.split, whole.after, after)
            c["bigram"] = np.where(whole.split[tokens.parent["bigram"]], whole.bigram, c["bigram"])
        kept = {k: np.flatnonzero(x) for k, x in c.items()}
        c = {k: x[kept[k]] for k, x in c.items()}
        # ranks among the kept entries; a kept entry's parent is kept
        parent = {k: np.searchsorted(kept["longer" if k == "trigram" else "context"], tokens.parent[k][kept[k]]) for k in ("bigram", "longer", "trigram")}
        word = {"bigram": tokens.bigram[kept["bigram"]] % n, "longer": tokens.longer[kept["longer"]] % n, "trigram": tokens.trigram[kept["trigram"]] % n}
        children = {"context": after[kept["context"]], "longer": np.bincount(parent["trigram"], minlength=len(kept["longer"]))}
        back = {level: DISCOUNT * children[level] / np.maximum(c[level], 1) for level in children}
        at = parent["bigram"]
        p2 = np.maximum(c["bigram"] - DISCOUNT, 0) / c["context"][at] + back["context"][at] * 10.0 ** log_p1[word["bigram"].astype(np.int64)]
        at = parent["trigram"]
        below = np.searchsorted(kept["bigram"], tokens.bigram_of[kept["trigram"]])
        p3 = np.maximum(c["trigram"] - DISCOUNT, 0) / c["longer"][at] + back["longer"][at] * p2[below]
        log = lambda p: _codes(np.log10(np.maximum(p, 1e-300)))

        v = tokens.context[kept["context"]]
        n_contexts, n_longer = len(kept["context"]), len(kept["longer"])
        return cls({
            "context": Level(EliasFano.of(v, int(v[-1]) + 1 if len(v) else 1), log(back["context"])),
            "bigram": Level.of(parent["bigram"], word["bigram"], n_contexts, log(p2)),
            "longer": Level.of(parent["longer"], word["longer"], n_contexts, log(back["longer"])),
            "trigram": Level.of(parent["trigram"], word["trigram"], n_longer, log(p3)),
        })

    def save(self, path: str) -> None:
        """All levels one after another: lengths, then the arrays."""
        with open(path, "wb") as f:
            for level in self.levels.values():
                for ef in (level.keys, level.pointers):
                    if ef is None:
                        f.write(struct.pack("<4q", -1, 0, 0, 0))
                        continue
                    f.write(struct.pack("<4q", ef.n, ef.l, len(ef.low), len(ef.high)))
                    f.writelines(p.tobytes() for p in ef.parts())
                f.write(struct.pack("<q", len(level.codes)) + level.codes.tobytes() + b"\0" * (-2 * len(level.codes) % 8))

    @classmethod
    def load(cls, path: str) -> Trie:
        raw, at, levels = np.memmap(path, np.uint64, "r"), 0, {}
        for name in ("context", "bigram", "longer", "trigram"):
            pair = []
            for _ in range(2):
                n, l, low, high = (int(x) for x in raw[at : at + 4].view(np.int64))  # noqa: E741
                at += 4
                pair.append(EliasFano(n, l, raw[at : at + low], raw[at + low : at + low + high]) if n >= 0 else None)
                at += low + high
            n = int(raw[at].view(np.int64))
            levels[name] = Level(pair[0], raw[at + 1 : at + 1 + (2 * n + 7) // 8].view(np.uint16)[:n], pair[1])
            at += 1 + (2 * n + 7) // 8
        return cls(levels)

    def score(self, tokens: Ranked, log_p1: np.ndarray) -> np.ndarray:
        """log10 P(w | u v) of tokens; equal keys of a level are looked up once, in order."""
        n = tokens.n

        def looked_up(name: str, above: np.ndarray | None, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Index of each key in a level, where its parent is known, and the logarithm there (0 where it isn't)."""
            out, value = np.full(len(keys), -1, np.int64), np.zeros(len(keys))
            if above is None:
                out = self.levels[name].keys.find(keys)
            else:
                there = np.flatnonzero(above >= 0)
                out[there] = self.levels[name].find(above[there], keys[there] % n)
            value[out >= 0] = self.levels[name].log10(out[out >= 0])
            return out, value

        parent = tokens.parent
        a, back = looked_up("context", None, tokens.context)
        g, two = looked_up("bigram", a[parent["bigram"]], tokens.bigram)
        two = np.where(g >= 0, two, log_p1[(tokens.bigram % n).astype(np.int64)] + back[parent["bigram"]])
        b, back = looked_up("longer", a[parent["longer"]], tokens.longer)
        t, three = looked_up("trigram", b[parent["trigram"]], tokens.trigram)
        return np.where(t >= 0, three, two[tokens.bigram_of] + back[parent["trigram"]])[tokens.place]


# --- messages ----------------------------------------------------------------


@dataclass(frozen=True)
class Vocabulary:
    """Totals, the head's sorted hashes with counts and, for split words (by place in the head), numbers of different successors."""

    tokens: int
    types: int
    head: np.ndarray
    counts: np.ndarray
    n_shards: int
    after: np.ndarray | None = None

    @property
    def log_unit(self) -> float:
        """log10 of N + 1 * (V + 1)."""
        return math.log10(self.tokens + self.types + 1)

    def classes(self) -> np.ndarray:
        """How many classes the contexts of each head word are split into."""
        share = max(1, self.tokens // (self.n_shards * PART))
        return np.minimum(1 + self.counts // share, 1 << _CLASS_BITS)


def _pack(*columns: np.ndarray) -> bytes:
    """Unsigned 32-bit columns, of any lengths, as planes of bytes, compressed."""
    planes = b"".join(np.ascontiguousarray(c.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(struct.pack(f"<{len(columns)}q", *map(len, columns)) + planes)


def _unpack(raw: bytes, n_columns: int) -> list[np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(raw), 8 * n_columns, []
    for n in struct.unpack_from(f"<{n_columns}q", data):
        out.append(np.ascontiguousarray(np.frombuffer(data, np.uint8, 4 * n, at).reshape(4, n).T).view("<u4").reshape(-1))
        at += 4 * n
    return out


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list[bytes], list[bool]]]:
    """doc_ids, texts as bytes and held_out marks of about CHUNK_BYTES at a time."""
    ids, texts, held, size = [], [], [], 0
    for batch in batches:
        for i, t, h in zip(batch.doc_id, batch.text, batch.held_out):
            raw = t.encode("utf-8", "surrogatepass") if t else b""
            if size and size + len(raw) > CHUNK_BYTES:
                yield ids, texts, held
                ids, texts, held, size = [], [], [], 0
            ids.append(i)
            texts.append(raw)
            held.append(bool(h))
            size += len(raw)
    if ids:
        yield ids, texts, held


def counted(docs: DataFrame) -> DataFrame:
    """(word, n): occurrences of each word, and of the end mark, in docs (doc_id, text, held_out) that aren't held out."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, numbers, size = [], [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            every, at = np.unique(np.concatenate(words), return_inverse=True)
            return every, np.bincount(at, np.concatenate(numbers)).astype(np.int64)

        for _, texts, held in _chunks(batches):
            texts = [t for t, h in zip(texts, held) if not h]
            if not texts:
                continue
            own, n = np.unique(word_hashes(texts)[0], return_counts=True)
            words += [own, np.array([END])]
            numbers += [n, np.array([len(texts)])]
            size += len(own)
            if size > FLUSH_WORDS:
                w, n = merged()
                words, numbers, size = [w], [n], 0
                if len(w) > FLUSH_WORDS // 2:
                    yield pd.DataFrame({"word": w.view(np.int64), "n": n})
                    words, numbers = [], []
        if words:
            w, n = merged()
            yield pd.DataFrame({"word": w.view(np.int64), "n": n})

    return docs.mapInPandas(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Totals and head of stored counts. The head is cut between two of a fixed number of count ranges, so at most HEAD words are fetched."""
    step = F.floor(F.log2("n") * 8)
    ranges = sorted(counts.groupBy(step.alias("range")).agg(F.count("*").alias("words"), F.sum("n").alias("tokens")).collect(), reverse=True)
    size, least = 0, None
    for r in ranges:
        size += r.words
        if size > HEAD:
            break
        least = r["range"]
    tokens, types = sum(r.tokens for r in ranges), sum(r.words for r in ranges)
    rows = counts.filter(step >= least).collect() if least is not None else []
    head = np.array([r.word for r in rows], dtype=np.int64).view(np.uint64)
    order = np.argsort(head)
    return Vocabulary(tokens, types, head[order], np.array([r.n for r in rows], dtype=np.int64)[order], max(1, math.ceil(tokens / SHARD_TOKENS)))


def _classed(u: np.ndarray, v: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Keys of contexts v' from numbers of the two words before."""
    m = np.where(v < len(classes), classes[np.minimum(v, len(classes) - 1)], 1) if len(classes) else np.ones(len(v), np.int64)
    return (v.astype(np.uint64) << np.uint64(_CLASS_BITS)) + mix64(u.astype(np.uint64)) % m.astype(np.uint64)


def _is_split(v: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Whether each numbered word has more than one class."""
    return (v < len(classes)) & (classes[np.minimum(v, len(classes) - 1)] > 1) if len(classes) else np.zeros(len(v), bool)


def _squeeze(*columns: np.ndarray) -> bytes:
    """64-bit columns of one length, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join([struct.pack("<q", len(columns[0])), *(np.ascontiguousarray(c).tobytes() for c in columns)]))


def _stretch(raw: bytes, kinds: str) -> list[np.ndarray]:
    """The columns of _squeeze(), as integers (i) or doubles (f)."""
    data = zstandard.ZstdDecompressor().decompress(raw)
    n = struct.unpack_from("<q", data)[0]
    return [np.frombuffer(data, np.int64 if k == "i" else np.float64, n, 8 + 8 * n * j) for j, k in enumerate(kinds)]


def _numbers(rare: np.ndarray, n_head: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of 32 bits, after those of the head, of rare words' hashes, and 32 bits more that tell words with one number apart."""
    h = mix64(rare)
    return (n_head + h % np.uint64(_NO_WORD - n_head)).astype(np.uint32), (h >> np.uint64(32)).astype(np.uint32)


class Tokens:
    """The tokens of a chunk's texts."""

    def __init__(self, texts: list[bytes], voc: Vocabulary):
        n_head = len(voc.head)
        words, first = word_hashes(texts)
        self.n = np.diff(first) + 1
        begin = np.concatenate([[0], np.cumsum(self.n)])
        self.start, inner = begin[:-1], np.ones(begin[-1], bool)
        inner[begin[1:] - 1] = False
        self.hash = np.full(begin[-1], END, np.uint64)
        self.hash[inner] = words
        self.place = np.minimum(np.searchsorted(voc.head, self.hash), max(0, n_head - 1))
        self.in_head = voc.head[self.place] == self.hash if n_head else np.zeros(len(self.hash), bool)
        self.number, self.more = self.place.astype(np.uint32), np.zeros(len(self.hash), np.uint32)
        rare = ~self.in_head
        self.number[rare], self.more[rare] = _numbers(self.hash[rare], n_head)
        self.doc = np.repeat(np.arange(len(texts), dtype=np.uint32), self.n)

    def sent(self, voc: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places of the tokens that shards score, their u, v and w, and the shards: those of contexts; a first word has none (v is _NO_WORD), is sent if rare, and goes by itself."""
        first = np.zeros(len(self.hash), bool)
        first[self.start] = True
        at = np.flatnonzero(~first | ~self.in_head)
        w, first = self.number[at], first[at]
        v = np.where(first, np.uint32(_NO_WORD), self.number[np.maximum(at - 1, 0)])
        u = np.where(first | (at - 1 <= self.start[self.doc[at]]), np.uint32(_NO_WORD), self.number[np.maximum(at - 2, 0)])
        return at, u, v, w, _shards(u, v, w, voc)


def _shards(u: np.ndarray, v: np.ndarray, w: np.ndarray, voc: Vocabulary) -> np.ndarray:
    return (mix64(np.where(v == _NO_WORD, w.astype(np.uint64), _classed(u, v, voc.classes()))) % np.uint64(voc.n_shards)).astype(np.int64)


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper 32 bits."""
    x = x.astype(np.uint64, copy=False)
    return x.astype(np.uint32), (x >> np.uint64(32)).astype(np.uint32)


def _whole(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32))


def _distinct(key: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, to): where each begins in order, the keys and shards, and that order."""
    order = np.lexsort((to, key))
    key, to = key[order], to[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (to[1:] != to[:-1])
    first = np.flatnonzero(new)
    return first, key[first], to[first], order


#: Kinds of messages: asked are a rare word's count and the counts of pairs of a split v; told are those counts; a chunk's texts, its tokens, and the chunks that a relay took together.
_WORD, _PAIR, _COUNT, _COUNTS, _SUCCESSORS, _TEXTS, _TOKENS, _BATCH = range(8)
_MESSAGE = "shard long, kind int, chunk long, data binary"
_COLUMNS = ["shard", "kind", "chunk", "data"]
#: Columns of messages of each kind that a relay deals out again, and how to tell their shard.
_WIDTH = {_WORD: 4, _PAIR: 5, _COUNT: 6, _COUNTS: 6}


def _word_shard(word: np.ndarray, voc: Vocabulary) -> np.ndarray:
    return word.view(np.int64) % voc.n_shards


def _pair_shard(pair: np.ndarray, voc: Vocabulary) -> np.ndarray:
    return (mix64(pair) % np.uint64(voc.n_shards)).astype(np.int64)


def _deal(shard: np.ndarray, voc: Vocabulary, kind: int, chunk: int, *columns: np.ndarray) -> Iterator[tuple[int, int, int, bytes]]:
    """One message of columns to each shard, or to each group of shards where there are many."""
    for s, at in dealt(shard % groups_for(voc.n_shards)):
        yield s, kind, chunk, _pack(*(c[at] for c in columns))


def _dealt_again(voc: Vocabulary):
    """What relayed() does with the messages of _wanted_rows() and of tell()."""

    def again(kind: int, _: int, held: list[tuple[int, bytes]]) -> Iterator[tuple[int, int, int, bytes]]:
        if kind not in _WIDTH:  # bound for a chunk, not for a shard
            yield from ((c % voc.n_shards, kind, c, d) for c, d in held)
            return
        columns = [np.concatenate(c) for c in zip(*(_unpack(d, _WIDTH[kind]) for _, d in held))]
        first = _whole(*columns[:2])
        shard = _word_shard(first, voc) if kind == _WORD else _pair_shard(first, voc) if kind == _PAIR else _whole(*columns[4:6]).astype(np.int64)
        for s, at in dealt(shard):
            yield s, kind, 0, _pack(*(c[at] for c in columns))

    return again


def _wanted_rows(texts: list[bytes], held: list[bool], voc: Vocabulary) -> Iterator[tuple[int, int, int, bytes]]:
    """Of some texts, for each shard of the vocabulary its rare words, with the shards that meet them; for each shard of pairs those of a split v, with the shards of contexts and how often they occur in training."""
    t = Tokens(texts, voc)
    sent, _, v, w, shard = t.sent(voc)
    at = np.flatnonzero(~t.in_head[sent])
    _, word, to, _ = _distinct(t.hash[sent[at]], shard[at])
    yield from _deal(_word_shard(word, voc), voc, _WORD, 0, *_halves(word), *_halves(to))
    at = np.flatnonzero(_is_split(v, voc.classes()))
    if len(at):
        first, pair, to, order = _distinct(_whole(w[at], v[at]), shard[at])
        n = np.add.reduceat(~np.array(held, bool)[t.doc[sent[at[order]]]], first, dtype=np.int64)
        yield from _deal(_pair_shard(pair, voc), voc, _PAIR, 0, *_halves(pair), *_halves(to), n)


def _message_rows(ids: list, texts: list[bytes], held: list[bool], voc: Vocabulary) -> Iterator[tuple[int, int, int, bytes]]:
    """The messages of one chunk."""
    t = Tokens(texts, voc)
    n, start, doc = t.n, t.start, t.doc
    base = np.where(t.in_head, np.log10(voc.counts + 1.0)[t.place], 0.0) if len(voc.head) else np.zeros(len(t.hash))
    null = np.array([i is None or i != i for i in ids])
    own = np.array([0 if x else int(i) for i, x in zip(ids, null)], np.int64)
    whole = hashlib.blake2b(digest_size=8)
    for part in (own, null, np.array(held, bool), np.array([len(x) for x in texts], np.int64), *texts):
        whole.update(part)
    chunk = int.from_bytes(whole.digest(), "little") >> 1  # equal for chunks with equal rows only
    alone = np.where(t.in_head[start], base[start] - voc.log_unit, 0.0)
    texts_of = _squeeze(own, null.astype(np.int64), np.array(held, np.int64), n, np.add.reduceat(t.in_head.astype(np.int64), start), np.add.reduceat(base, start), alone)
    yield chunk % groups_for(voc.n_shards), _TEXTS, chunk, texts_of
    at, u, v, w, to = t.sent(voc)
    mark = doc[at] * np.uint32(2) + np.array(held, np.uint32)[doc[at]]
    rare = ~t.in_head[at]
    for s, k in dealt(to % groups_for(voc.n_shards)):
        yield s, _TOKENS, chunk, _pack(mark[k], u[k], v[k], w[k], t.more[at[k[rare[k]]]])


def _tokens_again(voc: Vocabulary):
    """What relayed() does with the messages of _message_rows(): the chunks of a batch become one, whose documents are numbered on."""
    n_head = len(voc.head)

    def again(kind: int, number: int, held: list[tuple[int, bytes]]) -> Iterator[tuple[int, int, int, bytes]]:
        if kind != _TOKENS:
            yield from ((c % voc.n_shards, kind, c, d) for c, d in held)
            return
        parts = [_unpack(d, 5) for _, d in held]
        begin = np.concatenate([[0], np.cumsum([int(p[0].max() >> np.uint32(1)) + 1 for p in parts])])
        mark, u, v, w = (np.concatenate([p[k] for p in parts]) for k in range(4))
        mark += np.repeat(begin[:-1].astype(np.uint32) * np.uint32(2), [len(p[0]) for p in parts])
        more = np.zeros(len(w), np.uint32)
        more[w >= n_head] = np.concatenate([p[4] for p in parts])
        batch = int.from_bytes(hashlib.blake2b(struct.pack("<q", number), digest_size=8).digest(), "little") >> 1
        yield batch % voc.n_shards, _BATCH, batch, _squeeze(np.array([c for c, _ in held], np.int64), begin[:-1])
        for s, k in dealt(_shards(u, v, w, voc)):
            yield s, _TOKENS, batch, _pack(mark[k], u[k], v[k], w[k], more[k[w[k] >= n_head]])

    return again


def _by_shard(counts: DataFrame, voc: Vocabulary):
    return counts.withColumn("shard", F.pmod("word", F.lit(voc.n_shards))).select("shard", "word", "n").groupBy("shard")


def _found(words: pd.DataFrame, hashes: np.ndarray) -> np.ndarray:
    """The count of each hash by a shard's words, 0 where there is none."""
    order = np.argsort(words.word.to_numpy())
    known, n = words.word.to_numpy()[order], words.n.to_numpy()[order]
    if not len(known):
        return np.zeros(len(hashes), np.int64)
    hashes = hashes.view(np.int64)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, n[at], 0)


def _sent_counts(docs: DataFrame, counts: DataFrame, voc: Vocabulary) -> DataFrame:
    """Messages for each shard of contexts: numbers and counts of the rare words that it meets, its pairs of a split v and their counts. Beside them, as _SUCCESSORS, how many pairs (chunk) of a split v (shard) one shard of pairs has."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, texts, held in _chunks(batches):
            rows = list(_wanted_rows(texts, held, voc))
            if rows:
                yield pd.DataFrame(rows, columns=_COLUMNS)

    def counted_once(key: np.ndarray, to: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in key and shards of the distinct (place, to) with a count."""
        order = np.lexsort((to, key))
        key, to = key[order], to[order]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (to[1:] != to[:-1])]) & (n[key] > 0)
        return key[new], to[new]

    def tell(rows: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        out = []
        rare = [_unpack(d, 4) for d in rows.data[rows.kind == _WORD]]
        if rare:
            low, high, *to = (np.concatenate(c) for c in zip(*rare))
            word, at = np.unique(_whole(low, high), return_inverse=True)
            n = _found(words, word)
            at, to = counted_once(at, _whole(*to).astype(np.int64), n)
            number, more = _numbers(word, len(voc.head))
            out += _deal(to, voc, _COUNT, 0, number[at], more[at], *_halves(n[at]), *_halves(to))
        split = [_unpack(d, 5) for d in rows.data[rows.kind == _PAIR]]
        if split:
            low, high, *to, n = (np.concatenate(c) for c in zip(*split))
            pair, at = np.unique(_whole(low, high), return_inverse=True)
            n = np.bincount(at, n).astype(np.int64)
            at, to = counted_once(at, _whole(*to).astype(np.int64), n)
            out += _deal(to, voc, _COUNTS, 0, *_halves(pair[at]), *_halves(n[at]), *_halves(to))
            out += [(v, _SUCCESSORS, m, None) for v, m in zip(*(x.tolist() for x in np.unique((pair[n > 0] >> np.uint64(32)).astype(np.int64), return_counts=True)))]
        return pd.DataFrame(out, columns=_COLUMNS)

    asked = relayed(docs.mapInPandas(ask, _MESSAGE), voc.n_shards, _dealt_again(voc), "ngram-asked")
    return asked.groupBy("shard").cogroup(_by_shard(counts, voc)).applyInPandas(tell, _MESSAGE)


def _messages(docs: DataFrame, voc: Vocabulary) -> DataFrame:
    """The messages of all chunks: their texts with what the head tells of them, and their tokens."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ids, texts, held in _chunks(batches):
            rows = list(_message_rows(ids, texts, held, voc))
            for k in range(0, len(rows), 64):
                yield pd.DataFrame(rows[k : k + 64], columns=_COLUMNS)

    return docs.mapInPandas(pack, _MESSAGE)


def _whole_counts(tokens: Ranked, own: np.ndarray, pairs: list[bytes], voc: Vocabulary) -> Whole | None:
    """Counts of the split contexts among a shard's tokens (of own words), from the pairs sent to it."""
    v = (tokens.context >> np.uint64(_CLASS_BITS)).astype(np.uint32)
    split = _is_split(v, voc.classes())
    if not split.any():
        return None
    at, n = np.where(split, v, 0), np.zeros(len(tokens.bigram), np.int64)
    if pairs:
        parts = [np.concatenate(c) for c in zip(*(_unpack(m, 6) for m in pairs))]
        pair, count = _whole(*parts[:2]), _whole(*parts[2:4]).astype(np.int64)
        order = np.argsort(pair)
        pair, count = pair[order], count[order]
        here = np.flatnonzero(split[tokens.parent["bigram"]])
        key = _whole(own[(tokens.bigram[here] % tokens.n).astype(np.int64)].astype(np.uint32), v[tokens.parent["bigram"][here]])
        place = np.minimum(np.searchsorted(pair, key), len(pair) - 1)
        n[here] = np.where(pair[place] == key, count[place], 0)
    return Whole(split, voc.counts[at], voc.after[at], n)


def _scored(messages: list[bytes], rare: list[bytes], pairs: list[bytes], voc: Vocabulary) -> list[bytes]:
    """For each message of a shard, its texts' numbers, how many of their rare words are known, the sums of these words' log10 (c + 1), and the sums of log10 probabilities; rare and pairs hold the counts sent to it."""
    parts, n_head = [_unpack(m, 5) for m in messages], len(voc.head)
    mark, u, v, w = (np.concatenate([p[k] for p in parts]) for k in range(4))
    w = w.astype(np.uint64)
    is_rare = w >= n_head
    w[is_rare] |= np.concatenate([p[4] for p in parts]).astype(np.uint64) << np.uint64(32)
    own, place = np.unique(w, return_inverse=True)  # those of the head first
    n, in_head = np.zeros(len(own), np.int64), own < n_head
    n[in_head] = voc.counts[own[in_head].astype(np.int64)]
    for number, more, low, high, *_ in (_unpack(m, 6) for m in rare):
        n[np.searchsorted(own, _whole(number, more))] = _whole(low, high).astype(np.int64)
    p1 = np.log10(n + 1.0) - voc.log_unit
    value, later = p1[place], np.flatnonzero(v != _NO_WORD)
    if len(later):
        before, u = np.unique(u[later], return_inverse=True)
        train = mark[later] & np.uint32(1) == 0
        with tempfile.TemporaryDirectory() as folder:
            path = os.path.join(folder, "trie")
            tokens = Ranked(_classed(before[u], v[later], voc.classes()), u.astype(np.uint32), place[later].astype(np.uint32), max(len(own), len(before)))
            Trie.build(tokens, train, p1, _whole_counts(tokens, own, pairs, voc)).save(path)
            value[later] = Trie.load(path).score(tokens, p1)
    known, rare_value, out, at = is_rare & (n[place] > 0), np.where(is_rare, np.log10(n + 1.0)[place], 0.0), [], 0
    for part in parts:
        here, doc = slice(at, at + len(part[0])), part[0] >> np.uint32(1)
        there = np.flatnonzero(np.bincount(doc))
        out.append(_squeeze(there, *(np.bincount(doc, x[here])[there] for x in (known, rare_value, value))))
        at += len(doc)
    return out


_ANSWER = "chunk long, kind int, data binary"
_ANSWERS = ["chunk", "kind", "data"]


def _answers(messages: DataFrame, voc: Vocabulary) -> DataFrame:
    """(chunk, kind, data): texts and batches as they came, and for each message of tokens what _scored() gives."""

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        as_they_are = rows[rows.kind.isin([_TEXTS, _BATCH])]
        out = list(zip(as_they_are.chunk, as_they_are.kind, as_they_are.data))
        third = rows[rows.kind == _TOKENS]
        if len(third):
            scored = _scored(list(third.data), list(rows.data[rows.kind == _COUNT]), list(rows.data[rows.kind == _COUNTS]), voc)
            out += [(c, _TOKENS, d) for c, d in zip(third.chunk, scored)]
        return pd.DataFrame(out, columns=_ANSWERS)

    return messages.groupBy("shard").applyInPandas(answer, _ANSWER)


def _returned(answers: DataFrame, voc: Vocabulary) -> DataFrame:
    """Answers at their chunks: those to a relay's batches are summed and taken apart."""
    if groups_for(voc.n_shards) == voc.n_shards:
        return answers

    def apart(rows: pd.DataFrame) -> pd.DataFrame:
        head = rows.data[rows.kind == _BATCH]
        if not len(head):
            return rows[_ANSWERS]  # a chunk's texts
        chunks, begin = _stretch(head.iloc[0], "ii")
        parts = [_stretch(d, "ifff") for d in rows.data[rows.kind == _TOKENS]]
        doc, *values = (np.concatenate(c) for c in zip(*parts))
        there, at = np.unique(doc, return_inverse=True)
        values = [np.bincount(at, x) for x in values]
        of = np.searchsorted(begin, there, "right") - 1
        return pd.DataFrame([(int(chunks[c]), _TOKENS, _squeeze(there[k] - begin[c], *(x[k] for x in values))) for c, k in dealt(of)], columns=_ANSWERS)

    return answers.groupBy("chunk").applyInPandas(apart, _ANSWER)


def scores(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    short_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (crc_mod("doc_id", HELD_OUT_OF) == HELD_OUT).alias("held_out"))
    counts = stored(counted(rows), "ngram-words")
    voc = vocabulary(counts)
    sent = stored(_sent_counts(rows, counts, voc), "ngram-sent")
    after = np.zeros(len(voc.head), np.int64)
    for r in sent.filter(F.col("kind") == _SUCCESSORS).groupBy("shard").agg(F.sum("chunk").alias("n")).collect():  # split words, at most HEAD
        after[r.shard] = r.n
    voc = replace(voc, after=after)

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        own = list(rows.data[rows.kind == _TEXTS])
        ids, null, held, n, known, base, score = (x.copy() for x in _stretch(own[0], "iiiiiff"))
        known, same = known.astype(np.float64), len(own)  # equal chunks share their sums
        for data in rows.data[rows.kind == _TOKENS]:
            there, hits, value, p = _stretch(data, "ifff")
            known[there] += hits / same
            base[there] += value / same
            score[there] += p / same
        out = pd.DataFrame({
            "doc_id": pd.array(np.where(null > 0, None, ids.astype(object)), dtype="Int64"), "held_out": held > 0, "n_tokens": n, "n_known": np.rint(known).astype(np.int64),
            "train_tokens": voc.tokens, "base_score": base - n * voc.log_unit, "score": score,
        })
        return pd.concat([out] * same)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    told = relayed(sent.filter(F.col("kind") != _SUCCESSORS), voc.n_shards, _dealt_again(voc), "ngram-told")
    messages = relayed(_messages(rows, voc), voc.n_shards, _tokens_again(voc), "ngram-messages")
    return _returned(_answers(messages.union(told), voc), voc).groupBy("chunk").applyInPandas(total, schema)
