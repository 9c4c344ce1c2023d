"""Removal of repeated byte strings through a sparse enhanced suffix array, in shards.

Every string of LENGTH bytes holds an anchor: the smallest hash among its GRAM-byte
grams, so equal strings hold it at the same offset. Only anchors are suffixes of the
array, about one in 50 bytes, and a shard holds all anchors of its grams. Beside an anchor
stand at most REACH bytes before its gram and REACH after it: all that any string of
LENGTH bytes around it can hold.

1. Chunks of documents send their anchors' gram and context hashes to the shards. Anchors
   with one and the same whole context are a maximal repeat as far as the contexts reach.
   Grams met once are done with. Of the rest, one anchor of each different context goes on.
2. Those anchors' contexts are sorted by what follows the gram: an enhanced suffix array
   with common-prefix lengths. A scan with a stack gives the tree of common-prefix
   intervals. In an interval, the members are ordered by what precedes the gram, and the
   same scan over their common left lengths gives the sets that extend to the left alike.
   A set whose left extensions differ beyond that, and whose members lie in more than one
   child of the interval, is a maximal repeat: its length, and all members as occurrences.
3. A gram with so many different contexts that no task should hold them (over TREE_MEMBERS,
   or over CHUNK_MEMBERS in one chunk) has the strings of LENGTH bytes around its anchors
   grouped by hash instead, in chunks before they are dealt out; these strings are then the repeats.

What is removed are the occurrences of the repeats of LENGTH bytes or more: a string of
LENGTH bytes that occurs twice lies in a maximal repeat with the same occurrences. They are
joined to the documents by a hash of id and text and united there. repeats() gives the
groups themselves; a repeat that reaches beyond its anchor's context is a row of groups
there, one an anchor, that overlap. Hashes have 64 bits. Beyond common.DIRECT shards,
chunks address groups of shards, and messages are dealt out again there.

Defined cases: a null text is empty; matches never cross documents; texts shorter than
LENGTH lose nothing; rows equal in doc_id and text are two documents, and both lose what
they share; a null doc_id is a value as others; extra columns play no part.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import dealt, groups_for, mix64, relayed, short_batches, stored

LENGTH, GRAM = 200, 100
REACH = LENGTH - GRAM
#: Bytes of text a shard is meant for, and in one chunk of documents.
SHARD_BYTES, CHUNK_BYTES = 48_000_000, 4_000_000
TREE_MEMBERS, CHUNK_MEMBERS = 4096, 32
#: UTF-8 has no such byte.
PAD = 0xFF
_MOST = np.uint64((1 << 64) - 1)
_BYTES = mix64(np.arange(256, dtype=np.uint64) + np.uint64(0x1234567))
_C = np.uint64(0x9FB21C651E98DF25)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all GRAM-byte strings along the last axis: 64, 32 and 4 bytes, each from two halves."""
    h, size, kept = _BYTES[data], 1, {}
    while size < 64:
        h = ((h ^ (h >> np.uint64(29))) * _C)[..., : h.shape[-1] - size] + h[..., size:]
        size *= 2
        if size in (4, 32, 64):
            kept[size] = h
    n = data.shape[-1] - GRAM + 1
    a, b, c = kept[64][..., :n], kept[32][..., 64 : 64 + n], kept[4][..., 96 : 96 + n]
    return mix64((a ^ (a >> np.uint64(31))) * _C + (b ^ (b >> np.uint64(30))) * np.uint64(0xC2B2AE3D27D4EB4F) + c)


def _slide(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """best over each width neighbours."""
    step, out = 1, x
    while 2 * step <= width:
        out = best(out[:-step], out[step:])
        step *= 2
    return best(out[: len(x) - width + 1], out[width - step : width - step + len(x) - width + 1])


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, position, gram hash and context hash of all anchors of texts."""
    long = [i for i, t in enumerate(texts) if len(t) >= LENGTH]
    nothing = np.zeros(0, np.int64)
    if not long:
        return nothing, nothing, nothing.astype(np.uint64), nothing.astype(np.uint64)
    gap = bytes([PAD]) * REACH
    data = np.frombuffer(gap + gap.join(texts[i] for i in long) + gap, np.uint8)
    size = np.array([len(texts[i]) for i in long])
    start = REACH + np.concatenate([[0], np.cumsum(size[:-1] + REACH)])
    h = gram_hashes(data)
    inside = np.zeros(len(h) + 1, np.int8)
    np.add.at(inside, start, 1)
    np.add.at(inside, start + size - GRAM + 1, -1)
    h_in = np.where(np.cumsum(inside[:-1]) > 0, h, _MOST)
    least = _slide(h_in, REACH + 1, np.minimum)
    window = np.zeros(len(least) + 1, np.int8)
    np.add.at(window, start, 1)
    np.add.at(window, start + size - LENGTH + 1, -1)
    least = np.where(np.cumsum(window[:-1]) > 0, least, np.uint64(0))
    most = _slide(np.concatenate([np.zeros(REACH, np.uint64), least, np.zeros(len(h) - len(least), np.uint64)]), REACH + 1, np.maximum)
    at = np.flatnonzero((h_in == most[: len(h)]) & (most[: len(h)] > 0) & (h_in < _MOST))
    doc = np.searchsorted(start, at, "right") - 1
    around = mix64(h[at - REACH] * np.uint64(3) + mix64(h[at] * np.uint64(5) + mix64(h[at + GRAM] if len(at) else h[:0])))
    return np.array(long)[doc], at - start[doc], h[at], around


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' bytes with REACH times PAD around each, and where each begins."""
    gap = bytes([PAD]) * REACH
    return np.frombuffer(gap + gap.join(texts) + gap, np.uint8), REACH + np.concatenate([[0], np.cumsum(np.array([len(t) + REACH for t in texts[:-1]], np.int64))])


def contexts(data: np.ndarray, place: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The REACH bytes before (nearest first) and after the grams that stand at places of joined data, at in texts of such sizes.

    A gram is no anchor of a string that also holds a smaller gram. Where a context would,
    it ends before, with PAD: then whatever anchors share is shared by all its occurrences.
    """
    before, after = np.empty((len(place), REACH), np.uint8), np.empty((len(place), REACH), np.uint8)
    for lo in range(0, len(place), 8192):
        p, a, n = (x[lo : lo + 8192, None] for x in (place, at, size))
        before[lo : lo + 8192], after[lo : lo + 8192] = data[p - 1 - np.arange(REACH)], data[p + GRAM + np.arange(REACH)]
        begin = a - REACH + np.arange(2 * REACH + 1)
        h = np.where((begin >= 0) & (begin + GRAM <= n), gram_hashes(data[p - REACH + np.arange(2 * REACH + GRAM)]), _MOST)
        smaller = h < h[:, REACH : REACH + 1]
        ends = [np.where(x.any(axis=1), x.argmax(axis=1), REACH) for x in (smaller[:, REACH - 1 :: -1], smaller[:, REACH + 1 :])]
        for side, end in zip((before, after), ends):
            side[lo : lo + 8192][np.arange(REACH) >= end[:, None]] = PAD
    return before, after


def united(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of ranges as maximal ones, in order; ranges that touch are one."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > end[:-1]])
    return start[new], end[np.concatenate([new[1:], [True]])]


# --- the tree of common-prefix intervals ---------------------------------------


def intervals(lcp: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(depth, parent's depth, first, last) of all common-prefix intervals with two members or more; lcp[i] belongs to suffixes i - 1 and i, and is -1 between groups."""
    out, stack = [], []  # stack: (depth, first)
    values = lcp.tolist() + [-1]
    for i in range(1, len(values)):
        x, first = values[i], i - 1
        while stack and stack[-1][0] > x:
            depth, first = stack.pop()
            out.append((depth, max(x, stack[-1][0] if stack else -1), first, i - 1))
        if x >= 0 and (not stack or stack[-1][0] < x):
            stack.append((x, first))
    return out


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common-prefix lengths of rows of bytes."""
    differ = a != b
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


def _order(group: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Order by group, then by rows of bytes."""
    width = -(-rows.shape[1] // 8) * 8
    wide = np.zeros((len(rows), width), np.uint8)
    wide[:, : rows.shape[1]] = rows
    columns = wide.view(">u8")
    return np.lexsort([*(columns[:, k] for k in range(columns.shape[1] - 1, -1, -1)), group])


@dataclass(frozen=True)
class Repeat:
    """A maximal repeat around a gram: bytes before and after it, and its members."""

    before: int
    after: int
    members: np.ndarray

    @property
    def length(self) -> int:
        return self.before + GRAM + self.after


def maximal_repeats(gram: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[Repeat]:
    """Of anchors with the bytes before (nearest first) and after their grams, the maximal repeats of LENGTH bytes or more that hold a gram, as far as these bytes reach.

    Bytes beyond a document's edge are PAD, which never counts as shared.
    """
    order = _order(gram, right)
    g, le, ri = gram[order], left[order], right[order]
    own_left, own_right = _reach(le), _reach(ri)
    lcp = np.full(len(g), -1, np.int64)
    lcp[1:] = np.where(g[1:] == g[:-1], _common(ri[1:], ri[:-1]), -1)
    out = []
    nodes = np.array(intervals(lcp), dtype=np.int64).reshape(-1, 4)
    depth, first, last = nodes[:, 0], nodes[:, 2], nodes[:, 3]
    after = np.minimum(depth, own_right[first])  # all members share the prefix, with the edge if it lies there
    pair = np.flatnonzero((last - first == 1) & (after + REACH + GRAM >= LENGTH))
    both = np.minimum(_common(le[first[pair]], le[last[pair]]), own_left[first[pair]])
    for k, before in zip(pair.tolist(), both.tolist()):  # two members differ in the byte after, and in that before
        if before + GRAM + after[k] >= LENGTH:
            out.append(Repeat(before, int(after[k]), order[first[k] : last[k] + 1]))
    for k in np.flatnonzero((last - first > 1) & (after + REACH + GRAM >= LENGTH)).tolist():
        i = np.arange(first[k], last[k] + 1)
        child = np.cumsum(np.concatenate([[0], lcp[first[k] + 1 : last[k] + 1] <= depth[k]]))
        by_left = _order(np.zeros(len(i), np.int8), le[i])
        i, child = i[by_left], child[by_left]
        near = np.concatenate([[-1], _common(le[i[1:]], le[i[:-1]])])
        same = np.concatenate([[0], np.cumsum(child[1:] == child[:-1])])
        for common, _, a, b in intervals(near):
            before = min(common, int(own_left[i[a]]))
            if before + GRAM + after[k] >= LENGTH and same[b] - same[a] < b - a:
                out.append(Repeat(before, int(after[k]), order[i[a : b + 1]]))
    return out


def occurrences(repeats: list[Repeat]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Member, and bytes before and after its gram, of each occurrence of the repeats."""
    if not repeats:
        return (np.zeros(0, np.int64),) * 3
    n = [len(r.members) for r in repeats]
    return np.concatenate([r.members for r in repeats]), np.repeat([r.before for r in repeats], n), np.repeat([r.after for r in repeats], n)


def _reach(rows: np.ndarray) -> np.ndarray:
    """Bytes before the first PAD of each row."""
    pad = rows == PAD
    return np.where(pad.any(axis=1), pad.argmax(axis=1), rows.shape[1])


# --- messages --------------------------------------------------------------------


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of one length, compressed, planes of bytes apart."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T if c.ndim == 1 else c).tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(struct.pack("<q", len(columns[0])) + b"".join(planes))


def _unpack(raw: bytes, kinds: str) -> list[np.ndarray]:
    """Columns of _pack(): q 64-bit, i 32-bit, c contexts."""
    data, at, out = zstandard.ZstdDecompressor().decompress(raw), 8, []
    n = struct.unpack_from("<q", data)[0]
    for k in kinds:
        width = {"q": 8, "i": 4, "c": 2 * REACH}[k]
        part = np.frombuffer(data, np.uint8, width * n, at)
        out.append(part.reshape(n, width) if k == "c" else np.ascontiguousarray(part.reshape(width, n).T).view(np.uint64 if k == "q" else np.uint32).reshape(-1))
        at += width * n
    return out


_MESSAGE = "shard long, kind int, chunk long, data binary"
_COLUMNS = ["shard", "kind", "chunk", "data"]
#: Kinds of messages and, after step 1, of rows: an anchor with its whole context; one to be compared in a tree; one whose strings are to be counted; a span as found; a string of LENGTH bytes; from REPEAT on, an occurrence of a repeat of so many bytes more.
ASKED, TREE, COUNT, SPAN, STRING, REPEAT = 0, 1, 2, 3, 4, 1000
_FULL, _HOT = 1, 2
#: Columns of the messages that go to shards, of which the first tells which.
_FIRST, _SECOND = {ASKED: "qqqii"}, {TREE: "qqic", COUNT: "qqii"}


def _by_shard(n_shards: int, kind: int, *columns: np.ndarray) -> Iterator[tuple[int, int, int, bytes]]:
    """One message to each shard (or group of shards) that the first column's hashes tell."""
    for s, at in dealt(_shard(columns[0], n_shards) % groups_for(n_shards)):
        yield s, kind, 0, _pack(*(c[at] for c in columns))


def _shard(hashes: np.ndarray, n_shards: int) -> np.ndarray:
    return (mix64(hashes) % np.uint64(n_shards)).astype(np.int64)


def _home(keys: np.ndarray, n_shards: int, kind: int, *columns: np.ndarray) -> list[tuple[int, int, int, bytes]]:
    """What a chunk has found out by itself, for any shard to hand on."""
    return [(int(keys[0] % np.uint64(n_shards)) % groups_for(n_shards), kind, 0, _pack(*(c.astype(np.uint64) for c in columns)))] if len(columns[0]) else []


def _again(n_shards: int, kinds: dict[int, str]):
    """What relayed() does with messages."""

    def again(kind: int, number: int, held: list[tuple[int, bytes]]) -> Iterator[tuple[int, int, int, bytes]]:
        if kind not in kinds:
            yield from ((number % n_shards, kind, 0, d) for _, d in held)
            return
        columns = [np.concatenate(c) for c in zip(*(_unpack(d, kinds[kind]) for _, d in held))]
        for s, at in dealt(_shard(columns[0], n_shards)):
            yield s, kind, 0, _pack(*(c[at] for c in columns))

    return again


def _spans(key: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of the ranges of each key."""
    if not len(key):
        return key, start.astype(np.int64), end.astype(np.int64)
    every, at = np.unique(key, return_inverse=True)
    far = np.int64(1) << 33
    a, b = united(start + at * far, end + at * far)
    return every[a // far], a % far, b % far


def _asked(key: np.ndarray, position: np.ndarray, gram: np.ndarray, around: np.ndarray, n_shards: int) -> tuple[np.ndarray, np.ndarray, list]:
    """Which anchors are known to be repeated as a whole, which are to be counted, and the messages that ask about the rest."""
    _, first, at, n = np.unique(around, return_index=True, return_inverse=True, return_counts=True)
    full = n[at] > 1
    g, gram_at = np.unique(gram[first], return_inverse=True)
    hot = np.bincount(gram_at, minlength=len(g))[gram_at] > CHUNK_MEMBERS  # by different context
    lead = np.ones(len(first), bool)
    if hot.any():  # one of a hot gram's contexts tells its shard
        once = np.unique(gram_at[hot], return_index=True)[1]
        lead[hot] = False
        lead[np.flatnonzero(hot)[once]] = True
    flag = (n > 1) * _FULL + hot * _HOT
    send = first[lead]
    rows = list(_by_shard(n_shards, ASKED, gram[send], around[send], key[send], position[send].astype(np.uint32), flag[lead].astype(np.uint32)))
    return full, first[hot], rows


def _answered(messages: list[bytes]) -> tuple[list, list, list]:
    """Step 1 in a shard: (key, position, context) of anchors repeated as a whole; (key, position, gram) to be compared in a tree, and to be counted."""
    if not messages:
        return [], [], []
    gram, around, key, position, flag = (np.concatenate(c) for c in zip(*(_unpack(m, "qqqii") for m in messages)))
    order = np.lexsort((flag & _FULL == 0, around, gram))
    gram, around, key, position, flag = gram[order], around[order], key[order], position[order], flag[order]
    new_gram = np.concatenate([[True], gram[1:] != gram[:-1]])
    new = new_gram | np.concatenate([[True], around[1:] != around[:-1]])
    context = np.cumsum(new) - 1
    full = (np.bincount(context)[context] > 1) | (flag & _FULL > 0)
    member = np.cumsum(new_gram) - 1
    contexts = np.bincount(member[new])[member]
    hot = np.bincount(member, flag & _HOT)[member] > 0
    go_on = new & ((contexts > 1) | hot)
    count = go_on & (hot | (contexts > TREE_MEMBERS)) & ~((flag & _HOT) > 0)  # hot leads are counted by their chunk
    tree = go_on & ~hot & (contexts <= TREE_MEMBERS)
    whole = full & (flag & _FULL == 0)
    return [(key[whole], position[whole], around[whole])], [(key[tree], position[tree], gram[tree])], [(key[count], position[count], gram[count])]


def _rows(kind: int, key: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"key": key.view(np.int64), "kind": np.full(len(key), kind, np.int32), "a": a.astype(np.int64), "b": b.view(np.int64) if b.dtype == np.uint64 else b.astype(np.int64)})


_ROWS = "key long, kind int, a long, b long"


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, list[bytes], list]]:
    """Keys, texts as bytes and need columns of about CHUNK_BYTES of text at a time."""
    keys, texts, needs, size = [], [], [], 0
    for batch in batches:
        for k, t, n in zip(batch.key, batch.text, batch.need if "need" in batch else [None] * len(batch)):
            raw = t.encode("utf-8", "surrogatepass") if t else b""
            if size and size + len(raw) > CHUNK_BYTES:
                yield np.array(keys, np.int64).view(np.uint64), texts, needs
                keys, texts, needs, size = [], [], [], 0
            keys.append(k)
            texts.append(raw)
            needs.append(n)
            size += len(raw)
    if keys:
        yield np.array(keys, np.int64).view(np.uint64), texts, needs


def _first(docs: DataFrame, n_shards: int, groups: bool = False) -> DataFrame:
    """Step 1 over docs (key, text): rows of _ROWS. With groups, anchors found within a chunk stand one by one, not as spans."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for keys, texts, _ in _chunks(batches):
            doc, at, gram, around = anchors(texts)
            if not len(doc):
                continue
            full, count, rows = _asked(keys[doc], at, gram, around, n_shards)
            if groups:
                rows += _home(keys, n_shards, STRING, keys[doc[full]], at[full], around[full])
            else:
                size = np.array([len(t) for t in texts])[doc]
                rows += _home(keys, n_shards, SPAN, *_spans(keys[doc[full]], np.maximum(at[full] - REACH, 0), np.minimum(at[full] + LENGTH, size[full])))
            rows += _home(keys, n_shards, COUNT, keys[doc[count]], at[count], gram[count])
            for k in range(0, len(rows), 64):
                yield pd.DataFrame(rows[k : k + 64], columns=_COLUMNS)

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        whole, tree, count = _answered(list(rows.data[rows.kind == ASKED]))
        out = [_rows(ASKED, *x) for x in whole] + [_rows(TREE, *x) for x in tree] + [_rows(COUNT, *x) for x in count]
        for kind, then in ((COUNT, COUNT), (SPAN, SPAN), (STRING, ASKED)):
            out += [_rows(then, *_unpack(d, "qqq")) for d in rows.data[rows.kind == kind]]
        return pd.concat(out) if out else _rows(SPAN, *(np.zeros(0, np.uint64),) * 3)

    return relayed(docs.mapInPandas(ask, _MESSAGE), n_shards, _again(n_shards, _FIRST), "repeat-asked").groupBy("shard").applyInPandas(answer, _ROWS)


def _second(docs: DataFrame, n_shards: int, groups: bool = False) -> DataFrame:
    """Steps 2 and 3 over docs (key, text, need: anchors as structs of kind, position and gram): spans as rows of _ROWS. With groups, occurrences one by one: a is where each begins, b tells its repeat."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for keys, texts, needs in _chunks(batches):
            kind, at, gram, owner, tops = [], [], [], [], []
            data, start = joined(texts)
            for i, need in enumerate(needs):
                kind += [x["kind"] for x in need]
                at += [x["a"] for x in need]
                gram += [x["b"] for x in need]
                owner += [i] * len(need)
            kind, at, owner = np.array(kind), np.array(at, np.int64), np.array(owner)
            gram = np.array(gram, np.int64).view(np.uint64)
            size = np.array([len(t) for t in texts])
            rows = []
            t = np.flatnonzero(kind == TREE)
            if len(t):
                sides = contexts(data, start[owner[t]] + at[t], at[t], size[owner[t]])
                rows += _by_shard(n_shards, TREE, gram[t], keys[owner[t]], at[t].astype(np.uint32), np.concatenate(sides, axis=1))
            for lo in range(0, int((kind == COUNT).sum()), 8192):
                c = np.flatnonzero(kind == COUNT)[lo : lo + 8192]
                place = start[owner[c]] + at[c]
                h = gram_hashes(data[place[:, None] - REACH + np.arange(LENGTH + REACH)])
                string = mix64(h[:, : REACH + 1] * np.uint64(7) + mix64(h[:, GRAM : GRAM + REACH + 1]))
                begin = at[c][:, None] - REACH + np.arange(REACH + 1)
                valid = (begin >= 0) & (begin + LENGTH <= size[owner[c]][:, None])
                string, begin, who = string[valid], begin[valid], np.broadcast_to(owner[c][:, None], valid.shape)[valid]
                # a string that stands around two anchors of one text is one occurrence
                _, once = np.unique(who * (np.int64(1) << 33) + begin, return_index=True)
                tops.append((string[once], begin[once], who[once]))
            if tops:
                string, begin, who = (np.concatenate(x) for x in zip(*tops))
                _, once = np.unique(who * (np.int64(1) << 33) + begin, return_index=True)
                string, begin, who = string[once], begin[once], who[once]
                _, first, where, n = np.unique(string, return_index=True, return_inverse=True, return_counts=True)
                full = n[where] > 1
                if groups:
                    rows += _home(keys, n_shards, STRING, keys[who[full]], begin[full], string[full])
                else:
                    rows += _home(keys, n_shards, SPAN, *_spans(keys[who[full]], begin[full], begin[full] + LENGTH))
                rows += _by_shard(n_shards, COUNT, string[first], keys[who[first]], begin[first].astype(np.uint32), (n > 1).astype(np.uint32))
            for k in range(0, len(rows), 64):
                yield pd.DataFrame(rows[k : k + 64], columns=_COLUMNS)

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        out = [_rows(SPAN, *_unpack(d, "qqq")) for d in rows.data[rows.kind == SPAN]] + [_rows(REPEAT + LENGTH, *_unpack(d, "qqq")) for d in rows.data[rows.kind == STRING]]
        trees = [_unpack(d, _SECOND[TREE]) for d in rows.data[rows.kind == TREE]]
        if trees:
            gram, key, at, around = (np.concatenate(c) for c in zip(*trees))
            repeats = maximal_repeats(gram, around[:, :REACH], around[:, REACH:])
            at = at.astype(np.int64)
            if groups:
                for k, r in enumerate(repeats):
                    name = mix64(gram[r.members[:1]] + mix64(np.array([k], np.uint64)))
                    out.append(_rows(REPEAT + r.length, key[r.members], at[r.members] - r.before, np.repeat(name, len(r.members))))
            else:
                who, before, after = occurrences(repeats)
                out.append(_rows(SPAN, *_spans(key[who], at[who] - before, at[who] + GRAM + after)))
        counts = [_unpack(d, _SECOND[COUNT]) for d in rows.data[rows.kind == COUNT]]
        if counts:
            string, key, begin, flag = (np.concatenate(c) for c in zip(*counts))
            _, where, n = np.unique(string, return_inverse=True, return_counts=True)
            hit = (n[where] > 1) & (flag == 0)
            begin = begin.astype(np.int64)[hit]
            out.append(_rows(REPEAT + LENGTH, key[hit], begin, string[hit]) if groups else _rows(SPAN, *_spans(key[hit], begin, begin + LENGTH)))
        return pd.concat(out) if out else _rows(SPAN, *(np.zeros(0, np.uint64),) * 3)

    return relayed(docs.mapInPandas(ask, _MESSAGE), n_shards, _again(n_shards, _SECOND), "repeat-contexts").groupBy("shard").applyInPandas(answer, _ROWS)


def _key(docs: DataFrame) -> Column:
    return F.xxhash64(docs["doc_id"].cast("string"), F.coalesce(docs["text"], F.lit("")))


def _found(docs: DataFrame, groups: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows of steps 1, and of 2 and 3."""
    short_batches(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_shards = max(1, math.ceil(total / SHARD_BYTES))
    keyed = docs.select(_key(docs).alias("key"), "text")
    found = stored(_first(keyed, n_shards, groups), "repeat-anchors")
    need = found.filter(F.col("kind").isin(TREE, COUNT)).groupBy("key").agg(F.collect_set(F.struct("kind", "a", "b")).alias("need"))
    # of rows equal in id and text one stands for all: their contexts are equal, step 1 has found them
    return found, stored(_second(keyed.join(need, "key"), n_shards, groups), "repeat-spans")


def repeats(docs: DataFrame) -> DataFrame:
    """All occurrences of the maximal repeats of LENGTH bytes or more: repeat (a number for each), length, doc_id, start.

    A repeat reaches at most REACH bytes beyond its anchor's gram; a longer passage is
    one for each of its anchors. Of anchors with one and the same whole context, which are
    a repeat of their own, one stands for all in the repeats shared with other contexts.
    Of rows equal in doc_id and text, each has its occurrences.
    """
    found, then = _found(docs.select("doc_id", "text"), True)
    by_key = docs.select(_key(docs).alias("key"), "doc_id", F.octet_length("text").alias("size"))
    start = F.greatest(F.col("a") - REACH, F.lit(0))
    one = found.filter(F.col("kind") == ASKED).distinct().join(by_key, "key").select(F.col("b").alias("repeat"), (F.least(F.col("a") + LENGTH, "size") - start).cast("int").alias("length"), "doc_id", start.alias("start"))
    two = then.filter(F.col("kind") > REPEAT).distinct().join(by_key, "key").select(F.col("b").alias("repeat"), (F.col("kind") - REPEAT).alias("length"), "doc_id", F.col("a").alias("start"))
    return one.unionByName(two)


def _with_spans(docs: DataFrame) -> DataFrame:
    """docs with __sd_spans, structs (a, b) of first and last-but-one byte of occurrences of repeats, not yet united."""
    found, spans = _found(docs)
    near = F.when(F.col("kind") == ASKED, F.greatest(F.col("a") - REACH, F.lit(0))).otherwise(F.col("a"))
    far = F.when(F.col("kind") == ASKED, F.col("a") + LENGTH).otherwise(F.col("b"))
    every = found.filter(F.col("kind").isin(ASKED, SPAN)).unionByName(spans).groupBy(F.col("key").alias("__sd_key")).agg(F.collect_set(F.struct(near.alias("a"), far.alias("b"))).alias("__sd_spans"))
    return docs.join(every, _key(docs) == F.col("__sd_key"), "left")


def removal(raw: bytes, spans: list | None) -> tuple[np.ndarray, np.ndarray]:
    """Maximal removed runs of a text from its spans."""
    if spans is None or not len(spans):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return united(np.array([s["a"] for s in spans], np.int64), np.minimum(np.array([s["b"] for s in spans], np.int64), len(raw)))


def _result(text: Column, spans: Column) -> Column:
    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    def done(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, every in batches:
            rows = []
            for t, s in zip(texts, every):
                raw = t.encode("utf-8", "surrogatepass") if t else b""
                a, b = removal(raw, s)
                digest, at = hashlib.sha256(), 0
                for x, y in zip(a.tolist(), b.tolist()):
                    digest.update(raw[at:x])
                    at = y
                digest.update(raw[at:])
                rows.append((len(raw), int((b - a).sum()), len(a), digest.hexdigest()))
            yield pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return done(text, spans)


def removed(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    narrow = docs.select("doc_id", "text")
    return _with_spans(narrow).select("doc_id", _result(F.col("text"), F.col("__sd_spans")).alias("r")).select("doc_id", "r.*")


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs with repeated strings cut out of text (bytes of a letter cut in two go); its columns are kept as they are."""

    @F.pandas_udf("string")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, every in batches:
            out = []
            for t, s in zip(texts, every):
                raw = t.encode("utf-8", "surrogatepass") if t is not None else b""
                a, b = removal(raw, s)
                keep = np.ones(len(raw), bool)
                for x, y in zip(a.tolist(), b.tolist()):
                    keep[x:y] = False
                out.append(None if t is None else np.frombuffer(raw, np.uint8)[keep].tobytes().decode("utf-8", "ignore"))
            yield pd.Series(out, dtype=object)

    both = _with_spans(docs)
    return both.select(*[cut(docs["text"], F.col("__sd_spans")).alias(c) if c == "text" else docs[c] for c in docs.columns])
