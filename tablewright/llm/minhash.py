"""Near-duplicates by min-max hashing, confirmed on full shingle sets, as connected components.

Each text's set of distinct 5-word shingles is hashed under PERMUTATIONS permutations, of
which both the minimum and the maximum are kept: twice as many signature values as hash
evaluations. A band holds two minima and two maxima of four permutations, so that its
values are independent; two sets with similarity 0.75 share none of the 36 bands with
probability 1.1e-6.

Texts with equal sets form a class; only its representative (smallest doc_id) goes on,
and all steps below work on representatives. Buckets with more members than HOT_ROWS, and than
one in HOT_SHARE of all band rows, are hot: no more than HOT_SHARE of them can be, so their
list goes to all tasks, and wherever members meet something of their bucket, a hot one's are
dealt into SALTS parts. In every band's bucket one member is the pivot; the others are tested against it unless they are in its component by now. A test
compares whole sets. A first round tests each member against its smallest pivot only;
PIVOT_ROUNDS more rounds take pivot after pivot out of the buckets whose members are
still of several components. Buckets that remain so - many members, few links - are
compared in blocks of about BLOCK members or BLOCK_BYTES of their sets, pairs of blocks apart, and each such task
returns a spanning forest of its links. So every pair that shares a bucket is tested or
found connected; no bucket has a cap, no task holds a whole bucket, no step emits all
pairs of a bucket. Components are found by minimum labels over verified links, in tables
of the shared folder.

Defined cases: a text without words, or null, has the empty set and no links; fewer than
five words are one shingle; rows that share a doc_id are one document; rows without one
are documents by their text and count as larger than all others (their component_id is
null unless one with an id is in it); extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.llm.common import lean, mix64, short_batches, stored
from tablewright.llm.tokens import slices, word_hashes

WORDS = 5
#: Similarity from which documents are linked, as a fraction.
LEAST = (75, 100)
PERMUTATIONS, BANDS = 72, 36
PIVOT_ROUNDS = 3
#: Members and bytes of sets that are compared block against block in one task, and members tested against one pivot there.
BLOCK, BLOCK_BYTES, TESTED = 256, 32_000_000, 48
#: Members from which a bucket may be hot, share of all band rows from which it is, and parts into which it is dealt.
HOT_ROWS, HOT_SHARE, SALTS = 1000, 4096, 32
#: Rows without doc_id get numbers from here on, from a hash of their text.
_NULLS = 1 << 62

_MULTIPLY = (mix64(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_FLIP = (mix64(np.arange(1001, PERMUTATIONS + 1001, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_PLACES = mix64(np.arange(2001, 2001 + WORDS, dtype=np.uint64)) | np.uint64(1)


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of texts, and where each text's begin and end; repeats stay."""
    words, first = word_hashes(texts)
    count = np.diff(first)
    n = np.where(count >= WORDS, count - WORDS + 1, (count > 0).astype(np.int64))
    begin = np.concatenate([[0], np.cumsum(n)])
    at = np.repeat(first[:-1] - begin[:-1], n) + np.arange(begin[-1])
    size = np.minimum(np.repeat(count, n), WORDS)
    out = size.astype(np.uint64)
    for k in range(WORDS):
        inside = size > k
        out = out + np.where(inside, words[np.minimum(at + k, max(0, len(words) - 1))] * _PLACES[k], np.uint64(0)) if len(words) else out
    return mix64(out), begin


def distinct(hashes: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct hashes, sorted, and where they begin and end."""
    parts = [np.unique(hashes[a:b]) for a, b in zip(begin[:-1], begin[1:])]
    return (np.concatenate(parts) if parts else hashes), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def signatures(sets: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minima and maxima of non-empty sets under each permutation: two arrays (sets, permutations)."""
    low = (sets >> np.uint64(32)).astype(np.uint32)
    least, most = np.empty((PERMUTATIONS, len(begin) - 1), np.uint32), np.empty((PERMUTATIONS, len(begin) - 1), np.uint32)
    for i in range(PERMUTATIONS):
        y = (low ^ _FLIP[i]) * _MULTIPLY[i]
        y ^= y >> np.uint32(15)
        y *= np.uint32(0x2C1B3C6D)
        least[i], most[i] = np.minimum.reduceat(y, begin[:-1]), np.maximum.reduceat(y, begin[:-1])
    return least.T, most.T


def bands(least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Band hashes (sets, BANDS): band b takes two minima and, half way round, two maxima."""
    out = np.empty((len(least), BANDS), np.int64)
    for b in range(BANDS):
        i, j = 2 * b, (2 * b + PERMUTATIONS // 2) % PERMUTATIONS
        h = np.full(len(least), b, np.uint64)
        for value in (least[:, i], least[:, i + 1], most[:, j], most[:, j + 1]):
            h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + value + np.uint64(1))
        out[:, b] = h.view(np.int64)
    return out


def _raw(texts: pd.Series) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]


def described(text: Column) -> Column:
    """struct(n_shingles, mark: digest of the set, bands); mark and bands are null for the empty set."""

    @F.pandas_udf("n_shingles long, mark binary, bands array<long>")
    def done(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in lean(batches):
            raw, parts = _raw(texts), []
            for a, b in slices(raw):
                sets, begin = distinct(*shingles(raw[a:b]))
                n = np.diff(begin)
                marks, keys = np.full(b - a, None, object), np.full(b - a, None, object)
                full = np.flatnonzero(n)
                if len(full):
                    edges = np.concatenate([begin[:-1][full], [len(sets)]])
                    one = np.add.reduceat(mix64(sets ^ np.uint64(0x5851F42D4C957F2D)), edges[:-1])
                    two = np.bitwise_xor.reduceat(mix64(sets + np.uint64(0x14057B7EF767814F)), edges[:-1])
                    marks[full] = [x.tobytes() for x in np.stack([one, two, n[full].astype(np.uint64)], 1)]
                    keys[full] = list(bands(*signatures(sets, edges)))
                parts.append(pd.DataFrame({"n_shingles": n, "mark": marks, "bands": keys}))
            yield pd.concat(parts, ignore_index=True)

    return done(text)


def set_of(text: Column) -> Column:
    """A text's sorted distinct shingle hashes as binary."""

    @F.pandas_udf("binary")
    def done(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in lean(batches):
            raw, out = _raw(texts), []
            for a, b in slices(raw):
                sets, begin = distinct(*shingles(raw[a:b]))
                out += [sets[i:j].tobytes() for i, j in zip(begin[:-1], begin[1:])]
            yield pd.Series(out, dtype=object)

    return done(text)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets reach the least similarity."""
    if min(len(a), len(b)) * LEAST[1] < LEAST[0] * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return LEAST[1] * common >= LEAST[0] * (len(a) + len(b) - common)


def _fits(n: Column, m: Column) -> Column:
    return F.least(n, m) * LEAST[1] >= F.greatest(n, m) * LEAST[0]


def _parts(n_rows: Column, n_hashes: Column, rows: int) -> Column:
    """Parts into which so many sets with so many hashes are dealt, by number and by bytes; at least one."""
    return F.greatest(F.ceil(n_rows / rows), F.ceil(n_hashes / (BLOCK_BYTES // 8)), F.lit(1).cast("long"))


def _tested(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs (pivot, node, n: size of the node's set) whose sets are linked, as (a, b). A pivot's members are dealt into groups of about TESTED, or of BLOCK_BYTES.

    The pairs are stored first: their size is then known where they meet the sets, and a few pairs don't move all sets.
    """
    pairs = stored(pairs, "near-pairs")
    parts = pairs.groupBy("pivot").agg(_parts(F.count("*"), F.sum("n"), TESTED).alias("parts"))
    dealt = pairs.join(parts, "pivot").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    dealt = stored(dealt.select("pivot", "part", "node"), "near-dealt")
    member = dealt.join(sets, "node").select("pivot", "part", "node", "set")
    lead = stored(dealt.select("pivot", "part").distinct(), "near-leads").join(sets.withColumnRenamed("node", "pivot"), "pivot").select("pivot", "part", F.lit(None).cast("long").alias("node"), "set")

    def test(rows: pd.DataFrame) -> pd.DataFrame:
        of = [np.frombuffer(s, np.uint64) for s in rows.set]
        is_lead = rows.node.isna().to_numpy()
        leads = [of[i] for i in np.flatnonzero(is_lead)]
        good = [i for i in np.flatnonzero(~is_lead) if any(linked(x, of[i]) for x in leads)]
        return pd.DataFrame({"a": rows["pivot"].iloc[good], "b": rows.node.iloc[good].astype(np.int64)})

    return member.unionByName(lead).groupBy("pivot", "part").applyInPandas(test, "a long, b long")


def _forest(ids: np.ndarray, sets: list[np.ndarray], labels: np.ndarray, side: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links between members of two sides (or within one), beyond those that labels tell."""
    root = {x: x for x in labels.tolist()}

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    size = np.array([len(s) for s in sets])
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    group = np.cumsum(np.concatenate([[True], every[1:] != every[:-1]])) - 1
    shared = np.bincount(group)[group] > 1
    common = np.zeros((len(sets), len(sets)), np.float32)
    group, owner = group[shared], owner[shared]
    if len(group):
        columns = np.unique(group, return_inverse=True)[1]
        for lo in range(0, int(columns.max()) + 1, 4096):
            here = (columns >= lo) & (columns < lo + 4096)
            held = np.zeros((len(sets), 4096), np.float32)
            held[owner[here], columns[here] - lo] = 1
            common += held @ held.T
    common = common.astype(np.int64)
    i, j = np.nonzero(np.triu(LEAST[1] * common >= LEAST[0] * (size[:, None] + size[None, :] - common), 1))
    out = []
    across = (side[i] != side[j]) | (side.min() == side.max())
    for x, y in zip(i[across].tolist(), j[across].tolist()):
        u, v = top(int(labels[x])), top(int(labels[y]))
        if u != v:
            root[max(u, v)] = min(u, v)
            out.append((int(ids[x]), int(ids[y])))
    return out


def _in_blocks(left: DataFrame, labels: DataFrame, sets: DataFrame, hot: DataFrame) -> DataFrame:
    """Links (a, b) among the members (band, salt, node) of buckets, block against block.

    A bucket's members outside its largest component are compared among themselves and
    with that component's, whose members need no comparison with each other.
    """
    known = left.join(labels.select("node", "label", F.col("n").alias("size")), "node")
    by_label = known.groupBy("band", "label").agg(F.count("*").alias("n"), F.sum("size").alias("hashes"))
    size = by_label.groupBy("band").agg(F.max(F.struct("n", -F.col("label"), "hashes", "label")).alias("major"), F.sum("n").alias("n"), F.sum("hashes").alias("hashes"))
    blocks = lambda n, hashes: _parts(n, hashes * 2, BLOCK // 2)
    size = size.select("band", F.col("major.label").alias("major"), blocks(F.col("major.n"), F.col("major.hashes")).alias("majors"), blocks(F.col("n") - F.col("major.n"), F.col("hashes") - F.col("major.hashes")).alias("minors"))
    dealt = _beside(known, size, hot).withColumn("is_major", F.col("label") == F.col("major"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.when(F.col("is_major"), F.col("majors")).otherwise(F.col("minors"))))
    to = lambda n, at: F.transform(F.sequence(F.lit(0).cast("long"), n - 1), at)
    pair = lambda x, y, kind: F.struct(x.alias("x"), y.alias("y"), F.lit(kind).alias("kind"))
    mixed = F.when(F.col("is_major"), to(F.col("minors"), lambda o: pair(o, F.col("block"), 1))).otherwise(to(F.col("majors"), lambda o: pair(F.col("block"), o, 1)))
    same = F.when(~F.col("is_major"), to(F.col("minors"), lambda o: pair(F.least(o, F.col("block")), F.greatest(o, F.col("block")), 0))).otherwise(F.array().cast("array<struct<x:bigint,y:bigint,kind:int>>"))
    rows = dealt.withColumn("at", F.explode(F.concat(mixed, same))).select("band", "at", "label", F.when(F.col("at.kind") == 1, F.col("is_major").cast("long")).otherwise(F.col("block")).alias("side"), "node")
    rows = stored(rows, "near-blocks").join(sets, "node")

    def test(rows: pd.DataFrame) -> pd.DataFrame:
        edges = _forest(rows.node.to_numpy(), [np.frombuffer(s, np.uint64) for s in rows.set], rows.label.to_numpy(), rows.side.to_numpy())
        return pd.DataFrame(edges, columns=["a", "b"], dtype=np.int64)

    return rows.groupBy("band", "at").applyInPandas(test, "a long, b long")


def relabelled(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """labels (node, label, ...) after each node has the smallest label that edges (a, b) lead to."""
    if not edges.take(1):
        return labels
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    of = lambda side: labels.select(F.col("node").alias(side), F.col("label").alias(f"of_{side}"))
    links = stored(both.join(of("a"), "a").join(of("b"), "b").filter("of_a <> of_b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b")).distinct(), "near-links")
    now = links.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node"))
    while True:
        heard = links.join(now.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("heard"))
        nearer = now.join(heard, "node").select("node", F.col("label").alias("was"), F.least("label", "heard").alias("label"))
        jump = nearer.select(F.col("node").alias("label"), F.col("label").alias("far"))
        now = stored(nearer.join(jump, "label").select("node", F.least("label", "far").alias("label"), (F.least("label", "far") < F.col("was")).alias("moved")), "near-labels")
        if not now.filter("moved").take(1):
            break
        now = now.drop("moved")
    moved = now.select(F.col("node").alias("label"), F.col("label").alias("new"))
    rest = [c for c in labels.columns if c not in ("node", "label")]
    return stored(labels.join(moved, "label", "left").select("node", F.coalesce("new", "label").alias("label"), *rest), "near-labels")


def _beside(members: DataFrame, buckets: DataFrame, hot: DataFrame) -> DataFrame:
    """members (band, salt, ...) with the columns of their buckets (band, ...); a hot bucket's row stands once a salt."""
    salts = F.explode(F.sequence(F.lit(0), F.when(F.col("is_hot"), SALTS - 1).otherwise(0)))
    every = buckets.join(F.broadcast(hot), "band", "left").withColumn("salt", salts).drop("is_hot")
    return members.join(every, ["band", "salt"])


def _number(docs: DataFrame) -> Column:
    """doc_id as long, with a number of its own for each text without one."""
    return F.coalesce(docs["doc_id"].cast("long"), F.lit(_NULLS) + F.shiftrightunsigned(F.xxhash64(docs["text"]), 2))


def components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each row of docs, doc_id as in _number()."""
    short_batches(docs.sparkSession)
    rows = docs.select(_number(docs).alias("doc_id"), docs["text"])
    each = stored(rows.select("doc_id", described(F.col("text")).alias("d")).select("doc_id", "d.*"), "near-signatures")
    classes = stored(each.filter("mark is not null").groupBy("mark").agg(F.min("doc_id").alias("node"), F.min(F.struct("doc_id", "bands"))["bands"].alias("bands"), F.first("n_shingles").alias("n")), "near-classes")
    band_rows = classes.select("node", F.explode("bands").alias("band"))
    full = band_rows.groupBy("band").agg(F.min("node").alias("pivot"), F.max("node").alias("last"), F.count("*").alias("members")).filter("pivot < last").select("band", "pivot", "members")
    full = stored(full, "near-bands")
    limit = max(HOT_ROWS, classes.count() * BANDS // HOT_SHARE)
    hot = stored(full.filter(F.col("members") > limit).select("band", F.lit(True).alias("is_hot")), "near-hot")  # at most HOT_SHARE rows
    salted = band_rows.join(F.broadcast(hot), "band", "left").withColumn("salt", F.when(F.col("is_hot"), F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).otherwise(0)).drop("is_hot")
    members = stored(_beside(salted, full.drop("members"), hot).select("band", "salt", "node", "pivot"), "near-buckets")
    suspects = stored(members.select("node").distinct(), "near-suspects")  # a few ids, known to be so, don't move all texts
    sets = stored(rows.join(suspects, rows["doc_id"] == suspects["node"]).select("node", set_of(F.col("text")).alias("set")), "near-sets")
    labels = stored(classes.join(suspects, "node").groupBy("node").agg(F.min("n").alias("n"), F.max("n").alias("most")).withColumn("label", F.col("node")), "near-labels")
    sized = labels.select("node", "n", "most")
    fits = _fits(F.col("n"), F.col("pivot_n")) | (F.col("n") < F.col("most"))
    nearest = members.filter("node <> pivot").groupBy("node").agg(F.min("pivot").alias("pivot"))
    pairs = nearest.join(sized, "node").join(sized.select(F.col("node").alias("pivot"), F.col("n").alias("pivot_n")), "pivot").filter(fits)
    labels = relabelled(labels, stored(_tested(pairs.select("pivot", "node", F.col("most").alias("n")), sets), "near-links"))
    left = members.select("band", "salt", "node")
    for _ in range(PIVOT_ROUNDS):
        known = left.join(labels, "node")
        open_ = known.groupBy("band").agg(F.min(F.struct("node", "label", "n")).alias("p"), F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi")
        open_ = stored(open_, "near-open")
        known = stored(_beside(known, open_, hot).filter("node <> p.node").select("band", "salt", "node", "label", "n", "most", F.col("p.node").alias("pivot"), F.col("p.label").alias("pivot_label"), F.col("p.n").alias("pivot_n")), "near-buckets")
        left = known.select("band", "salt", "node")
        if not known.take(1):
            break
        pairs = known.filter((F.col("label") != F.col("pivot_label")) & fits).select("pivot", "node", F.col("most").alias("n")).distinct()
        labels = relabelled(labels, stored(_tested(pairs, sets), "near-links"))
    known = left.join(labels.select("node", "label"), "node")
    open_ = known.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("band")
    open_ = stored(open_, "near-open")
    rest = stored(_beside(left, open_, hot), "near-buckets")
    if rest.take(1):
        labels = relabelled(labels, stored(_in_blocks(rest, labels, sets, hot), "near-links"))
    of_class = classes.select("mark", "node").join(labels.select("node", "label"), "node", "left").select("mark", F.coalesce("label", "node").alias("label"))
    return each.join(of_class, "mark", "left").select("doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("component_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id, kept."""
    out = components(docs)
    null = lambda c: F.when(F.col(c) < _NULLS, F.col(c)).alias(c)
    return out.select(null("doc_id"), "n_shingles", null("component_id"), (F.col("doc_id") == F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is the smallest of their component, as they are; of rows that repeat such an id, one."""
    each = stored(components(docs).groupBy("doc_id").agg(F.min("component_id").alias("component_id"), F.count("*").alias("n_rows")), "near-components")
    number, row = _number(docs), F.xxhash64(*[docs[f.name] for f in docs.schema.fields if "map<" not in f.dataType.simpleString()])
    odd = stored(each.filter("doc_id <> component_id or n_rows > 1").select(F.col("doc_id").alias("__nd_id")), "near-odd")
    many = stored(each.filter("doc_id = component_id and n_rows > 1").select(F.col("doc_id").alias("__nd_id")), "near-many")
    once = F.row_number().over(W.partitionBy("__nd_id").orderBy("__nd_row"))
    first = docs.withColumns({"__nd_id": number, "__nd_row": row}).join(many, "__nd_id", "left_semi").withColumn("__nd_place", once).filter("__nd_place = 1")
    return docs.join(odd, number == F.col("__nd_id"), "left_anti").unionByName(first.select(*docs.columns))
