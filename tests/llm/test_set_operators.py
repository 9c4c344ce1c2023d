"""Near-duplicates, mixing, sharding, top-k, the pipeline; and SQL for the queries that have it."""

import collections
import math
import random
import re

import duckdb
import numpy as np
import pytest
from helpers import LONG, SPACE, docs, lower, odd_rows, prose
from pyspark.sql import functions as F

import corpus_pipeline
from tablewright.llm import decontamination, minhash, mixing, quality, sharding, topk
from tablewright.llm import queries as q

SF = "/root/testdata/sf0.001"


# --- near-duplicates ------------------------------------------------------------


def shingle_set(t):
    w = re.findall(SPACE, lower(t))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain_components(rows):
    order = lambda i: float("inf") if i is None else i
    sets = [shingle_set(r[1]) for r in rows]
    root = {order(r[0]): order(r[0]) for r in rows}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    inverted = collections.defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            inverted[x].append(k)
    for k, s in enumerate(sets):
        for j, n in collections.Counter(j for x in s for j in inverted[x] if j > k).items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = sorted((top(order(rows[k][0])), top(order(rows[j][0]))))
                root[b] = a
    none = lambda x: None if x == float("inf") else x
    return sorted(((r[0], len(s), none(top(order(r[0]))), top(order(r[0])) == order(r[0])) for r, s in zip(rows, sets)), key=repr)


def copies():
    """Chains and stars of near copies, templates that share half their text, and short texts."""
    r, rows = random.Random(7), []
    base = prose(77, 200).split()
    for i in range(70):
        w = list(base)
        for _ in range(r.randint(0, 6)):
            w[r.randrange(len(w))] = f"w{r.random()}"
        rows.append((1000 + r.randrange(10_000) * 100 + i, " ".join(w), "", "", 0))
    chain = prose(78, 120).split()
    for i in range(25):
        chain = [*chain[5:], *prose(500 + i, 5).split()]
        rows.append((5_000_000 - i, " ".join(chain), "", "", 0))
    for i in range(40):
        rows.append((6_000_000 + i, " ".join(base[:100]) + " " + prose(900 + i, 90), "", "", 0))
    for i in range(30):
        rows.append((7_000_000 + i, " ".join(prose(79, 9).split()[: 3 + i % 7]), "", "", 0))
    return rows


@pytest.mark.parametrize(("rounds", "block", "size", "hot"), [(3, 256, 32_000_000, 1000), (0, 6, 32_000_000, 1000), (2, 256, 4000, 3)])
def test_components(spark, monkeypatch, rounds, block, size, hot):
    for name, value in (("PIVOT_ROUNDS", rounds), ("BLOCK", block), ("BLOCK_BYTES", size), ("HOT_ROWS", hot)):
        monkeypatch.setattr(minhash, name, value)
    rows = odd_rows() + copies()
    got = sorted((tuple(r) for r in minhash.near_duplicates(docs(spark, rows, extra=True)).collect()), key=repr)
    assert got == plain_components(rows)


def test_no_documents_and_one_of_each(spark):
    assert minhash.near_duplicates(docs(spark, [])).count() == 0
    kept = minhash.one_of_each(docs(spark, extra=True))
    assert kept.columns == docs(spark, extra=True).columns
    want = {r[0] for r in plain_components(odd_rows()) if r[3]}
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(want, key=repr)
    nameless = [(None, prose(1, 40), "", "", 0), (None, prose(2, 40), "", "", 0), (None, prose(2, 40), "", "", 0), (5, prose(1, 40), "", "", 0), (None, None, "", "", 0)]
    out = minhash.near_duplicates(docs(spark, nameless)).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in out), key=repr) == sorted([(None, 5, False), (None, None, True), (None, None, True), (5, 5, True), (None, None, True)], key=repr)
    assert minhash.one_of_each(docs(spark, nameless)).count() == 3


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 1500).astype(np.uint64)
    a, b = np.sort(pool[:1000]), np.sort(pool[500:])  # one third
    least, most = minhash.signatures(np.concatenate([a, b]), np.array([0, 1000, 2000]))
    same = np.mean([(least[0] == least[1]).mean(), (most[0] == most[1]).mean()])
    assert abs(same - 1 / 3) < 0.15
    assert minhash.bands(least, most).shape == (2, minhash.BANDS)


# --- mixing ---------------------------------------------------------------------


def test_water_filling(spark):
    sizes = {"a": 100, "b": 5, "c": 1000, "d": 0, "e": 7}
    s = spark.createDataFrame([(k, False, v) for k, v in sizes.items()] + [("", True, 50)], "src string, src_null boolean, source_size long")
    got = {(r.src, r.src_null): r.target for r in mixing.water_fill(s).collect()}
    names, weight = [*sizes, None], [5, 2, 1, 5, 2, 1]
    size = [*sizes.values(), 50]
    target, open_, left = [0.0] * 6, set(range(6)), float(sum(size))
    while True:
        share = left / sum(weight[i] for i in open_)
        over = {i for i in open_ if share * weight[i] >= 3 * size[i]}
        if not over:
            break
        for i in over:
            target[i] = 3.0 * size[i]
            left -= target[i]
        open_ -= over
    for i in open_:
        target[i] = share * weight[i]
    for n, t in zip(names, target):
        assert got[n or "", n is None] == pytest.approx(t)


def test_mix_of_odd_rows(spark):
    d = docs(spark, odd_rows() + [(100 + i, prose(i, 1 + i % 40), "", f"s{i % 3}", 0) for i in range(200)], extra=True)
    out = mixing.taken(d).collect()
    assert len(out) == d.count()
    by = collections.defaultdict(list)
    for r in out:
        assert r.taken <= 3 * r["size"] and r.taken % max(1, r["size"]) == 0
        by[r.source_size, r.target].append(r)
    for (size, target), rs in by.items():
        assert target <= 3 * size + 1e-9
        same = collections.Counter(r.doc_id for r in rs)
        assert abs(sum(r.taken for r in rs) - target) <= max(r["size"] * same[r.doc_id] for r in rs) / 2 + 1e-6
    assert sorted(map(repr, mixing.taken(d).collect())) == sorted(map(repr, out))
    mixed = mixing.mixed(d)
    assert mixed.columns == d.columns and mixed.count() == sum(r.copies for r in out)
    assert mixing.taken(docs(spark, [])).count() == 0
    nothing = mixing.taken(docs(spark, [(1, None, "", "a", 0), (2, "", "", "b", 0)])).collect()
    assert [(r["size"], r.taken, r.copies) for r in nothing] == [(0, 0, 1), (0, 0, 1)]


def test_no_row_is_repeated_above_the_cap(spark):
    """A clamped source takes each row max_epochs times, rows without words too."""
    d = docs(spark, [(i, "" if i % 2 else f"w{i} x", "", "small", 0) for i in range(40)] + [(100 + i, prose(i, 50), "", "z", 0) for i in range(40)])
    n = collections.Counter(r.doc_id for r in mixing.mixed(d).collect())
    assert max(n.values()) == 3 and {n[i] for i in range(40)} == {3}


def test_each_source_comes_near_its_target(spark):
    d = q.op8_mixing(spark, "/root/testdata/sf0.01").toPandas()
    d["source"] = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").toPandas().set_index("doc_id").source.reindex(d.doc_id).to_numpy()
    for _, g in d.groupby("source"):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= g["size"].max() / 2
    assert d.groupby("source").target.first().sum() == pytest.approx(d["size"].sum())


def test_mixing_is_native(spark, capsys):
    mixing.taken(docs(spark)).explain()
    assert "Python" not in capsys.readouterr().out


# --- sharding -------------------------------------------------------------------


def test_matrix_sums():
    counts = [0, 5, 100, 33, 1]
    m = sharding.communication_matrix(counts, 8)
    assert m.sum(axis=1).tolist() == counts and m.sum(axis=0).max() - m.sum(axis=0).min() <= 1
    assert (sharding.communication_matrix(counts, 8) == m).all()
    big = sharding.communication_matrix([10**10, 3 * 10**10], 3)
    assert big.sum(axis=1).tolist() == [10**10, 3 * 10**10] and (big >= 0).all() and np.ptp(big.sum(axis=0)) <= 1
    draws = np.array([sharding.communication_matrix([40, 60], 2, seed)[0, 0] for seed in range(2000)])
    assert abs(draws.mean() - 20) < 0.3 and abs(draws.var() - 40 * 0.25 * 60 / 99) < 0.6


def test_draws_by_inversion_follow_the_hypergeometric_law():
    for good, bad, c in ((5, 7, 4), (50, 40, 30), (3, 100, 60), (1000, 2000, 37)):
        got = np.bincount([sharding.inverted((k + 0.5) / 20_000, good, bad, c) for k in range(20_000)], minlength=c + 1) / 20_000
        want = [math.comb(good, k) * math.comb(bad, c - k) / math.comb(good + bad, c) for k in range(c + 1)]
        assert np.abs(got - want).max() < 1e-4
    draw = np.random.Generator(np.random.PCG64(1))
    big = np.array([sharding.hypergeometric(draw, 10**11, 3 * 10**11, 10**4) for _ in range(3000)])
    assert abs(big.mean() - 2500) < 4 and abs(big.var() / (10**4 * 0.25 * 0.75) - 1) < 0.1


@pytest.mark.parametrize("block", [20_000, 7])
def test_shards(spark, monkeypatch, block):
    monkeypatch.setattr(sharding, "BLOCK_ROWS", block)
    rows = odd_rows() + [(1000 + i, f"t{i % 50}", "", "", i) for i in range(300)]
    d = docs(spark, rows, extra=True)
    out = sharding.assignments(d).collect()
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in out), key=repr) == sorted(((r[0], len((r[1] or "").encode()) + 1, __import__("zlib").crc32((r[1] or "").encode())) for r in rows), key=repr)
    by = collections.defaultdict(list)
    for r in out:
        by[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    sizes = [len(by[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert sorted(map(repr, sharding.assignments(d).collect())) == sorted(map(repr, out))
    whole = sharding.sharded(d)
    assert whole.count() == len(rows) and set(whole.columns) == set(d.columns)


def test_order_is_shuffled(spark):
    d = docs(spark, [(i, f"t{i}", "", "", 0) for i in range(2000)])
    out = sharding.assignments(d).toPandas()
    assert abs(np.corrcoef(out.doc_id, out.slot)[0, 1]) < 0.1 and abs(np.corrcoef(out.doc_id, out.shard)[0, 1]) < 0.1
    few = sharding.assignments(docs(spark, [(1, "a", "", "", 0), (2, "b", "", "", 0)])).collect()
    assert sorted((r.shard, r.slot) for r in few) == [(0, 0), (1, 0)]
    assert sharding.assignments(docs(spark, [])).count() == 0


# --- top-k ----------------------------------------------------------------------


def plain_top(rows, is_query, k=10):
    ok = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (i, v) in enumerate(ok):  # every row is a query and a candidate of its own
        scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for other, (j, w) in enumerate(ok) if other != at and len(w) == len(v)) if is_query(i) else []
        out += [(i, n, j, -s) for n, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def vectors():
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 8).astype(np.float32)]) for i in range(1, 400)]
    rows += [(500 + i, rows[7][1]) for i in range(15)] + [(0, None), (600, [1.0, None] + [0.0] * 6), (601, [float("nan")] * 8), (602, [float("inf")] * 8), (None, [1.0] * 8), (700, [0.5, 0.25]), (701, [1.0, -2.0]), (703, []), (800, [0.0] * 8), (900, [1e3] * 8), (900, [1e3] * 8), (901, [1e4] * 8)]
    rows += [(100, [0.1] * 8), (100, [0.1] * 8), (100, [0.3] * 8)]
    return rows


@pytest.mark.parametrize(("shard", "leaf", "block", "step"), [(8192, 64, 32_000_000, 2048), (50, 4, 300, 2)])
def test_top_k(spark, monkeypatch, shard, leaf, block, step):
    for name, value in (("SHARD_ROWS", shard), ("LEAF", leaf), ("QUERY_BYTES", block), ("STEP_ROWS", step)):
        monkeypatch.setattr(topk, name, value)
    e = spark.createDataFrame(vectors(), "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    got = sorted(tuple(r) for r in topk.top_k(e, F.col("vec_id") % 100 == 0).collect())
    assert got == plain_top(vectors(), lambda i: i % 100 == 0)
    assert topk.top_k(e.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_subtrees_are_cut():
    """On clustered vectors most balls are neither opened nor bounded, and the answer is the full scan's."""
    rng = np.random.default_rng(6)
    centres = rng.normal(0, 1, (40, 8)) * 3
    v = topk.whole(list(np.repeat(centres, 50, axis=0) + rng.normal(0, 0.02, (2000, 8))))
    ids, k = np.arange(2000), 10
    best = topk.Best(ids[::100], v[::100], np.full(20, np.iinfo(np.int64).min + 1), k)
    best.search(ids, v)
    n_nodes = len(topk.BallTree(v).radii)
    assert best.opened < 0.35 * 20 * n_nodes and best.bounded < 0.6 * 20 * n_nodes
    score = topk.products(v[::100], v)
    for q in range(20):
        order = [c for c in np.lexsort((ids, -score[q])) if c != 100 * q][:k]
        assert best.row[q].tolist() == order and best.score[q].tolist() == score[q][order].tolist()


def test_products_stay_exact():
    a = topk.whole([np.array([1e6, 1e6])])
    assert topk.products(a, a)[0, 0] == 2 * (1024 * 10**6) ** 2
    b = topk.whole([np.array([1e18, -1e18])])
    assert topk.products(b, b)[0, 0] == np.iinfo(np.int64).max


# --- pipeline -------------------------------------------------------------------


def plain_cut(text, windows):
    """The text without words in any window, again until none is left, with its live pieces joined by a space."""
    raw = text.encode()
    gone = [False] * len(raw)
    pattern = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
    while True:
        words = []
        at = 0
        while at < len(raw):
            if gone[at]:
                at += 1
                continue
            end = at
            while end < len(raw) and not gone[end]:
                end += 1
            words += [(m.start() + at, m.end() + at, m[0].decode("utf-8", "surrogatepass")) for m in pattern.finditer(raw[at:end])]
            at = end
        low = [lower(w) for _, _, w in words]
        hit = set()
        for n in {len(x) for x in windows}:
            for k in range(len(low) - n + 1):
                if tuple(low[k : k + n]) in windows:
                    hit.update(range(k, k + n))
        if not hit:
            break
        for k in hit:
            piece_end = words[k][1]
            if k + 1 in hit and not any(gone[words[k][1] : words[k + 1][0]]):
                piece_end = words[k + 1][0]
            for x in range(words[k][0], piece_end):
                gone[x] = True
    if not any(gone):
        return text
    pieces = re.split(rb"\x00+", bytes(0 if g else c for g, c in zip(gone, raw)))
    return b" ".join(p for p in (x.strip(b" ") for x in pieces) if p).decode()


def test_pipeline_against_plain_steps(spark):
    """Every stage worked out without the operators, on the texts that the one before it leaves."""
    from test_text_operators import plain_quality

    sf = "/root/testdata/sf0.01"
    d = spark.read.parquet(f"{sf}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("labels", "benchmark"))
    out = corpus_pipeline.run(spark, sf).toPandas()
    rows = [tuple(r) for r in d.orderBy("doc_id").collect()]
    score = plain_quality([r[:2] for r in rows], [(r.doc_id, r.quality) for r in labels.collect()], quality.THRESHOLD)
    assert not any(abs(s - quality.THRESHOLD) < 1e-3 for s in score.values())  # else the two may differ by rounding
    rows = [r for r in rows if score[r[0]] >= quality.THRESHOLD]
    keep = {r[0] for r in plain_components(rows) if r[3]}
    rows = [r for r in rows if r[0] in keep]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = set()
    for r in bench.collect():
        w = words(r.text)
        windows |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9) if w else 0)}
    cut = [(r[0], plain_cut(r[1], windows), *r[2:]) for r in rows]
    assert any(a[1] != b[1] for a, b in zip(rows, cut))
    rows = [c for r, c in zip(rows, cut) if c[1] == r[1] or words(c[1])]
    text = {r[0]: r[1] for r in rows}
    assert all(text[i] == t for i, t in zip(out.doc_id, out.text))
    # the mix: targets by water-filling, rows by their seeded order
    sizes = {r[0]: len(re.findall(SPACE, r[1])) for r in rows}
    names = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    held = {s: sum(sizes[r[0]] for r in rows if r[3] == s) for s in names}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(held.values()))
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if share * weight[s] >= 3 * held[s]}
        for s in over or set(open_):
            target[s] = 3.0 * held[s] if over else share * weight[s]
            left -= target[s]
        open_ -= over or set(open_)
    got = collections.Counter(out.doc_id)
    for s in names:
        own = [r[0] for r in rows if r[3] == s]
        whole = int(target[s] // held[s])
        assert {got[i] - whole for i in own} <= {0, 1} and abs(sum(got[i] * sizes[i] for i in own) - target[s]) <= max(sizes[i] for i in own) / 2 + 1
        order = sorted(own, key=lambda i: __import__("hashlib").md5(f"{mixing.SEED}:{i}".encode()).hexdigest())
        extra = [got[i] - whole for i in order]
        assert extra == sorted(extra, reverse=True)  # those taken once more come first in the seeded order
    n = out.groupby("shard").slot.agg(["size", "max", "nunique"])
    assert len(n) == 8 and n["size"].max() - n["size"].min() <= 1 and (n["size"] == n["nunique"]).all() and (n["max"] == n["size"] - 1).all()


def test_stage_columns_and_odd_rows(spark):
    d = docs(spark, odd_rows() + copies(), extra=True).drop("shard", "slot")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, d, SF)
        if name != "sharding":
            assert out.columns == d.columns and out.schema.simpleString() == d.schema.simpleString()
        assert stage(spark, d.limit(0), SF).count() == 0
        out.count()


# --- SQL ------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "labels"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = q.queries()[name](spark, SF)
    rel = con.execute(q.oracle_sql()[name])
    names = [c[0] for c in rel.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    want = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in rel.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr) == want


def test_every_operator_is_registered():
    names = q.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10


def test_lengths():
    assert len(LONG) > 300_000
