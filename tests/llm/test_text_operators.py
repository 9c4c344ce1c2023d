"""Quality, licences, decontamination, line dedup, string dedup, language model."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from helpers import LONG, SPACE, docs, lower, odd_rows, prose, sha
from pyspark.sql import functions as F

from tablewright.llm import decontamination, licenses, linededup, ngram, quality, suffixdedup
from tablewright.llm import queries as q

SF = "/root/testdata/sf0.001"


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


# --- quality ------------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    d = q.op1_quality(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").filter("held_out").toPandas()
    assert len(d) > 50 and (d.predicted == d.quality).mean() > 0.9
    assert d[d.quality == 1].predicted.mean() > 0.95


def test_quality_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (3, 1, 0), (11, 0, 1), (7, 1, 0), (99, 1, 0), (4, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    out = quality.scores(docs(spark, extra=True), labels).collect()
    assert len(out) == len(odd_rows()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out if r.doc_id is not None)
    none = quality.scores(docs(spark), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.scores(docs(spark, []), labels).count() == 0
    kept = quality.accepted(docs(spark, extra=True), labels)
    assert kept.columns == docs(spark, extra=True).columns


def plain_quality(rows, labels, threshold):
    """Scores worked out without Spark: sample, dictionaries, features and curve written out plainly."""
    import zstandard

    crc = lambda x: zlib.crc32(x.encode())
    label = {}
    for i, v in labels:
        if i is not None and v is not None:
            label[i] = min(v, label.get(i, v))
    text = {i: t for i, t in rows if i in label and t and len(t.encode()) <= quality.SAMPLE_BYTES // 8 and crc(str(i)) % 4 != 2}
    import hashlib

    sample = {}
    for fold in (0, 1):
        for v in (0, 1):
            room, order = quality.SAMPLE_BYTES, sorted((i for i in text if label[i] == v and (crc(f"fold:{i}") % 3 != 0) == fold), key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i))
            for i in order[: quality.SAMPLE_ROWS]:
                if len(text[i].encode()) <= room:
                    sample[i], room = (fold, v), room - len(text[i].encode())
    pieces = lambda t: [t.encode()[k : k + quality.BLOCK] for k in range(0, len(t.encode()), quality.BLOCK)]
    sides = []
    for v in (1, 0):
        known = zstandard.train_dictionary(quality.DICTIONARY_BYTES, [b for i in sorted(sample) if sample[i] == (1, v) for b in pieces(text[i])], k=256, d=8, level=quality.LEVEL)
        sides.append(zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=known, write_content_size=False, write_dict_id=False))

    def features(t):
        size = [sum(len(c.compress(b)) - len(c.compress(b"")) for b in pieces(t or "")) for c in sides]
        n = len((t or "").encode())
        return (size[1] - size[0]) / (n + 64), math.log((sum(size) + 32) / (2 * n + 32))

    curve = [i for i in sorted(sample) if sample[i][0] == 0]
    x, y = np.array([features(text[i]) for i in curve]), np.array([sample[i][1] for i in curve])
    scale = np.abs(x).max(axis=0)
    design, w = np.column_stack([x / scale, np.ones(len(x))]), np.zeros(3)
    for _ in range(500):  # gradient steps with the curvature's bound, slower than the operator's Newton steps
        p = 1 / (1 + np.exp(-design @ w))
        h = design.T @ (design * (p * (1 - p))[:, None]) + 1e-2 * np.eye(3)
        w = w + 0.7 * np.linalg.solve(h, design.T @ (y - p) - 1e-2 * w)
    score = lambda t: 1 / (1 + math.exp(-(np.array(features(t)) / scale @ w[:2] + w[2])))
    return {i: score(t) for i, t in rows}


def test_quality_against_a_plain_version(spark):
    sf = "/root/testdata/sf0.01"
    d, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    want = plain_quality([(r.doc_id, r.text) for r in d.collect()], [(r.doc_id, r.quality) for r in labels.collect()], 0.7)
    got = {r.doc_id: r.score for r in q.op1_quality(spark, sf).collect()}
    assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in got) < 1e-3


def test_a_document_that_stands_often_is_one_sample(spark):
    rows = [(1, f"text {i} " * 30, "", "", 0) for i in range(3000)] + [(i, prose(i, 60), "", "", 0) for i in range(2, 12)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 12)], "doc_id long, quality int, toxic int")
    sample = quality._sample(docs(spark, rows), labels, F.lit(True))
    assert len(sample) == 11 and min(f"text {i} " * 30 for i in range(3000)) in {t for _, t, _ in sample}


def test_quality_ignores_other_columns(spark):
    d, labels = docs(spark), spark.createDataFrame([(1, 1, 0), (11, 0, 1), (7, 1, 0), (12, 0, 0)], "doc_id long, quality int, toxic int")
    a = {r.doc_id: r.score for r in quality.scores(d, labels).collect()}
    b = {r.doc_id: r.score for r in quality.scores(d.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y")), labels).collect()}
    assert a == b


# --- licences -------------------------------------------------------------------


def test_licences(spark):
    mit = licenses.KNOWN[0][1]
    spelled = "MIT License\n\nCopyright (c) 2020 Some One\n\n" + mit.upper().replace("SUBLICENSE", "SUB-LICENCE").replace("NONINFRINGEMENT", "NON-INFRINGEMENT").replace(", ", " ,\n")
    rows = [(1, mit, "", "", 0), (2, spelled, "", "", 0), (3, mit + " and more", "", "", 0), (4, None, "", "", 0), (5, "", "", "", 0), (6, "released under the MIT licence", "", "", 0), (6, "released under the MIT licence", "", "", 0), (7, LONG, "", "", 0), (8, "Copyright 2020 Me", "", "", 0)]
    out = {r.doc_id: (r.license_id, r.is_license) for r in licenses.scanned(docs(spark, rows, extra=True)).collect()}
    assert out == {1: ("MIT", True), 2: ("MIT", True), 3: (None, False), 4: (None, False), 5: (None, False), 6: ("MIT", True), 7: (None, False), 8: (None, False)}
    assert licenses.scanned(docs(spark, rows)).count() == len(rows) and licenses.scanned(docs(spark, [])).count() == 0


def test_licences_on_lines_of_their_own(spark):
    mit = licenses.KNOWN[0][1]
    rows = [(1, "prose of some words\nReleased under the MIT licence.\n\nmore", "", "", 0), (2, "x\n" + mit.upper() + "\nLicensed under  CC-BY-NC 4.0\r\nReleased under the MIT License.", "", "", 0), (3, "we say: Released under the MIT License.", "", "", 0), (4, None, "", "", 0), (5, "Copyright 2020 Me\nlicense", "", "", 0), (6, mit, "", "", 0)]
    out = {r.doc_id: (r.license_id, r.license_lines) for r in licenses.scanned(docs(spark, rows, extra=True)).collect()}
    assert out == {1: (None, ["MIT"]), 2: (None, ["CC-BY-NC-4.0", "MIT"]), 3: (None, []), 4: (None, []), 5: (None, []), 6: ("MIT", ["MIT"])}
    # every known text has a mark in each of its forms
    import re

    assert all(re.search(licenses.MARKS, lower(t)) for _, t in licenses.KNOWN + licenses.whole_licenses())


def test_licence_lines_in_the_drivers_tables(spark):
    d = q.op6_license_digest(spark, "/root/testdata/sf0.01").filter("license_lines <> ''")
    assert d.count() > 30 and {x for r in d.collect() for x in r.license_lines.split(",")} == {"Apache-2.0", "MIT", "CC-BY-NC-4.0", "GPL-3.0"}


def test_whole_licences_and_licences_behind_a_notice(spark):
    whole = dict(licenses.whole_licenses())
    mit, bsd = licenses.KNOWN[0][1], licenses.KNOWN[3][1]
    full = next(t for i, t in licenses.whole_licenses() if i == "GPL-3.0")
    assert len(full) > 30_000
    texts = [("GPL-3.0", full), ("GPL-3.0", "  ".join(full.split("\n"))), ("MPL-2.0", whole["MPL-2.0"].upper()), ("CC0-1.0", whole["CC0-1.0"]), ("Apache-2.0", whole["Apache-2.0"]), (None, full[:20_000]),
             ("MIT", "Copyright (c) 2020 Some One " + mit), ("MIT", "MIT License Copyright (c) 2020 Some One. All rights reserved. " + mit), ("BSD-2-Clause", "© 2019 Ada B\nCopyright 2020 Some One " + bsd), (None, "Copyright (c) 2020 Some One " + mit + " and more"), (None, "Copyright 2020 Some One and others")]
    out = {r.doc_id: r.license_id for r in licenses.scanned(docs(spark, [(k, t, "", "", 0) for k, (_, t) in enumerate(texts)])).collect()}
    assert [out[k] for k in range(len(texts))] == [i for i, _ in texts]


def test_licences_are_native(spark, capsys):
    licenses.scanned(docs(spark)).explain()
    assert "Python" not in capsys.readouterr().out


# --- decontamination --------------------------------------------------------------


def plain_hits(texts, items, window=10):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    import re

    words = lambda t: re.findall(pattern, lower(t))
    where = collections.defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            where[tuple(w[k : k + window])].add("null" if i is None else str(i))
    out = []
    for t in texts:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in where}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in where:
                    hit.update(range(k, k + n))
                    found |= where[tuple(w[k : k + n])]
        out.append((len(w), len(hit), len(found), sha(",".join(sorted(found)).encode()), bool(hit)))
    return out


def test_decontamination(spark):
    items = [(1, prose(2, 40)), (2, "One, TWO"), (3, None), (4, "  "), (None, prose(1, 12)), (10, prose(2, 40)), (10, "x" * 700), (11, LONG)]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("hit", F.lit(1))
    got = decontamination.contamination(docs(spark, extra=True), bench).orderBy("doc_id").collect()
    rows = sorted(odd_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [tuple(r)[1:] for r in got] == plain_hits([r[1] for r in rows], items)
    none = decontamination.contamination(docs(spark), bench.limit(0)).collect()
    assert not any(r.contaminated for r in none)
    assert decontamination.contamination(docs(spark, []), bench).count() == 0
    clean = decontamination.decontaminated(docs(spark, extra=True), bench)
    assert clean.columns == docs(spark, extra=True).columns
    assert not any(r.contaminated for r in decontamination.contamination(clean, bench).collect())


def test_removal_spans(spark):
    text = "Héad: " + prose(2, 12).upper() + "! tail"
    bench = spark.createDataFrame([(1, prose(2, 12))], "item_id long, text string")
    out = decontamination.removal_spans(docs(spark, [(1, text, "", "", 0), (2, None, "", "", 0), (3, "none", "", "", 0)]), bench).collect()
    assert [(r.doc_id, text.encode()[r.start : r.stop].decode()) for r in out] == [(1, prose(2, 12).upper())]


def test_decontamination_in_blocks(spark, monkeypatch):
    items = [(i, prose(2, 300)[i * 30 : i * 30 + 200]) for i in range(20)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(decontamination.contamination(docs(spark), bench).collect(), key=repr)
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 600)
    assert sorted(decontamination.contamination(docs(spark), bench).collect(), key=repr) == one


def test_what_closes_up_is_searched_again(spark, monkeypatch):
    item = prose(2, 40).split()
    text = " ".join([*item[:6], *prose(3, 12).split(), *item[6:11], "end"])
    bench = spark.createDataFrame([(1, " ".join(item)), (2, prose(3, 12)), (3, prose(4, 5))], "item_id long, text string")
    rows = docs(spark, [(1, text, "", "", 0), (2, "whole text " * 20, "", "", 0), (3, prose(4, 5), "", "", 0), (4, None, "", "", 0)])
    for size in (4_000_000, 40):
        monkeypatch.setattr(decontamination, "BLOCK_BYTES", size)
        assert {r.doc_id: r.text for r in decontamination.decontaminated(rows, bench).collect()} == {1: "end", 2: "whole text " * 20, 4: None}


def test_shards_of_texts_are_indexed_whole(monkeypatch):
    """The index holds every word of its shard, and the answer doesn't depend on where shards end."""
    held = []
    index = decontamination.FMIndex
    monkeypatch.setattr(decontamination, "FMIndex", lambda text, starts: held.append(len(text)) or index(text, starts))
    phrases = decontamination.Phrases([("1", prose(2, 40)), ("2", "One, TWO")])
    texts = [decontamination.fold(r[1]) for r in odd_rows()]
    counts, found = phrases.find(texts)
    assert held == [sum(counts) + len(texts)]
    for t, n, f in zip(texts, counts, found):
        one = phrases.find([t])
        assert one[0] == [n] and one[1][0][0].tolist() == f[0].tolist() and one[1][0][1] == f[1]


def test_fm_index():
    rng = np.random.default_rng(1)
    seqs = [rng.integers(1, 5, rng.integers(1, 40)) for _ in range(30)]
    text = np.concatenate([np.append(s, 0) for s in seqs])
    starts = np.concatenate([[0], np.cumsum([len(s) + 1 for s in seqs])[:-1]])
    index = decontamination.FMIndex(text, starts)
    for n in (1, 2, 3, 5):
        for p in np.unique(rng.integers(1, 6, (20, n)), axis=0):
            lo, hi = index.search(p, np.array([0]), np.array([n]))
            rows = np.arange(lo[0], max(lo[0], hi[0]))
            assert sorted(index.locate(rows)) == [i for i in range(len(text) - n + 1) if (text[i : i + n] == p).all()]


# --- lines ----------------------------------------------------------------------


def plain_lines(rows):
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    order = lambda i: float("inf") if i is None else i
    hold = collections.defaultdict(set)
    for i, t, *_ in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 10:
                hold[key(x)].add(order(i))
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(hold[key(x)]) < 2 or min(hold[key(x)]) == order(i)]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept).encode())))
    return sorted(out, key=repr)


def line_rows():
    return odd_rows() + [(20 + i, "A common line here\n" + f"own line number {i}\nshort\n  a COMMON line here \r\n" + "shared by two " * (i < 2), "", "", 0) for i in range(6)]


def test_lines(spark):
    got = linededup.dropped_lines(docs(spark, line_rows(), extra=True))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_lines(line_rows())
    assert linededup.dropped_lines(docs(spark, [])).count() == 0
    kept = linededup.deduplicated(docs(spark, line_rows()))
    assert kept.columns == docs(spark).columns
    assert sorted((r.doc_id, sha(r.text.encode())) for r in kept.collect() if r.text is not None and r.doc_id) == sorted((r[0], r[3]) for r in plain_lines([x for x in line_rows()]) if r[0] and r[0] != 4)


def test_line_index_is_reversible(spark):
    d = docs(spark, line_rows())
    a, b, c = (d.filter(F.coalesce(F.col("doc_id"), F.lit(0)) % 3 == k) for k in (0, 1, 2))
    index, _ = linededup.LineIndex.empty(spark, 3).insert(a)
    before = sorted(map(repr, index.counts().collect()))
    grown, maybe = index.insert(b)
    exact = sorted(map(repr, grown.counts().collect()))
    assert sorted(map(repr, grown.counts(maybe).collect())) == [x for x in exact if x in set(map(repr, grown.counts(maybe).collect()))]
    held = {bytes(r.key) for r in maybe.collect()}
    new = {bytes(r.key) for r in grown._postings(b).collect()}
    assert {bytes(r.key) for r in grown.counts().collect()} & new <= held
    back = grown.delete(b.select("doc_id"))
    assert sorted(map(repr, back.counts().collect())) == before
    again, maybe = back.insert(c)
    assert {bytes(r.key) for r in again.counts().collect()} & {bytes(r.key) for r in again._postings(c).collect()} <= {bytes(r.key) for r in maybe.collect()}


def test_filters_decide_which_lines_meet_the_counts(spark, monkeypatch):
    """One row of a line that stands once in each of many documents is found by the filters' answers alone."""
    rows = [(i, f"a line of many documents\nown line number {i}", "", "", 0) for i in range(60)]
    assert sum(r.n_dropped for r in linededup.dropped_lines(docs(spark, rows)).collect()) == 59
    index, maybe = linededup.LineIndex.empty(spark, 2).insert(docs(spark, rows))
    assert maybe.count() <= 2 and index.counts().collect()[0].n == 60 and index.counted.count() > 60
    monkeypatch.setattr(linededup, "INCREMENTS", 1 << 30)  # each document an increment of its own
    assert sum(r.n_dropped for r in linededup.dropped_lines(docs(spark, rows)).collect()) == 59
    monkeypatch.setattr(linededup.CuckooFilter, "contains", lambda self, h: np.zeros(len(h), bool))
    assert sum(r.n_dropped for r in linededup.dropped_lines(docs(spark, rows)).collect()) == 0


def test_cuckoo_filter():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 1 << 63, 30_000).astype(np.uint64)
    f = linededup.CuckooFilter(100)
    for part in np.array_split(h, 7):
        f.insert(part)
    f = linededup.CuckooFilter.load(f.dump())
    assert f.contains(h).all() and f.contains(rng.integers(0, 1 << 63, 30_000).astype(np.uint64)).mean() < 0.005
    f.delete(h[:500])
    assert f.contains(h[500:]).all() and f.contains(h[:500]).mean() < 0.05


# --- repeated strings -------------------------------------------------------------


def plain_strings(texts, n=200):
    raws = [(t or "").encode() for t in texts]
    seen = collections.Counter(r[i : i + n] for r in raws for i in range(len(r) - n + 1))
    out = []
    for r in raws:
        cover = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - n + 1):
            if seen[r[i : i + n]] > 1:
                cover[i : i + n] = True
        c = cover[: len(r)]
        runs = int((c & ~np.concatenate([[False], c[:-1]])).sum()) if len(c) else 0
        out.append((len(r), int(c.sum()), runs, sha(np.frombuffer(r, np.uint8)[~c].tobytes())))
    return out


def string_rows():
    r, rows = random.Random(5), [x for x in odd_rows() if x[1] is None or len(x[1]) < 5000]
    shared = [prose(50 + i, 90) for i in range(4)]
    for i in range(60):
        cut, s = r.randint(0, 120), r.choice(shared)
        rows.append((100 + i, prose(200 + i, r.randint(0, 60)) + s[cut : cut + r.randint(150, 500)] + prose(300 + i, r.randint(0, 40)), "", "", 0))
    rows += [(300, "ab" * 400, "", "", 0), (301, "y" * 199, "", "", 0), (302, "y" * 200, "", "", 0), (303, "é" * 150 + "y" * 201, "", "", 0)]
    return rows


@pytest.mark.parametrize(("members", "tree", "chunk", "shard"), [(32, 4096, 4_000_000, 48_000_000), (1, 3, 3000, 5000), (2, 1, 500, 4000)])
def test_strings(spark, monkeypatch, members, tree, chunk, shard):
    for name, value in (("CHUNK_MEMBERS", members), ("TREE_MEMBERS", tree), ("CHUNK_BYTES", chunk), ("SHARD_BYTES", shard)):
        monkeypatch.setattr(suffixdedup, name, value)
    rows = string_rows()
    got = suffixdedup.removed(docs(spark, rows, extra=True)).collect()
    want = sorted(((r[0], *w) for r, w in zip(rows, plain_strings([r[1] for r in rows]))), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_strings_of_nothing(spark):
    assert suffixdedup.removed(docs(spark, [])).count() == 0
    assert suffixdedup.deduplicated(docs(spark, string_rows()[:5])).columns == docs(spark).columns


def test_common_prefix_intervals():
    words = sorted(["aab", "aac", "ab", "b", "ba", "bab"])
    lcp = np.array([-1] + [next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(words, words[1:])])
    got = {(d, lo, hi) for d, _, lo, hi in suffixdedup.intervals(lcp)}
    assert got == {(2, 0, 1), (1, 0, 2), (0, 0, 5), (2, 4, 5), (1, 3, 5)}


def test_maximal_repeats_have_all_occurrences():
    s = prose(9, 60).encode()[:260]
    texts = [b"q" * 120 + s + b"w" * 120, b"e" * 130 + s + b"r" * 130, b"t" * 140 + s + b"u" * 140]
    doc, at, gram, _ = suffixdedup.anchors(texts)
    data, start = suffixdedup.joined(texts)
    left, right = suffixdedup.contexts(data, start[doc] + at, at, np.array([len(t) for t in texts])[doc])
    repeats = suffixdedup.maximal_repeats(gram, left, right)
    assert repeats and all(set(doc[r.members]) == {0, 1, 2} and r.length >= 200 for r in repeats)
    for r in repeats:  # neither end can be moved on with the same occurrences, but where the contexts end
        ends = [(texts[d][a - r.before - 1], texts[d][a + 100 + r.after]) for d, a in zip(doc[r.members], at[r.members])]
        edge = [(left[m] == suffixdedup.PAD).argmax() if (left[m] == suffixdedup.PAD).any() else 100 for m in r.members], [(right[m] == suffixdedup.PAD).argmax() if (right[m] == suffixdedup.PAD).any() else 100 for m in r.members]
        assert (r.before == min(edge[0]) or len({x for x, _ in ends}) > 1) and (r.after == min(edge[1]) or len({x for _, x in ends}) > 1)


def plain_repeats(gram, left, right):
    """Sets of members that share so much before and after the gram, where nothing more is shared by all and no other member shares it."""
    out = set()
    for g in set(gram.tolist()):
        own = np.flatnonzero(gram == g)
        for i in own:
            for j in own[own > i]:
                b = int(np.argmax(np.append(left[i] != left[j], True)))
                d = int(np.argmax(np.append(right[i] != right[j], True)))
                for before, after in ((b, d),):
                    members = frozenset(k for k in own if (left[k][:before] == left[i][:before]).all() and (right[k][:after] == right[i][:after]).all())
                    if before + after >= suffixdedup.LENGTH - suffixdedup.GRAM:
                        out.add((before, after, members))
    return out


def test_maximal_repeats_against_all_pairs():
    rng = np.random.default_rng(11)
    for _ in range(30):
        n = int(rng.integers(2, 14))
        gram = rng.integers(0, 2, n).astype(np.uint64)
        base = rng.integers(97, 100, (2, 100)).astype(np.uint8)
        sides = [np.tile(base[k], (n, 1)) for k in (0, 1)]
        for side in sides:
            for i in range(n):
                side[i, rng.integers(0, 101) :] = rng.integers(97, 123)
        left, right = sides
        _, once = np.unique(np.concatenate([gram[:, None].astype(np.uint8), left, right], axis=1), axis=0, return_index=True)
        gram, left, right = gram[once], left[once], right[once]
        got = {(r.before, r.after, frozenset(r.members.tolist())) for r in suffixdedup.maximal_repeats(gram, left, right)}
        assert got == plain_repeats(gram, left, right)


def test_repeats_are_given_out_with_all_occurrences(spark):
    s = prose(9, 60)[:260]
    rows = [(i, "".join(random.Random(i).choice("klmnop") for _ in range(120)) + s + "".join(random.Random(-i - 1).choice("klmnop") for _ in range(90)), "", "", 0) for i in range(5)]
    rows += [(10, prose(12, 90), "", "", 0), (11, prose(12, 90), "", "", 0), (11, prose(12, 90), "", "", 0), (12, None, "", "", 0)]
    text = {r[0]: r[1] for r in rows}
    for members in (4096, 2):
        suffixdedup.TREE_MEMBERS, was = members, suffixdedup.TREE_MEMBERS
        try:
            out = suffixdedup.repeats(docs(spark, rows, extra=True)).toPandas()
        finally:
            suffixdedup.TREE_MEMBERS = was
        assert set(out.doc_id) == {0, 1, 2, 3, 4, 10, 11} and (out.length >= 200).all()
        for _, g in out.groupby("repeat"):
            assert len(g) > 1 and len({text[d][a : a + n] for d, a, n in zip(g.doc_id, g.start, g.length)}) == 1
        assert any(set(g.doc_id) == {0, 1, 2, 3, 4} for _, g in out.groupby("repeat"))
        assert any(sorted(g.doc_id) == [10, 11, 11] for _, g in out.groupby("repeat"))


def test_strings_beyond_the_shards_a_chunk_can_address(spark, monkeypatch):
    """More shards than 16 bits can number, reached through relays; what a chunk sends stays near the root of their number."""
    rows = string_rows()
    monkeypatch.setattr(suffixdedup, "SHARD_BYTES", 0.2)
    raws = [(r[1] or "").encode() for r in rows]
    n_shards = math.ceil(sum(map(len, raws)) / 0.2)
    assert n_shards > 1 << 16
    doc, at, gram, around = suffixdedup.anchors(raws)
    assert len(suffixdedup._asked(doc.astype(np.uint64), at, gram, around, n_shards)[2]) <= math.isqrt(n_shards) + 1
    got = suffixdedup.removed(docs(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(((r[0], *w) for r, w in zip(rows, plain_strings([r[1] for r in rows]))), key=repr)


# --- language model ----------------------------------------------------------------


def plain_model(rows):
    words = {k: [*__import__("re").findall(SPACE, lower(t)), "</s>"] for k, (_, t, *_) in enumerate(rows)}
    held = {k: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for k, (i, *_) in enumerate(rows)}
    c = collections.Counter(w for k in words if not held[k] for w in words[k])
    n, v = sum(c.values()), len(c)
    p1 = lambda w: (c[w] + 1) / (n + v + 1)
    two, three = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for k, w in words.items():
        for i in range(1, len(w) if not held[k] else 0):
            two[w[i - 1]][w[i]] += 1
            three[w[i - 2] if i > 1 else None, w[i - 1]][w[i]] += 1
    out = []
    for k, w in words.items():
        total = math.log10(p1(w[0]))
        for i in range(1, len(w)):
            p = p1(w[i])
            for below in (two.get(w[i - 1]), three.get((w[i - 2] if i > 1 else None, w[i - 1]))):
                if below:
                    t = sum(below.values())
                    p = max(below[w[i]] - ngram.DISCOUNT, 0) / t + ngram.DISCOUNT * len(below) / t * p
            total += math.log10(p)
        out.append((rows[k][0], held[k], len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), total))
    return out


@pytest.mark.parametrize(("head", "shard", "chunk"), [(1 << 17, 1_000_000, 4_000_000), (20, 500, 3000), (0, 2000, 500)])
def test_scores_match_a_plain_model(spark, monkeypatch, head, shard, chunk):
    for name, value in (("HEAD", head), ("SHARD_TOKENS", shard), ("CHUNK_BYTES", chunk), ("PART", 1e-9)):
        monkeypatch.setattr(ngram, name, value)
    monkeypatch.setattr(ngram.Vocabulary, "classes", lambda self: np.ones(len(self.counts), np.int64))
    rows = [r for r in odd_rows() if r[1] != LONG] + [(1000 + i, prose(i % 7, 30) + f" extra{i}", "", "", 0) for i in range(40)]
    got = sorted((tuple(r) for r in ngram.scores(docs(spark, rows, extra=True)).collect()), key=lambda r: (repr(r[0]), r[2]))
    want = sorted(plain_model(rows), key=lambda r: (repr(r[0]), r[2]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], abs=2 * ngram.STEP * w[2])


def test_frequent_contexts_in_classes_stay_a_distribution(monkeypatch):
    rng = np.random.default_rng(2)
    u, w = rng.integers(0, 5, 400).astype(np.uint32), rng.integers(0, 6, 400).astype(np.uint32)
    context = (np.uint64(3) << np.uint64(16)) + (u % 2).astype(np.uint64)
    p1 = np.full(7, -math.log10(7))
    every = np.array([(a, b) for a in range(5) for b in range(7)], np.uint32)
    tokens = ngram.Ranked(np.concatenate([context, (np.uint64(3) << np.uint64(16)) + (every[:, 0] % 2).astype(np.uint64)]), np.concatenate([u, every[:, 0]]), np.concatenate([w, every[:, 1]]), 7)
    trie = ngram.Trie.build(tokens, np.arange(435) < 400, p1)
    total = (10 ** trie.score(tokens, p1)[400:]).reshape(5, 7).sum(axis=1)
    assert np.abs(total - 1).max() < 1e-3


def test_model_beats_its_base_on_held_out_text(spark):
    d = q.op3_ngram(spark, "/root/testdata/sf0.01").filter("held_out").toPandas()
    assert d.score.sum() > d.base_score.sum()


def test_scores_of_nothing(spark):
    assert ngram.scores(docs(spark, [])).count() == 0


def test_elias_fano():
    rng = np.random.default_rng(4)
    for n, universe in ((1, 1), (5, 5), (1000, 1 << 40), (1000, 1500), (3000, 1 << 20)):
        v = np.sort(rng.choice(universe, n, replace=False) if universe < 1 << 21 else np.unique(rng.integers(0, universe, n)))
        ef = ngram.EliasFano.of(v, universe)
        assert (ef.at(np.arange(len(v))) == v.astype(np.uint64)).all()
        probe = np.sort(np.concatenate([v, rng.integers(0, universe + 5, 500)])).astype(np.uint64)
        want = np.array([np.searchsorted(v, x) if x in set(v.tolist()) else -1 for x in probe.tolist()])
        assert (ef.find(probe) == want).all()
    assert (ngram.EliasFano.of(np.zeros(0, np.uint64), 1).find(np.array([0, 1], np.uint64)) == -1).all()


def test_scores_beyond_the_shards_a_chunk_can_address(spark, monkeypatch):
    """As many shards as a corpus of 0.4 TB has: more than 16 bits can number, all reached through relays."""
    rows = [r for r in odd_rows() if r[1] != LONG] + [(1000 + i, f"rare{i % 9} " + " ".join(f"the {w} of" for w in prose(i % 7, 12).split()) + f" rare{i % 5} extra{i}", "", "", 0) for i in range(30)]
    want = sorted(plain_model(rows), key=lambda r: (repr(r[0]), r[2]))
    for name, value in (("HEAD", 20), ("SHARD_TOKENS", 0.02), ("CHUNK_BYTES", 3000), ("PART", 1e-4)):
        monkeypatch.setattr(ngram, name, value)
    marked = docs(spark, rows).withColumn("held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2)
    voc = ngram.vocabulary(ngram.counted(marked))
    assert voc.n_shards > 1 << 16 and voc.classes().max() > 1
    chunk = [r[1].encode() for r in rows if r[1]]
    messages = list(ngram._message_rows(list(range(len(chunk))), chunk, [False] * len(chunk), voc))
    assert len(messages) <= math.isqrt(voc.n_shards) + 2 and len(list(ngram._wanted_rows(chunk, [False] * len(chunk), voc))) <= 2 * math.isqrt(voc.n_shards) + 2
    got = sorted((tuple(r) for r in ngram.scores(docs(spark, rows)).collect()), key=lambda r: (repr(r[0]), r[2]))
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], abs=2 * ngram.STEP * w[2])


def test_children_are_found_between_their_parents_pointers():
    rng = np.random.default_rng(8)
    pair = np.unique(rng.integers(0, 40, 300) * 1000 + rng.integers(0, 1000, 300))
    parent, word = pair // 1000, pair % 1000
    level = ngram.Level.of(parent, word.astype(np.uint64), 45, np.zeros(len(pair), np.uint16))
    probe = np.unique(np.concatenate([pair, rng.integers(0, 45_000, 2000)]))
    want = np.array([np.searchsorted(pair, x) if x in set(pair.tolist()) else -1 for x in probe.tolist()])
    assert (level.find(probe // 1000, probe % 1000) == want).all()
    # a word's number alone means nothing: with the pointers of other parents it is another word or none
    level.pointers = ngram.EliasFano.of(np.minimum(np.searchsorted(parent, np.arange(46)) + 3, len(pair)), len(pair) + 1)
    assert (level.find(probe // 1000, probe % 1000) != want).sum() > 40


@pytest.mark.parametrize(("head", "shard", "chunk"), [(1 << 17, 500, 3000), (20, 500, 3000)])
def test_split_contexts_keep_the_counts_of_the_whole_word(spark, monkeypatch, head, shard, chunk):
    rows = [r for r in odd_rows() if r[1] != LONG] + [(1000 + i, " ".join(f"the {w} of" for w in prose(i % 7, 30).split()) + f" extra{i}", "", "", 0) for i in range(40)]
    want = sorted(plain_model(rows), key=lambda r: (repr(r[0]), r[2]))
    for name, value in (("HEAD", head), ("SHARD_TOKENS", shard), ("CHUNK_BYTES", chunk), ("PART", 20)):
        monkeypatch.setattr(ngram, name, value)
    marked = docs(spark, rows).withColumn("held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2)
    assert ngram.vocabulary(ngram.counted(marked)).classes().max() > 5
    got = sorted((tuple(r) for r in ngram.scores(docs(spark, rows, extra=True)).collect()), key=lambda r: (repr(r[0]), r[2]))
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and g[6] == pytest.approx(w[6], abs=2 * ngram.STEP * w[2])


def test_chunks_with_other_texts_are_not_taken_for_equal(spark):
    rows = [(None, t, "", "", 0) for t in ("one two three", "four one five", "six one two", "six one two")] + [(1, "one two one two", "", "", 0)]
    got = sorted((tuple(r) for r in ngram.scores(docs(spark, rows[:1]).union(docs(spark, rows[1:2])).union(docs(spark, rows[2:3])).union(docs(spark, rows[3:4])).union(docs(spark, rows[4:]))).collect()), key=repr)
    want = sorted(plain_model(rows), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(sorted(got, key=lambda r: (repr(r[0]), r[6])), sorted(want, key=lambda r: (repr(r[0]), r[6]))):
        assert g[6] == pytest.approx(w[6], abs=2 * ngram.STEP * w[2])
