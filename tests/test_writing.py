"""Merging, the store, load modes, hooks, metrics, streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablewright.errors import WriterError
from tablewright.operators import merge
from tablewright.plans import compiler, config, metrics, registry, writer
from tablewright.streaming import writes


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def slices(spark):
    t = spark.createDataFrame([(1, "a", None), (2, "b", 5), (3, None, 7)], "k int, s string, n int")
    s = spark.createDataFrame([(2, "b", 6), (3, "x", None), (4, "d", 1)], "k int, s string, n int")
    return t, s


@pytest.mark.parametrize("strategy", ["update_all", "update_changed", "insert_only", "accumulating"])
def test_merging_twice_changes_nothing(slices, strategy):
    t, s = slices
    spec = merge.MergeSpec(("k",), strategy, milestones=("n",))
    once = merge.merge(t, s, spec)
    assert rows(merge.merge(once, s, spec)) == rows(once)


def test_changes_are_null_safe(spark):
    t = spark.createDataFrame([(1, "a", None)], "k int, x string, y string")
    s = spark.createDataFrame([(1, None, "a")], "k int, x string, y string")
    assert merge.classified(t, s, merge.MergeSpec(("k",), "update_changed")).collect()[0]._class == "update"


def test_versions(spark):
    spec = merge.MergeSpec(("k",), "scd_type2", as_of="2024-02-01")
    t = spark.createDataFrame([(1, "a", "2024-01-01", None, True), (2, "b", "2024-01-01", None, True), (3, "old", "2023-01-01", "2023-06-01", False)], "k int, v string, valid_from string, valid_to string, is_current boolean")
    s = spark.createDataFrame([(1, "a"), (2, "B"), (3, "back"), (4, "new")], "k int, v string")
    once = merge.merge(t, s, spec)
    assert rows(once) == sorted(
        [(1, "a", "2024-01-01", None, True), (2, "b", "2024-01-01", "2024-02-01", False), (2, "B", "2024-02-01", None, True), (3, "old", "2023-01-01", "2023-06-01", False), (3, "back", "2024-02-01", None, True), (4, "new", "2024-02-01", None, True)],
        key=repr,
    )
    assert rows(merge.merge(once, s, merge.MergeSpec(("k",), "scd_type2", as_of="2024-03-01"))) == rows(once)


def test_bad_keys_are_refused(spark):
    spec = merge.MergeSpec(("k",))
    for data in ([(None,)], [(1,), (1,)]):
        with pytest.raises(WriterError, match="null or repeated"):
            merge.checked(spark.createDataFrame(data, "k int"), spec)


def test_replace_partitions_with_nulls(spark):
    t = spark.createDataFrame([(None, 1), ("p", 2), ("q", 3)], "p string, v int")
    s = spark.createDataFrame([(None, 9), ("q", 8)], "p string, v int")
    assert rows(merge.replace_partitions(t, s, ["p"])) == sorted([("p", 2), (None, 9), ("q", 8)], key=repr)


def plan(mode, **policies):
    return config.table({"name": "t", "target_schema": "x", "natural_key": ["k"], "policies": {"load_mode": mode} | policies, "sources": [{"name": "s", "table": "x"}], "columns": [{"name": "k", "inputs": [{"column": "k"}]}, {"name": "v", "inputs": [{"column": "v"}]}, {"name": "tmp", "default": 1, "temporary": True}]})


def test_modes(spark, tmp_path):
    w = writer.TableWriter(writer.SnapshotStore(spark, str(tmp_path)))
    df = lambda *data: spark.createDataFrame(list(data), "k int, v string").withColumn("tmp", F.lit(1))
    assert w.write(spark, df((1, "a")), plan("append")).rows_inserted == 1
    assert w.write(spark, df((2, "b")), plan("append")).rows_inserted == 1
    assert rows(w.store.read("x.t")) == [(1, "a"), (2, "b")]
    r = w.write(spark, df((2, "B"), (3, "c")), plan("merge", merge_strategy="update_changed"))
    assert (r.rows_inserted, r.rows_updated, r.rows_unchanged) == (1, 1, 1)
    assert rows(w.store.read("x.t")) == [(1, "a"), (2, "B"), (3, "c")]
    ctx = registry.Context(state={"replace_by": ["k"]})
    r = w.write(spark, df((3, "z")), plan("replace_by_partition"), ctx)
    assert (r.rows_inserted, r.rows_deleted, r.rows_unchanged) == (1, 1, 2)
    assert w.write(spark, df((9, "i")), plan("overwrite")).rows_inserted == 1
    assert rows(w.store.read("x.t")) == [(9, "i")]
    with pytest.raises(WriterError):
        w.write(spark, df((1, "a")), plan("replace_by_partition"))
    w.store.drop("x.t")
    assert not w.store.exists("x.t")


def test_versions_of_a_table(spark, tmp_path):
    """Partition values keep their types, of two writers one finds out, and a lost draft changes nothing."""
    store = writer.SnapshotStore(spark, str(tmp_path))
    df = lambda *data: spark.createDataFrame(list(data), "k int, period string")
    store.append("x.t", df((1, "007"), (2, None)), ("period",))
    store.append("x.t", df((3, "1e2")))  # another layout
    assert rows(store.read("x.t")) == [(1, "007"), (2, None), (3, "1e2")] and store.version("x.t").rows == 3
    base = store.version("x.t")
    assert store.replace("x.t", df((4, "08")), ("period",), base) == 1
    with pytest.raises(WriterError, match="came first"):
        store.replace("x.t", df((5, "09")), (), base)
    assert not store.commit("x.t", base, base.schema, base.parts)
    (tmp_path / "x.t" / "_versions" / "draft-lost").write_text("{")
    assert rows(store.read("x.t")) == [(4, "08")] and rows(store.read("x.t", store.version("x.t", 1))) == [(1, "007"), (2, None)]
    with pytest.raises(WriterError, match="int, not string"):
        store.append("x.t", spark.createDataFrame([("a",)], "k string"))
    assert store.vacuum("x.t") == 4 and rows(store.read("x.t")) == [(4, "08")]


def test_a_source_is_evaluated_once(spark, tmp_path):
    """A source that gives other rows each time is written and counted as one of them."""
    store = writer.SnapshotStore(spark, str(tmp_path))
    w = writer.TableWriter(store)
    once = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    w.write(spark, once, plan("append"))
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    for mode in ("replace_by_partition", "merge", "overwrite", "append"):
        seen.value = 0
        r = w.write(spark, once.filter("k > 1").mapInPandas(look, once.schema), plan(mode), registry.Context(state={"replace_by": ["k"]}))
        assert seen.value == 2 and r.rows_inserted + r.rows_updated + r.rows_unchanged >= 2


def test_first_versions_and_hooks(spark, tmp_path):
    seen = []
    w = writer.TableWriter(writer.SnapshotStore(spark, str(tmp_path)), lambda *a: seen.append(len(a)), lambda *a: seen.append(a[4]))
    p = plan("merge", merge_strategy="scd_type2")
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    w.write(spark, df, p, registry.Context(as_of=dt.datetime(2024, 1, 1)))
    r = w.write(spark, df.withColumn("v", F.lit("b")), p, registry.Context(as_of=dt.datetime(2024, 2, 1)))
    assert (r.rows_inserted, r.rows_expired) == (1, 1) and w.store.read("x.t").count() == 2
    assert seen[0] == 4 and seen[1].created
    with pytest.raises(WriterError):
        w.write(spark, df.union(df), p, registry.Context(as_of=dt.datetime(2024, 3, 1)))
    assert isinstance(seen[-1], WriterError)


def test_rows_set_aside_reach_the_sink(spark, tmp_path):
    got = {}
    ctx = registry.Context(keys=["k"], sink=lambda name, df: got.setdefault(name, rows(df)))
    p = config.table({"name": "t", "sources": [{"name": "s", "table": "x"}], "stages": [{"name": "a", "columns": [{"name": "k", "inputs": [{"column": "k"}]}], "extensions": {"stage_plugin": "check_duplicates", "columns": ["k"]}}]})
    df = compiler.PlanBuilder(p).build(spark, ctx, {"s": spark.createDataFrame([(1,), (1,), (2,)], "k int")})
    writer.TableWriter(writer.SnapshotStore(spark, str(tmp_path))).write(spark, df, p, ctx)
    assert len(got["duplicates"]) == 2


def test_metrics(spark):
    heard = []
    c = metrics.MetricsCollector(metrics.create_run_metrics("t"), listeners=[lambda k, r: heard.append(k), lambda k, r: 1 / 0])
    c.source("s", 10)
    c.quality("x", "null", "rejected", 3)
    c.quality("x", "null", "warned", 4)
    c.write(writer.WriteResult("t", "merge", 5, 2))
    c.complete()
    c.fail("late")
    m = c.metrics
    assert (m.status, m.rows_read, m.rows_rejected, m.rows_written) == ("success", 10, 3, 7) and len(heard) == 4
    tries = []

    def append(name, df):
        tries.append(name)
        if tries.count(name) == 1 and name == "run_metrics":
            raise RuntimeError("conflict")

    metrics.save(spark, m, append, wait=lambda s: None)
    assert tries.count("run_metrics") == 2 and len(set(tries)) == 6
    assert metrics.frames(spark, m)["quality_metrics"].count() == 2


def test_stream(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k int, v string").parquet(str(tmp_path / "in"))
    w = writer.TableWriter(writer.SnapshotStore(spark, str(tmp_path / "store")))
    q = writes(stream, plan("merge"), w, str(tmp_path / "cp")).start()
    q.processAllAvailable()
    spark.createDataFrame([(2, "B")], "k int, v string").write.mode("append").parquet(str(tmp_path / "in"))
    q.processAllAvailable()
    q.stop()
    assert rows(w.store.read("x.t")) == [(1, "a"), (2, "B")]
