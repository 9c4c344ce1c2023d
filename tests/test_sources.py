"""Readers, ingestion, connectors, orchestration, governance."""

import datetime as dt

import pytest

from tablewright.errors import ConfigError
from tablewright.plans import config, orchestrate
from tablewright.sources import connectors, ingest, profiling, readers

AT = dt.datetime(2024, 1, 1)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_csv_headers(spark, tmp_path):
    plain = write(tmp_path / "a.csv", 'id,name\n1,"x ""y"", z"\n2,"two\nlines"\n')
    assert [tuple(r) for r in readers.read_csv_file(spark, plain).collect()] == [("1", 'x "y", z'), ("2", "two\nlines")]
    titled = write(tmp_path / "b.csv", "Report\n\nid,name,name,,\n1,a,b,c,\n")
    marked = readers.read_csv_file(spark, titled, header_marker="ID")
    assert marked.columns == ["id", "name", "name_1"] and [tuple(r) for r in marked.collect()] == [("1", "a", "b")]
    with pytest.raises(ConfigError):
        readers.read_csv_file(spark, titled, header_marker="nope")
    with pytest.raises(ConfigError):
        readers.read_csv_file(spark, write(tmp_path / "c.csv", "x\nid,name\n"), header_marker="id")
    tabs = write(tmp_path / "d.txt", "id\tv\n1\t2\n")
    assert [tuple(r) for r in readers.read_file(spark, {"path": tabs}).collect()] == [("1", "2")]
    with pytest.raises(ConfigError):
        readers.read_file(spark, {"path": "x.pdf"})


def test_ingestion(spark, tmp_path):
    root = tmp_path / "in"
    write(root / "Folder A" / "sales_20240105.csv", "Id,Cust Name\n1,a\n2,b\n")
    write(root / "Folder A" / "sales_20240106.csv", "Id,Cust Name\n")
    write(root / "Folder A" / "other.csv", "Id\n1\n")
    write(root / "Folder A" / "sales_20250101.csv", "Id\n1\n")
    rules = spark.createDataFrame([("src", "folder-a", "csv", "sales%", 240101, 241231, None, "bronze.sales", "cust:customer")], "source string, folder_name string, extension string, file_name_wildcard string, time_range_min long, time_range_max long, exclude_file string, target_table string, column_normalize string")
    empty, got = spark.createDataFrame([], ingest.LOG), {}
    append = lambda target, df: got.setdefault(target, []).append([r.asDict() for r in df.collect()])
    log = ingest.run_ingestion(spark, str(root), rules, empty, append, "r1", AT)
    assert {r.file_name: r.status for r in log.collect()} == {"sales_20240105.csv": "SUCCESS", "sales_20240106.csv": "EMPTY"}
    row = got["bronze.sales"][0][0]
    assert row["id"] == "1" and row["customer"] == "a" and row["_source_period"] == "240105" and row["_run_id"] == "r1"
    again = ingest.new_files(readers.list_files(spark, str(root)), log)
    assert sorted(r.file_name for r in again.collect()) == ["other.csv", "sales_20250101.csv"]
    state = {r.file_name: r.ingestion_status for r in ingest.reconciled(readers.list_files(spark, str(root)), rules, log).collect()}
    assert state == {"sales_20240105.csv": "INGESTED", "sales_20240106.csv": "EMPTY", "other.csv": "UNMATCHED", "sales_20250101.csv": "UNMATCHED"}
    bulk = ingest.run_ingestion_parallel(spark, [str(root)], rules, empty, lambda t, df: 1 / 0, "r2", AT, bulk=True)
    assert {r.status for r in bulk.collect()} == {"FAILED", "EMPTY"}
    files = [{"path": str(root / "Folder A" / "other.csv"), "folder": "f", "file_name": "other.csv"}, {"path": "x.pdf", "folder": "f", "file_name": "x.pdf"}]
    assert [r.status for r in ingest.validated(spark, files).orderBy("file_name").collect()] == ["OK", "FAILED"]
    assert ingest.summary(log).count() == 2 and ingest.latest_failures(bulk).count() == 1
    debug = ingest.match_debug(readers.list_files(spark, str(root)), rules).collect()
    assert sum(r.is_wildcard and r.is_folder for r in debug) == 3


def test_names():
    assert ingest.sanitized(["A b", "a-b", "", "Ü"]) == ["a_b", "a_b_1", "col_2", "col_3"]


class Objects:
    def __init__(self, rows, n=None):
        self.rows, self.n, self.asked = rows, n, []

    def query(self, text):
        self.asked.append(text)
        return self.rows

    def count(self, text):
        return len(self.rows) if self.n is None else self.n


def test_objects(spark):
    client = Objects([{"Id": 1, "X": None}])
    out = connectors.object_rows(spark, client, "Account", ["Id", "X"], "r", "Modified", AT)
    assert [tuple(r) for r in out.collect()] == [("1", None, "r")]
    assert client.asked == ["SELECT Id, X FROM Account WHERE Modified > 2024-01-01T00:00:00Z"]
    with pytest.raises(ConfigError):
        connectors.object_rows(spark, Objects([], 2), "Account", ["Id"], "r")


class Pages:
    DATA = {"u": {"value": [{"id": 1, "fields": {"a": "x"}}], "@odata.nextLink": "u2"}, "u2": {"value": [{"id": 2, "@removed": {}}], "@odata.deltaLink": "d1"}, "d1": {"d": {"results": [{"id": 3, "fields": {"b": 5}}]}}}

    def get(self, url):
        return self.DATA[url]


def test_lists(spark):
    df, delta = connectors.list_changes(spark, Pages(), "u")
    assert delta == "d1" and sorted((r.id, r.a, r.is_deleted) for r in df.collect()) == [("1", "x", False), ("2", None, True)]
    df, delta = connectors.list_changes(spark, Pages(), "u", "d1")
    assert delta is None and [(r.id, r.b) for r in df.collect()] == [("3", "5")]
    cursors = spark.createDataFrame([("a", "l1", 1), ("a", "l2", 2)], "name string, delta_link string, at int")
    assert connectors.latest_cursor(cursors, ["name"], "delta_link", "at").collect()[0].delta_link == "l2"


def test_schedules():
    now = dt.datetime(2024, 3, 4, 6, 30, tzinfo=dt.UTC)  # a Monday
    assert orchestrate.schedule_allows({"schedules": "daily, weekly"}, "weekly") and orchestrate.schedule_allows({}, "all")
    assert not orchestrate.schedule_allows({"active": False, "schedules": ["daily"]}, "daily") and not orchestrate.schedule_allows({"schedules": ["daily"]}, "weekly")
    assert orchestrate.time_allows({"days_of_week": ["Monday"], "hours_utc": [6], "days_of_month": 4, "months": [3]}, now)
    assert not orchestrate.time_allows({"hours_utc": [7]}, now) and not orchestrate.time_allows({"days_of_week": "tue"}, now)


def test_jobs():
    ran = []
    out = orchestrate.run_jobs({"a": lambda: ran.append("a"), "b": lambda: 1 / 0, "c": lambda: ran.append("c"), "d": lambda: ran.append("d")}, {"c": ["b"], "d": ["a"]})
    assert [o.status for o in out] == ["SUCCESS", "FAILED", "SKIPPED", "SUCCESS"] and ran == ["a", "d"]
    with pytest.raises(ConfigError):
        orchestrate.run_jobs({"a": print, "b": print}, {"a": ["b"], "b": ["a"]})


def test_batches_and_catalogue(spark, tmp_path):
    def t(name, batch, **more):
        return config.table({"name": name, "layer": "gold", "policies": {"orchestration": {"batch": batch} | more}, "sources": [{"name": "s", "table": "silver.s"}], "columns": [{"name": "k", "data_type": "int", "natural": True, "extensions": {"glossary": "Key", "classification": "internal"}}]})

    ran = []
    orchestrate.run_batches([t("b", 2), t("a", 1), t("z", 0), t("off", 1, active=False), t("y", 0)], lambda x: ran.append(x.name), lambda target: target == "gold.z")
    assert ran == ["y", "a", "b"]
    m = orchestrate.manifest(spark, [t("a", 1), t("b", 1)])
    assert m.count() == 2 and orchestrate.glossary(m).collect()[0]["columns"] == ["gold.a.k", "gold.b.k"]
    assert orchestrate.lineage(spark, [t("a", 1)]).collect()[0].asDict() == {"source": "silver.s", "target": "gold.a"}
    held = spark.createDataFrame([("x", 1)], "k string, old int").schema
    d = orchestrate.diff_table_schema(t("a", 1), held)
    assert d.added == [] and d.removed == ["old"] and d.type_changes == {"k": ("string", "int")}
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "x.yaml").write_text("name: x")
    assert [p.name for p in orchestrate.config_paths(["p", "x"], str(tmp_path))] == ["x.yaml"]
    with pytest.raises(ConfigError):
        orchestrate.config_paths(["nope"], str(tmp_path))
    good, bad = orchestrate.load_entries([tmp_path / "p" / "x.yaml", tmp_path / "gone.yaml"], config.YamlConfigProvider())
    assert [g.name for g in good] == ["x"] and len(bad) == 1


def test_manual_csv(spark, tmp_path):
    path = write(tmp_path / "f" / "m.csv", "id,_source\n1,old\n")
    r = readers.read_manual_csv(spark, path, "id int, _source string").collect()[0]
    assert (r.id, r._source, r._source_file, r._source_folder) == (1, "manual", "m.csv", "f")
    orchestrate.ensure_schemas(spark, ["tw_x"])
    assert "tw_x" in readers.schema_names(spark)
    assert orchestrate.drop_tables(spark, "tw_x", "a") == []
    orchestrate.drop_schema(spark, "tw_x", True)
    assert "tw_x" not in readers.schema_names(spark)


def test_header_of_sampled_rows():
    assert profiling.header_start([]) is None and profiling.header_start([None, [None, ""], [" "]]) is None
    assert profiling.header_start([[None, None], ["Title", None, None], ["a", "b"]]) == 2
    assert profiling.header_start([[1.0, None, None, None, None, None], [1, 2, 3], ["x"]]) == 2


def test_profiles(spark, tmp_path):
    files = []
    for name, text in (("sales 2401.csv", "\n , \nid,name\n1,\"a, b\"\n2,c\n"), ("t.txt", "k\tv\n1\t2\n"), ("book.xlsx", "not a workbook"), ("x.pdf", "x")):
        (tmp_path / name).write_text(text)
        files.append(("f", name, str(tmp_path / name), name.rpartition(".")[2], None))
    got = {r.file_name: r for r in profiling.profiled(spark, spark.createDataFrame(files, "folder string, file_name string, path string, extension string, modified_on timestamp")).collect()}
    assert (got["sales 2401.csv"].header_start, got["sales 2401.csv"].column_names, got["sales 2401.csv"].row_count, got["sales 2401.csv"].period) == (3, ["id", "name"], 5, "240101")
    assert (got["t.txt"].header_start, got["t.txt"].column_names) == (1, ["k", "v"])
    assert got["book.xlsx"].error and got["x.pdf"].row_count is None


def test_wide_files_keep_all_columns(spark, tmp_path):
    names = [f"c_{i}" for i in range(700)]
    path = tmp_path / "wide.csv"
    path.write_text("title\n" + ",".join(names) + "\n" + ",".join(map(str, range(700))) + "\n")
    for multi in (True, False):
        df = readers.read_csv_file(spark, str(path), header_start=2, multi_line=multi)
        assert df.columns == names and list(df.collect()[0]) == [str(i) for i in range(700)]
