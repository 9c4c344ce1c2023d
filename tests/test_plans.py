"""Types, config dialects, macros, compiling, SQL previews."""

import pytest
from conftest import SF

from tablewright.errors import ConfigError, PlanBuilderError
from tablewright.functions.types import parse_type
from tablewright.plans import compiler, config


@pytest.mark.parametrize(
    ("text", "sql"),
    [("varchar(255)", "STRING"), ("money", "DECIMAL(19,4)"), ("decimal(18,2)", "DECIMAL(18,2)"), (" INT ", "INTEGER"), ("number", "DECIMAL(10,0)"), ("bit", "BOOLEAN"), ("datetime2", "TIMESTAMP"), ("varbinary(10)", "BINARY"), ("smallmoney", "DECIMAL(10,4)")],
)
def test_types(text, sql):
    assert parse_type(text).to_spark_sql() == sql


@pytest.mark.parametrize("text", ["varchar", "char", "decimal(2,5)", "array<int>", "int()", "decimal(0)", "varchar(0)", "frob"])
def test_bad_types(text):
    with pytest.raises(ConfigError):
        parse_type(text)


def test_standard_sql():
    assert parse_type("varchar(20)").to_standard_sql() == "VARCHAR(20)"
    assert parse_type("decimal(18, 2)").to_standard_sql() == "DECIMAL(18,2)"


def test_defaults_templates_and_macros():
    d = {"name": "t", "sources": [{"name": "s", "generated": {"row_count": 1}}], "columns": [{"name": "is_active", "default": False}, {"name": "d", "default": "${defaults.columns.default_date}"}], "description": "in ${defaults.place}"}
    defaults = {"policies": {"optimisation": {"load_mode": "merge"}}, "columns": {"default_date": "1900-01-01"}, "place": "here", "common_columns": [{"name": "is_active", "data_type": "boolean", "default": True, "nullable": False}]}
    t = config.YamlConfigProvider().load_dict(d, defaults)
    assert t.policies.load_mode == "merge" and t.description == "in here"
    active, day = t.columns
    assert (active.default, active.nullable, active.data_type.base_type) == (False, False, "BOOLEAN")
    assert day.default == "1900-01-01"
    with pytest.raises(ConfigError, match="nowhere"):
        config.expanded("${nowhere.x}", {"a": 1})


def test_yaml_with_defaults_beside_it(tmp_path):
    yaml = pytest.importorskip("yaml")
    (tmp_path / "defaults.yaml").write_text(yaml.safe_dump({"policies": {"optimisation": {"load_mode": "overwrite"}}}))
    (tmp_path / "t.yaml").write_text(yaml.safe_dump({"name": "t", "layer": "gold", "natural_key": ["a"], "sources": [{"name": "s", "table": "x.y"}], "columns": [{"name": "a", "inputs": [{"source": "s", "column": "a"}]}]}))
    t = config.YamlConfigProvider().load(tmp_path / "t.yaml")
    assert t.target == "gold.t" and t.natural_keys == ["a"] and t.policies.load_mode == "overwrite"


FACT = {
    "name": "f", "natural_key": ["id"],
    "sources": [{"name": "src", "path": f"{SF}/orders.parquet"}, {"name": "d", "path": f"{SF}/customer.parquet", "broadcast": True}],
    "columns": [
        {"name": "id", "inputs": [{"source": "src", "column": "o_orderkey"}]},
        {"name": "customer", "inputs": [{"source": "src", "column": "o_custkey"}]},
        {"name": "segment", "default": "NONE", "inputs": [{"expression": "COALESCE(d.c_mktsegment, 'NONE')"}]},
    ],
    "stages": [{"name": "j", "type": "transformation", "joins": [{"source": "d", "type": "left", "conditions": [{"left": "customer", "right": "c_custkey"}]}]}, {"name": "check", "extensions": {"stage_plugin": "check_unresolved_fks", "checks": [{"column": "segment", "sentinel": "NONE"}]}}],
}


def test_columns_at_the_top_and_joins_on_them(spark):
    t = config.table(FACT)
    builder = compiler.PlanBuilder(t)
    ctx = builder.context()
    df = builder.build(spark, ctx)
    assert df.columns == ["id", "customer", "segment"]
    assert df.count() == spark.read.parquet(f"{SF}/orders.parquet").count()
    assert ctx.rows["unresolved_fks"][0].collect()[0].unresolved_count == 0
    assert "left join d: customer = c_custkey" in builder.explain()
    assert "LEFT JOIN d AS d ON customer = d.c_custkey" in builder.to_sql(t.stages[0])


def test_preview_is_runnable(spark):
    spark.read.parquet(f"{SF}/orders.parquet").createOrReplaceTempView("orders_v")
    plan = {"name": "p", "sources": [{"name": "orders_v", "table": "orders_v"}], "stages": [{"name": "a", "columns": [{"name": "s", "inputs": [{"column": "o_orderstatus"}]}, {"name": "k", "data_type": "int", "inputs": [{"column": "o_orderkey"}]}], "filters": ["k > 3"]}, {"name": "b", "group_by": {"keys": ["s"], "aggregations": [{"function": "max", "column": "k", "alias": "m"}]}}]}
    t = config.table(plan)
    assert sorted(spark.sql(compiler.generate_sql(t)).collect()) == sorted(compiler.PlanBuilder(t).build(spark).collect())


def test_errors_name_their_place(spark):
    base = {"name": "t", "sources": [{"name": "s", "generated": {"row_count": 1}}]}
    with pytest.raises(PlanBuilderError, match="nope"):
        compiler.compiled(spark, base | {"stages": [{"name": "a", "joins": [{"source": "nope"}]}]})
    with pytest.raises(PlanBuilderError, match="no stage step"):
        compiler.compiled(spark, base | {"stages": [{"name": "a", "extensions": {"stage_plugin": "nope"}}]})
    for bad in ({"joins": [{"source": "s", "type": "sideways"}]}, {"joins": [{"source": "s", "conditions": [{"left": "a", "right": "b", "operator": "~"}]}]}, {"union": ["s"]}, {"group_by": {"keys": []}}):
        with pytest.raises(ConfigError):
            config.table(base | {"stages": [{"name": "a"} | bad]})
    with pytest.raises(ConfigError):
        compiler.compiled(spark, base)


def test_transform_before_cast_and_context_rows(spark):
    df = spark.createDataFrame([("a", "£1,234.56"), ("b", None)], "k string, v string")
    plan = {"name": "t", "natural_key": ["k"], "sources": [{"name": "s", "table": "x"}], "stages": [{"name": "a", "columns": [{"name": "k", "inputs": [{"column": "k"}]}, {"name": "v", "data_type": "decimal(10,2)", "inputs": [{"column": "v"}], "extensions": {"transform": "clean_decimal"}}, {"name": "w", "inputs": [{"column": "v"}], "extensions": {"transform": "not_null"}}]}]}
    builder = compiler.PlanBuilder(config.table(plan))
    ctx = builder.context()
    out = builder.build(spark, ctx, {"s": df}).collect()
    assert [(r.k, str(r.v)) for r in out] == [("a", "1234.56")]
    assert ctx.rows["rejected"][0].collect()[0]._dq_natural_id == '{"k":"b"}'


def test_incremental_plan(spark):
    src = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-05"), (3, "2024-02-01")], "k int, d string")
    target = spark.createDataFrame([(1, "2024-01-03")], "k int, d string")
    plan = {"name": "t", "sources": [{"name": "s", "table": "x"}], "incremental": {"filter_mode": "watermark", "watermark_column": "d"}, "stages": [{"name": "a", "columns": [{"name": "k", "inputs": [{"column": "k"}]}]}]}
    builder = compiler.PlanBuilder(config.table(plan))
    ks = lambda **how: sorted(r.k for r in builder.build(spark, None, {"s": src}, **how).collect())
    assert ks(target=target) == [2, 3]
    assert ks() == [1, 2, 3]
    assert ks(target=target, watermark_override="2024-01-20") == [3]
    assert ks(target=target, watermark_override="garbage") == [2, 3]


def test_outer_join_keeps_keys(spark):
    a, b = spark.createDataFrame([(1, "x")], "k int, a string"), spark.createDataFrame([(1, "y"), (2, "z")], "k int, a string")
    plan = {"name": "t", "sources": [{"name": "l", "table": "x"}, {"name": "r", "table": "x"}], "stages": [{"name": "j", "joins": [{"source": "r", "type": "full", "conditions": [{"left": "k", "right": "k"}]}]}]}
    out = compiler.PlanBuilder(config.table(plan)).build(spark, None, {"l": a, "r": b})
    assert sorted((r.k, r.a) for r in out.collect() if r.a) == [(1, "x")]
    assert sorted(r.k for r in out.collect()) == [1, 2]


def test_columns_and_environment():
    t = config.table(FACT)
    assert [c.name for c in t.filter_columns(natural=True)] == ["id"] and t.persistent_columns == ["id", "customer", "segment"]
    e = config.environment({"name": "dev", "layers": {"bronze": [{"name": "a", "path": "/x", "format": "csv"}]}})
    assert e.source("bronze", "a").format == "csv"
    with pytest.raises(ConfigError):
        e.source("bronze", "b")
    with pytest.warns(UserWarning, match="duplicates_table"):
        config.table({"name": "t", "sources": [{"name": "s", "table": "x"}], "dq": {"duplicates_table": "d"}, "columns": [{"name": "a"}]})


def test_layer_defaults_from_files(tmp_path):
    """Templates as a mapping by name, bare or under defaults, in files as they come with a layer."""
    yaml = pytest.importorskip("yaml")
    from tablewright.queries import LAYER

    plan = {"name": "t", "layer": "gold", "target_schema": "fact", "natural_key": ["k"], "sources": [{"name": "s", "table": "x.y"}], "columns": [{"name": "k", "inputs": [{"source": "s", "column": "k"}]}, {"name": "source_modified", "nullable": True}]}
    (tmp_path / "t.yaml").write_text(yaml.safe_dump(plan))
    for k, defaults in enumerate((LAYER, {"defaults": LAYER})):
        (tmp_path / f"layer{k}.yaml").write_text(yaml.safe_dump(defaults))
        t = config.YamlConfigProvider(str(tmp_path / f"layer{k}.yaml")).load(tmp_path / "t.yaml")
        modified = t.columns[1]
        assert (modified.data_type.to_spark_sql(), modified.default, modified.nullable) == ("DATE", "1900-01-01", True)
        assert t.policies.merge_strategy == "update_changed" and t.dq["rejected_table"] == "log.rejected"


def test_catalogue_entities():
    from tablewright.plans import catalogue

    t = config.table({"name": "f", "layer": "gold", "target_schema": "fact", "natural_key": ["k"], "description": "d", "sources": [{"name": "s", "table": "x"}], "policies": {"load_mode": "merge"}, "columns": [{"name": "k", "data_type": "int", "nullable": False, "inputs": [{"column": "k"}], "extensions": {"description": "key"}}, {"name": "tmp", "temporary": True, "default": 1}]})
    e = catalogue.entity(t, "lake://main", "f.yaml")
    assert e["attributes"] == {"qualifiedName": "lake://main/fact/f", "name": "f", "description": "d", "layer": "gold", "target_schema": "fact", "load_mode": "merge", "merge_strategy": "update_all", "natural_key": "k", "config_file": "f.yaml", "column_count": 1}
    assert e["relationshipAttributes"]["schema"] == [{"qualifiedName": "lake://main/fact/f#k", "name": "k", "type": "INTEGER", "isNullable": False, "description": "key"}]

    class Fake:
        def __init__(self):
            self.calls = []

        def get_type(self, name):
            return None

        def put_types(self, d):
            self.calls.append([a["name"] for a in d["entityDefs"][0]["attributeDefs"]])

        def put_entities(self, es):
            self.calls.append(len(es))
            return {"mutatedEntities": {"CREATE": es}}

    fake = Fake()
    assert catalogue.register(None, [t], dry_run=True)["created"] == 0
    assert catalogue.register(fake, [t])["created"] == 1 and fake.calls == [list(catalogue.ATTRIBUTES), 1]
