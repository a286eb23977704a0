"""What the conformance lake stores, over tables of a few rows."""

import pytest

from conformance import lake as lakes, queries
from conformance.lake import DERIVED, Lake
from shelfstrata.operators.dedup import columns_behind, keep_latest
from shelfstrata.plans.bronze import SOURCE_FILES

# Order lines have repeated ids, with other products and amounts; one product is missing.
STAR = {
    "region": "0L as r_regionkey, 'EUROPE' as r_name",
    "nation": "0L as n_nationkey, 'FRANCE' as n_name, 0L as n_regionkey",
    "customer": "id as c_custkey, 'Customer#1' as c_name, 0L as c_nationkey, 1.0d as c_acctbal",
    "supplier": "id as s_suppkey, 'Supplier#1' as s_name, 0L as s_nationkey, 1.0d as s_acctbal",
    "part": "id + 1 as p_partkey, 'tin' as p_name, 'Brand#1' as p_brand, 'SMALL' as p_type, 3 as p_size, 9.5d + id as p_retailprice",
    "orders": "id as o_orderkey, id as o_custkey, 'F' as o_orderstatus, 7.5d as o_totalprice, "
    "timestamp'1996-06-02' as o_orderdate, '1-URGENT' as o_orderpriority",
    "lineitem": "id % 15 as l_orderkey, id % 7 as l_partkey, id as l_suppkey, 1 as l_linenumber, 2.0d + id as l_quantity, "
    "7.5d * id as l_extendedprice, 0.1d as l_discount, 0.2d as l_tax, timestamp'1996-06-03' as l_shipdate",
}


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("star")
    for table, columns in STAR.items():
        rows = spark.range(1 if table in ("region", "nation") else 20)
        rows.selectExpr(*columns.split(", ")).write.parquet(str(folder / f"{table}.parquet"))
    return str(folder)


def test_ingest_audit_leaves_compressed_files(spark, star, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "scratch_folder", lambda _spark, _purpose: str(tmp_path))
    audit = queries.bronze_ingest_audit(spark, star).collect()
    assert {r.source_name: r.row_count for r in audit} == dict.fromkeys(SOURCE_FILES, 20)
    landed = list(tmp_path.glob("landing/*/part-*"))
    assert {f.parent.name for f in landed} == set(SOURCE_FILES.values()) and {f.suffix for f in landed} == {".lz4"}
    assert all(".zstd." in f.name for f in tmp_path.glob("bronze/*/part-*"))


def test_columns_behind_the_wanted_ones_decide_as_all_do(spark):
    schema = "a string, k string, b int, t int, c int"
    rows = [("x", "1", 1, 5, 1), ("x", "1", 2, 5, 0), ("y", "1", None, 5, 9), ("z", "1", 9, None, 9), ("q", "2", 1, 1, 1),
            (None, "2", 2, 1, 2), ("n", None, 3, 3, 3), ("n", None, 3, 3, 4)]
    df = spark.createDataFrame(rows, schema)
    for wanted in ([], ["k"], ["t"], ["a"], ["b", "a"], ["c"]):
        behind = columns_behind(df.columns, wanted, ["k"], ["t", "not_there"])
        cut = keep_latest(df.select(*behind), ["k"], ["t"]).select("k", *wanted)
        assert sorted(cut.collect(), key=str) == sorted(keep_latest(df, ["k"], ["t"]).select("k", *wanted).collect(), key=str)
    assert columns_behind(df.columns, ["k"], ["k"], ["t"]) == ["k"]
    assert columns_behind(df.columns, ["a"], ["k"], ["t"]) == ["a", "k", "t"]


@pytest.mark.parametrize("model", DERIVED)
def test_models_cut_down_are_those_built_whole(spark, star, model):
    whole = Lake(spark, star).model(model)
    plain = [c for c in whole.columns if c not in DERIVED[model]][0]
    # Columns that nothing shared is taken for are looked at together.
    groups: list[dict] = []
    for column, taken in {plain: (plain,), **DERIVED[model]}.items():
        apart = [g for g in groups if not {*taken} & {t for others in g.values() for t in others}]
        if not apart:
            groups.append({})
        (apart or groups)[-1][column] = taken
    for group in groups:
        read = [c for c in whole.columns if c in group]
        cut = Lake(spark, star).models({model: {*read}}, {model: 2})[model]
        rows = sorted(whole.select(read).collect(), key=str)
        assert sorted(cut.collect(), key=str) == rows and all(any(r[c] is not None for r in rows) for c in read)


def test_only_what_is_read_is_stored(spark, star, monkeypatch):
    stored, keep = {}, Lake.keep
    monkeypatch.setattr(Lake, "keep", lambda self, name, df: (stored.update({name: set(df.columns)}), keep(self, name, df))[1])
    found = {(r.model_name, r.column_name): r.failures for r in queries.all_queries()["test_unique"](spark, star).collect()}
    assert found["fct_sales", "sales_key"] == found["stg_order_items", "order_item_id"] == 0
    assert stored["stg_order_items"] == {"order_item_id", "order_id", "product_id"}
    assert stored["stg_orders"] == {"order_id"}
    assert stored["int_order_revenue"] == {"order_item_id", "order_id", "product_id"}
    assert not {"fct_sales", "fct_inventory_snapshot", "dim_product"} & stored.keys()
    assert spark.conf.get(lakes.SHUFFLES_GO) == "false"


def test_a_join_for_the_key_alone_goes_only_if_it_repeats_no_row(spark, star, capsys):
    lake = Lake(spark, star)
    lake._read = {"fct_sales": {"sales_key"}}
    twice = spark.createDataFrame([("PRODUCT-000001",), ("PRODUCT-000001",), ("PRODUCT-000002",), (None,), (None,)], "product_id string")
    for products, joins, more in ((twice.distinct(), 1, 0), (twice, 2, 1)):
        lake._kept["stg_products"] = lakes.conform(products, lakes.ENTITIES["products"].schema)
        sales = lake.sales.select("sales_key", "product_id")
        sales.explain()
        assert capsys.readouterr().out.count("Join ") == joins
        lines = lake.silver("order_items")
        assert sales.count() == lines.count() + more * lines.filter("product_id = 'PRODUCT-000001'").count()
