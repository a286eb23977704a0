import pytest
from pyspark.sql import functions as F

from shelfstrata.contracts import CONTRACTS, MODEL_TESTS, RELATIONSHIPS
from shelfstrata.operators import validate as v
from shelfstrata.operators.modeltests import ModelTest, model_test_report
from shelfstrata.operators.quarantine import (
    failing_rows,
    flag,
    orphan_rows,
    quarantine,
    split_clean,
    summarise,
    tag,
)
from shelfstrata.operators.rules import Contract, Relationship, Rule
from shelfstrata.schemas import ENTITIES, QUARANTINE_METADATA

CUSTOMERS = Contract.from_dict(
    {
        "table": "customers",
        "primary_key": ["customer_id"],
        "columns": {
            "customer_id": {
                "type": "string",
                "rules": ["not_null", "unique", {"regex": "^CUSTOMER-[0-9]{6}$"}],
            },
            "loyalty_tier": {
                "type": "string",
                "rules": [{"accepted_values": ["bronze", "silver", "gold"]}],
            },
        },
    }
)


def customers(spark, *rows):
    return spark.createDataFrame(list(rows), "customer_id string, loyalty_tier string")


def by_rule(report):
    return {(r.column_name, r.rule_name): r for r in report.collect()}


def test_declared_rules_cover_the_entities():
    assert sum(len(c.rules) for c in CONTRACTS.values()) == 87
    assert len(RELATIONSHIPS) == 6 and len(MODEL_TESTS) == 101
    for contract in CONTRACTS.values():
        entity = ENTITIES[contract.table]
        assert {r.column for r in contract.rules} <= set(entity.column_names)
        assert contract.primary_key == entity.key


def test_valid_rows_pass(spark):
    df = customers(spark, ("CUSTOMER-000001", "gold"), ("CUSTOMER-000002", "silver"))
    report = v.report(df, CUSTOMERS)
    assert tuple(report.columns) == v.REPORT_COLUMNS
    assert all(r.passed and r.total_count == 2 for r in report.collect())


def test_invalid_rows_fail_and_counts_are_rows(spark):
    df = customers(
        spark, ("CUSTOMER-000310", "silver"), ("client 7", "wood"), ("CUSTOMER-000310", "gold"), ("CUSTOMER-000311", None)
    )
    found = by_rule(v.report(df, CUSTOMERS))
    assert found["customer_id", "unique"].failed_count == 2
    assert found["customer_id", "regex"].failed_count == 1
    assert found["loyalty_tier", "accepted_values"].failed_count == 1
    assert found["customer_id", "not_null"].passed


def test_report_keeps_contract_order_and_texts(spark):
    contract = Contract.of(
        "t",
        ["a"],
        {"a": ["unique", "not_null", {"regex": "^x\\.'y$"}], "b": [{"min_value": 1}],
         "c": [{"accepted_values": ["p", "q"]}]},
    )
    df = spark.createDataFrame([("x.'y", 1, "p")], "a string, b int, c string")
    assert [r.details for r in v.report(df, contract).collect()] == [
        "Uniqueness check",
        "Null check",
        "Regex pattern: ^x\\.'y$",
        "Minimum value check: >= 1",
        "Accepted values: ['p', 'q']",
    ]
    assert all(r.passed for r in v.report(df, contract).collect())


def test_null_passes_all_but_not_null(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "c string, n int")
    contract = Contract.of(
        "t",
        [],
        {"c": ["not_null", "unique", {"regex": "x"}, {"accepted_values": ["x"]}],
         "n": [{"min_value": 0}]},
    )
    failed = {key: r.failed_count for key, r in by_rule(v.report(df, contract)).items()}
    assert failed.pop(("c", "not_null")) == 2
    assert set(failed.values()) == {0}
    assert [r._quarantine_rule_name for r in quarantine(df, contract).collect()] == ["not_null"] * 2


def test_empty_text_and_nan_are_not_null(spark):
    df = spark.createDataFrame([("", float("nan"))], "c string, d double")
    report = v.report(df, Contract.of("t", [], {"c": ["not_null"], "d": ["not_null"]}))
    assert all(r.passed for r in report.collect())


def test_min_value_is_inclusive_and_reads_text(spark):
    df = spark.createDataFrame([("1", 1), ("0.5", 0), ("abc", 2)], "s string, n int")
    report = v.report(df, Contract.of("t", [], {"s": [{"min_value": 1}], "n": [{"min_value": 1}]}))
    assert [r.failed_count for r in report.collect()] == [1, 1]


def test_missing_column_fails_all_rows_also_of_an_empty_table(spark):
    contract = Contract.of("t", [], {"gone": ["not_null", "unique"], "id": ["not_null"]})
    for n in (0, 3):
        report = v.report(spark.range(n), contract).collect()
        assert [r.passed for r in report] == [False, False, True]
        assert [r.failed_count for r in report] == [n, n, 0]
        assert report[0].details == "Column does not exist: gone"
        assert quarantine(spark.range(n), contract).count() == 2 * n


def test_column_name_with_dots(spark):
    df = spark.createDataFrame([("x",), (None,)], ["customer.email"])
    contract = Contract.of("t", [], {"customer.email": ["not_null", "unique"]})
    assert [r.failed_count for r in v.report(df, contract).collect()] == [1, 0]


def test_malformed_rules():
    with pytest.raises(ValueError):
        Contract.of("t", [], {"c": ["positive"]})
    with pytest.raises(ValueError):
        Contract.of("t", [], {"c": [{"regex": "a", "min_value": 1}]})
    with pytest.raises(ValueError):
        Contract.of("t", [], {"c": [5]})


def test_composite_key_rules_follow_from_the_primary_key(spark):
    contract = Contract.of("t", ["a", "b"], {"a": ["not_null"]}).with_key_rules()
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (1, None), (1, None)], "a int, b int")
    found = by_rule(v.report(df, contract))
    assert found["a,b", "unique"].failed_count == 2
    assert found["b", "not_null"].failed_count == 2
    assert len(contract.rules) == 3
    assert CONTRACTS["orders"].with_key_rules() == CONTRACTS["orders"]


def test_failing_rows(spark):
    df = spark.createDataFrame([("store",), ("fax",), (None,), ("online ",), ("mobile_app",)], "channel string")
    rule = Rule("channel", "accepted_values", ["online", "store", "mobile_app"])
    assert [r.channel for r in failing_rows(df, rule).collect()] == ["fax", "online "]
    orders = spark.createDataFrame(
        [("o-17",), (None,), ("o-18",), ("o-17",), (None,), ("o-17",)],
        "order_id string",
    )
    failing = failing_rows(orders, Rule("order_id", "unique"))
    assert [r.order_id for r in failing.collect()] == ["o-17"] * 3


def test_report_counts_are_quarantined_rows(spark):
    df = customers(
        spark,
        ("CUSTOMER-000001", "diamond"),
        ("CUSTOMER-000001", None),
        ("bad", "tin"),
        ("bad", "gold"),
        (None, "gold"),
    )
    counted = {
        (r.column_name, r.rule_name): r.failed_count
        for r in v.report(df, CUSTOMERS).collect()
        if r.failed_count
    }
    stored = {
        (r.column_name, r.rule_name): r.row_count
        for r in summarise(quarantine(df, CUSTOMERS)).collect()
    }
    assert counted == stored == {
        ("customer_id", "not_null"): 1,
        ("customer_id", "unique"): 4,
        ("customer_id", "regex"): 2,
        ("loyalty_tier", "accepted_values"): 2,
    }


def test_two_rules_of_one_name_on_a_column_are_both_kept(spark):
    contract = Contract.of("t", [], {"c": [{"regex": "^a"}, {"regex": "z$"}]})
    df = spark.createDataFrame([("az",), ("ab",), ("bb",)], "c string")
    reasons = sorted(r._quarantine_failure_reason for r in quarantine(df, contract).collect())
    assert reasons == ["Regex pattern: ^a", "Regex pattern: z$", "Regex pattern: z$"]


def test_tag_adds_six_columns(spark):
    row = spark.createDataFrame([("ORDER-00000001", "my mate")], "order_id string, channel string")
    tagged = tag(row, "orders", "channel", "accepted_values", "Invalid channel")
    assert tuple(tagged.columns[2:]) == QUARANTINE_METADATA
    assert tagged.first()._quarantine_rule_name == "accepted_values"


def test_split_clean_and_severity(spark):
    rules = (
        Rule("c", "not_null"),
        Rule("c", "accepted_values", ["x"]),
        Rule("n", "min_value", 0, severity="warn"),
    )
    df = spark.createDataFrame([("x", 1), ("x", -1), ("y", 1), (None, 1)], "c string, n int")
    clean, broken = split_clean(df, Contract("t", (), rules))
    assert sorted(r.n for r in clean.collect()) == [-1, 1]
    assert sorted(r._broken_rules[0] for r in broken.collect()) == ["accepted_values:c", "not_null:c"]
    assert flag(df, Contract("t", (), ())).filter("size(_broken_rules) > 0").count() == 0


def test_grade(spark):
    rules = (
        Rule("c", "not_null", tolerance=0.5),
        Rule("c", "regex", "^x$", severity="warn"),
        Rule("n", "min_value", 2),
        Rule("gone", "not_null", tolerance=1.0),
    )
    contract = Contract("t", (), rules)
    df = spark.createDataFrame([("y", 1), (None, 2)], "c string, n int")
    graded = v.grade(v.report(df, contract), [contract]).collect()
    assert [r.status for r in graded] == ["pass", "warn", "fail", "fail"]
    assert [r.failed_ratio for r in graded] == [0.5, 0.5, 0.5, 1.0]


ORDERS_CUSTOMER = Relationship("fk", "orders", "customer_id", "customers", "customer_id")


def related(spark, *order_customers):
    orders = spark.createDataFrame(
        [(f"O{i}", c) for i, c in enumerate(order_customers)], "order_id string, customer_id string"
    )
    parents = spark.createDataFrame([("CUSTOMER-000001",), (None,)] * 2, "customer_id string")
    return {"orders": orders, "customers": parents}


def test_relationship_counts_distinct_keys(spark):
    tables = related(
        spark, "CUSTOMER-000001", "CUSTOMER-000001", "CUSTOMER-999999", "CUSTOMER-999999", None
    )
    report = v.relationship_report(tables, [ORDERS_CUSTOMER])
    assert tuple(report.columns) == v.RELATIONSHIP_REPORT_COLUMNS
    row = report.first()
    assert (row.passed, row.failed_count, row.child_count) == (False, 1, 2)
    assert row.details == "orders.customer_id must exist in customers.customer_id"
    keys = v.orphan_keys(tables["orders"], "customer_id", tables["customers"], "customer_id")
    assert [r.child_key for r in keys.collect()] == ["CUSTOMER-999999"]
    orphans = orphan_rows(tables["orders"], tables["customers"], ORDERS_CUSTOMER)
    assert sorted(r.order_id for r in orphans.collect()) == ["O2", "O3"]


def test_relationship_passes(spark):
    assert v.relationship_report(related(spark, "CUSTOMER-000001"), [ORDERS_CUSTOMER]).first().passed


def test_relationship_errors(spark):
    tables = related(spark, "CUSTOMER-000001")
    for table in ("orders", "customers"):
        with pytest.raises(ValueError, match=table):
            v.relationship_report({k: t for k, t in tables.items() if k != table}, [ORDERS_CUSTOMER])
        with pytest.raises(ValueError, match="column"):
            v.relationship_report({**tables, table: spark.range(1)}, [ORDERS_CUSTOMER])


def test_gate(spark):
    good = v.relationship_report(related(spark, "CUSTOMER-000001"), [ORDERS_CUSTOMER])
    passing = v.report(customers(spark, ("CUSTOMER-000001", "gold")), CUSTOMERS)
    failing = v.report(customers(spark, ("CUSTOMER-000001", "tin")), CUSTOMERS)
    v.enforce_gate(passing, good)
    with pytest.raises(v.QualityGateError, match="1 column checks, 0 relationship checks"):
        v.enforce_gate(failing, good)


def test_report_all_needs_all_tables(spark):
    with pytest.raises(ValueError, match="customers"):
        v.report_all({}, [CUSTOMERS])


def test_model_tests_count_keys_values_and_rows(spark):
    models = {
        "m": spark.createDataFrame(
            [("a", "bad"), ("a", "bad"), ("b", "worse"), (None, None), ("c", "ok")], "k string, c string"
        ),
        "p": spark.createDataFrame([("b",), ("c",)], "k string"),
    }
    tests = [
        ModelTest("m", "k", "unique"),
        ModelTest("m", "c", "accepted_values", ("ok",)),
        ModelTest("m", "k", "relationships", ("p", "k")),
        ModelTest("m", "k", "not_null"),
        ModelTest("m", "c", "regex", "^b"),
    ]
    report = model_test_report(models, tests).collect()
    assert [r.failures for r in report] == [1, 2, 2, 1, 2]
    assert [r.unit for r in report] == ["keys", "values", "rows", "rows", "rows"]
    with pytest.raises(ValueError):
        ModelTest("m", "k", "median")


def test_duplicated_keys_are_told_apart_where_hashes_are_equal(spark, monkeypatch, capsys):
    from shelfstrata.operators import modeltests

    keys = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), ("c",), ("c",)], "key string")
    modeltests._duplicated(keys).explain()
    assert "Exchange hashpartitioning(hash" in capsys.readouterr().out
    monkeypatch.setattr(modeltests.F, "xxhash64", lambda *columns: F.lit(7))
    assert sorted(r.key for r in modeltests._duplicated(keys).collect()) == ["b", "c"]


def test_keys_are_shuffled_only_where_a_hash_repeats(spark, monkeypatch, capsys):
    from shelfstrata.operators import modeltests

    keys = spark.range(300).selectExpr("if(id % 100 = 7, 'x' || id % 3, cast(id as string)) as key")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        modeltests._duplicated(keys).explain()
        plan = capsys.readouterr().out
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        single = keys.distinct()
        assert modeltests._duplicated(single).count() == 0
        assert sorted(r.key for r in modeltests._duplicated(keys.union(keys.limit(0))).collect()) == []
        repeated = keys.union(keys.filter("key like 'x%'"))
        for few in (modeltests.FEW, 1):
            monkeypatch.setattr(modeltests, "FEW", few)
            assert sorted(r.key for r in modeltests._duplicated(repeated).collect()) == ["x0", "x1", "x2"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_key_counted_before_is_checked_with_the_row_rules(spark, capsys):
    rows = [("CUSTOMER-000001", "gold", 2), ("CUSTOMER-000001", "tin", 2), (None, "gold", 2), (None, None, 2), ("C", "gold", 1)]
    df = spark.createDataFrame(rows, "customer_id string, loyalty_tier string, n long")
    report = v.report(df, CUSTOMERS, "n")
    assert report.collect() == v.report(df.drop("n"), CUSTOMERS).collect()
    assert by_rule(report)["customer_id", "unique"].failed_count == 2
    report.explain()
    assert "Exchange hashpartitioning" not in capsys.readouterr().out
    # Uniqueness on anything else is still counted by a shuffle, and a missing key fails every row.
    other = Contract.of("customers", ["customer_id"], {"loyalty_tier": ["unique"], "customer_id": ["unique"]})
    assert [r.failed_count for r in v.report(df, other, "n").collect()] == [3, 2]
    assert [r.failed_count for r in v.report(df.drop("customer_id"), other, "n").collect()] == [3, 5]


def test_relationships_of_a_table_share_a_pass(spark, capsys):
    lines = spark.createDataFrame(
        [("O1", "P1", 1), ("O1", "P9", 1), ("O2", "P9", 2), (None, "P1", 3), ("O3", None, None)], "o string, p string, s int"
    )
    tables = {
        "lines": lines,
        "none": lines.where("false"),
        "orders": spark.createDataFrame([("O1",), ("O1",), ("P9",), (None,)], "o string"),
        "products": spark.createDataFrame([("P1",), ("O2",)], "p string"),
        "stores": spark.createDataFrame([(2,), (3,)], "s int"),
    }
    related = [
        Relationship("a", "lines", "o", "orders", "o"),
        Relationship("b", "lines", "s", "stores", "s"),
        Relationship("c", "none", "o", "orders", "o"),
        Relationship("d", "lines", "p", "products", "p"),
    ]
    found = v.relationship_report(tables, related).collect()
    assert [(r.table_relationship_name, r.passed, r.failed_count, r.child_count) for r in found] == [
        ("a", False, 2, 3), ("b", False, 1, 3), ("c", True, 0, 0), ("d", False, 1, 2),
    ]
    repeated = {("products", "p"): tables["products"].union(tables["products"])}
    assert v.relationship_report(tables, related, repeated).collect() == found
    v.relationship_report({**tables, "lines": lines.repartition(3, "s")}, [related[0], related[3]]).explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning(s") == 1
