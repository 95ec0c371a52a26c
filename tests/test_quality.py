import pytest
from pyspark.sql import functions as F

from quayside.operators import quality as q


@pytest.fixture(scope="module")
def tables(spark):
    child = spark.createDataFrame([(1, 10, "A"), (2, 10, "B"), (2, 99, "Z"), (None, None, None)], "id int, fk int, v string")
    parent = spark.createDataFrame([(10,), (11,)], "id int")
    return {"child": child, "parent": parent}


def test_operators_return_the_violations(tables):
    child, parent = tables["child"], tables["parent"]
    assert [tuple(r) for r in q.duplicate_keys(child, "id").collect()] == [(2, 2)]
    assert q.duplicate_keys(parent, "id").count() == 0
    assert q.missing_values(child, "v").count() == 1
    assert q.missing_values(parent, "id").count() == 0
    assert {r[0]: r[1] for r in q.missing_value_counts(child, ["id", "fk", "v"]).collect()} == {"id": 1, "fk": 1, "v": 1}
    assert [tuple(r) for r in q.orphan_keys(child, "fk", parent, "id").collect()] == [(99, 1)]
    assert q.orphan_keys(parent, "id", parent, "id").count() == 0
    assert [tuple(r) for r in q.unaccepted_values(child, "v", ["A", "B"]).collect()] == [("Z", 1)]
    assert q.unaccepted_values(child, "v", ["A", "B", "Z"]).count() == 0


def test_suite_and_gate(tables):
    rules = [
        q.Rule("child", "unique", "id"),
        q.Rule("child", "not_null", "fk"),
        q.Rule("child", "accepted_values", "v"),
        q.Rule("child", "relationships", "fk", "parent", "id"),
        q.Rule("parent", "unique", "id"),
    ]
    results = q.run_suite(tables.__getitem__, rules, {"v": ["A", "B"]})
    failures = {(r["table_name"], r["test_kind"]): (r["failures"], r["passed"]) for r in results.collect()}
    assert failures == {
        ("child", "unique"): (1, False),
        ("child", "not_null"): (1, False),
        ("child", "accepted_values"): (1, False),
        ("child", "relationships"): (1, False),
        ("parent", "unique"): (0, True),
    }
    with pytest.raises(q.QualityError, match="4 data tests failed"):
        q.require_passed(results)
    q.require_passed(results.filter("passed"))


def test_declared_rules():
    rules = q.SILVER_RULES + q.GOLD_RULES
    kinds = [r.kind for r in rules]
    assert (len(rules), len({r.name for r in rules})) == (99, 99)
    assert [kinds.count(k) for k in ("unique", "not_null", "relationships", "accepted_values")] == [17, 62, 10, 10]


def test_boolean_labels_are_compared_as_numbers(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "late_delivery_risk boolean")
    assert q.unaccepted_values(df, "late_delivery_risk", [0, 1]).count() == 0
    assert q.unaccepted_values(df, "late_delivery_risk", [0]).agg(F.sum("row_count")).first()[0] == 1
