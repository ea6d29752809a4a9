import pytest

from scanweave.operators.quality import (
    PUBLISHED_CHECKS,
    AcceptedValues,
    NotNull,
    QualityGateError,
    Relationship,
    enforce,
    report,
)


@pytest.fixture(scope="module")
def relations(spark):
    return {
        "silver": spark.createDataFrame(
            [("ABC123", "T1", True), ("XYZ999", None, False), ("XYZ999", "T2", None), (None, "T3", True)],
            "pnr_locator string, bag_tag_number string, is_late_baggage_scan boolean",
        ),
        "bronze": spark.createDataFrame([("abc123",), ("XYZ999",), (None,)], "pnr_locator string"),
        "gold": spark.createDataFrame([("AC1", 2), (None, 1)], "flight_number string, total_bags_tracked long"),
        "orders": spark.createDataFrame(
            [("F",), ("X",), ("X",), ("Y",), (None,)], "status string"
        ),
    }


def counts(df):
    return {row.test: row.failures for row in df.collect()}


def test_report_counts_failures_per_check(relations):
    found = counts(report(relations, PUBLISHED_CHECKS))
    assert found == {
        "not_null_silver_pnr_locator": 1,
        "not_null_silver_bag_tag_number": 1,
        "relationship_silver_pnr_locator_bronze_pnr_locator": 1,
        "accepted_values_silver_is_late_baggage_scan": 0,
        "not_null_gold_flight_number": 1,
        "not_null_gold_total_bags_tracked": 0,
    }


def test_accepted_values_count_distinct_values_and_ignore_null(relations):
    check = AcceptedValues("orders", "status", ("F",))
    assert {tuple(row) for row in check.failing(relations).collect()} == {("X", 2), ("Y", 1)}
    assert counts(report(relations, [check])) == {"accepted_values_orders_status": 2}


def test_relationship_counts_rows_and_ignores_null(spark, relations):
    check = Relationship("bronze", "pnr_locator", "silver", "pnr_locator")
    assert [tuple(row) for row in check.failing(relations).collect()] == [("abc123",)]
    many = relations | {"bronze": spark.createDataFrame([("z",)] * 7 + [("ABC123",)], "pnr_locator string")}
    assert counts(report(many, [check])) == {check.name: 7}


def test_relationship_with_conformed_parent(relations):
    literal = Relationship("silver", "pnr_locator", "bronze", "pnr_locator")
    conformed = Relationship(
        "silver", "pnr_locator", "bronze", "pnr_locator", conform="upper(trim(pnr_locator))"
    )
    assert literal.failing(relations).count() == 1
    assert conformed.failing(relations).count() == 0


def test_gate_raises_with_the_failing_checks(relations):
    with pytest.raises(QualityGateError) as caught:
        enforce(report(relations, [NotNull("gold", "flight_number"), NotNull("gold", "total_bags_tracked")]))
    assert caught.value.failures == {"not_null_gold_flight_number": 1}


def test_gate_passes_clean_tables(relations):
    enforce(report(relations, [NotNull("gold", "total_bags_tracked")]))


def test_null_checks_of_one_table_share_a_scan(relations):
    checks = [NotNull("silver", "pnr_locator"), NotNull("silver", "bag_tag_number")]
    plan = report(relations, checks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LocalRelation") + plan.count("LogicalRDD") == 1


def test_failing_rows_of_a_shared_value_are_whole(spark, relations):
    many = relations | {
        "bronze": spark.createDataFrame([("z", i) for i in range(500)] + [("ABC123", 0)], "pnr_locator string, i int")
    }
    check = Relationship("bronze", "pnr_locator", "silver", "pnr_locator")
    failing = check.failing(many)
    assert failing.columns == ["pnr_locator", "i"]
    assert sorted(row.i for row in failing.collect()) == list(range(500))


def test_relationship_is_one_anti_join(relations):
    check = Relationship("silver", "pnr_locator", "bronze", "pnr_locator")
    plan = check.failing(relations)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 1 and "Generate" not in plan and "explode" not in plan.lower()
