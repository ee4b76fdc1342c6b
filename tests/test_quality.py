import json

import pytest
from pyspark.sql import functions as F

from tillstream.operators import quality as Q

ORDERS = "order_id string, order_status string, amount double"


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame(
        [("1", "delivered", 1.0), ("1", "Shipped", 0.0), (None, None, -1.0), (None, "lost", None), ("2", " ", 5.0)],
        ORDERS,
    )


def test_violation_queries(orders):
    assert Q.null_rows(orders, "order_id").count() == 2
    assert Q.duplicate_keys(orders, "order_id").count() == 2
    assert [r[:] for r in Q.duplicate_keys(orders, "order_id", nulls_equal=False).collect()] == [("1", 2)]
    # Upper case passes, a null passes, anything else does not.
    assert {r.order_status for r in Q.outside_domain(orders, "order_status", ["delivered", "shipped"]).collect()} == {"lost", " "}
    assert Q.not_positive(orders, "amount").count() == 2
    assert Q.blank_rows(orders, "order_id", "order_status").count() == 3


def test_check_status(spark, orders):
    results = [
        Q.run_check("nulls", lambda: Q.null_rows(orders, "order_id")),
        Q.run_check("positive", lambda: orders.where("amount > 100")),
        Q.run_check("absent", lambda: spark.table("no_such_table")),
    ]
    assert [(r.status, r.row_count) for r in results] == [("failed", 2), ("passed", 0), ("skipped", 0)]
    assert Q.summarize_results(Q.results_frame(spark, results)).first()[:] == (1, 1, 1)


@pytest.mark.parametrize("with_key", [True, False])
def test_one_pass_over_a_table(orders, with_key):
    expectations = [
        Q.not_null("order_id"),
        Q.accepted("order_status", ["delivered", "Shipped", " "]),
        Q.positive("amount"),
        Q.rows_above(5),
        Q.rows_above(4),
    ] + [Q.unique("order_id"), Q.unique("order_status")] * with_key
    got = {(r.expectation, r.column_name): (r.status, r.failures) for r in Q.check_table("t", orders, expectations).collect()}
    assert got[("not_null", "order_id")] == ("failed", 2)
    assert got[("accepted_values", "order_status")] == ("failed", 1)
    assert got[("positive", "amount")] == ("failed", 2)
    if with_key:
        assert got[("unique", "order_id")] == ("failed", 2)
        assert got[("unique", "order_status")] == ("passed", 0)
    statuses = [r.status for r in Q.check_table("t", orders, [Q.rows_above(5), Q.rows_above(4)]).collect()]
    assert statuses == ["failed", "passed"]


def test_checks_of_an_empty_table(orders):
    got = Q.check_table("t", orders.where("false"), [Q.not_null("order_id"), Q.unique("order_id"), Q.rows_above(0)]).collect()
    assert [r.status for r in got] == ["passed", "passed", "failed"]


def test_suite_skips_absent_tables(spark):
    results = Q.check_suite(spark, Q.catalog_tables(spark, ["nowhere.a"]), Q.SUITE)
    assert results.count() == 19
    assert Q.summarize_results(results).first()[:] == (0, 0, 19)
    assert len(Q.MODEL_TESTS) == 14


def test_report_and_strict_mode(spark, orders, tmp_path):
    failing = Q.check_table("t", orders, [Q.not_null("order_id")])
    with pytest.raises(RuntimeError, match="1 quality checks failed"):
        Q.write_report(failing, str(tmp_path / "r"))
    Q.write_report(failing, str(tmp_path / "r"), contracts=[{"owner": "shop"}], strict=False)
    document = json.loads(next((tmp_path / "r").glob("part-*.json")).read_text())
    assert document["summary"] == {"passed": 0, "failed": 1, "skipped": 0}
    assert document["results"][0]["failures"] == 2
    skipped = Q.check_suite(spark, {}, {"a.b": (Q.rows_above(0),)})
    Q.write_report(skipped, str(tmp_path / "s"))


def test_a_table_that_cannot_be_read_skips_itself_only(spark, orders, tmp_path):
    good = spark.createDataFrame([("1",), (None,)], "code string")
    good.write.parquet(str(tmp_path / "gone"))
    gone = spark.read.parquet(str(tmp_path / "gone"))
    for part in (tmp_path / "gone").glob("part-*"):
        part.unlink()
    lost = good.withColumn("code", F.raise_error(F.lit("executor lost")).cast("string"))
    tables = {"a": good, "b": good.select(F.lit(1).alias("other")), "c": None, "d": lambda: spark.table("no_such_table"), "e": gone, "f": lost}
    results = Q.run_suite(spark, tables, {name: (Q.not_null("code"),) for name in tables}).collect()
    assert [(r.table_name, r.status, r.failures) for r in results] == [
        ("a", "failed", 1), ("b", "skipped", 0), ("c", "skipped", 0), ("d", "skipped", 0), ("e", "skipped", 0), ("f", "failed", 0),
    ]
    assert [r.error is None for r in results] == [True, False, True, False, False, False]
    assert Q.run_check("lost", lambda: lost.where("code = 'x'")).status == "failed"
    assert Q.run_check("gone", lambda: gone.where("code = 'x'")).status == "skipped"
