from datetime import date

import pytest

from fareline.operators import expectations as X


def staged(spark, *rows):
    return spark.createDataFrame(list(rows), "vendor_id long, service_type string, pickup_date date, fare_amount "
                                             "double, pu_location_id long, do_location_id long")


GOOD = (1, "yellow", date(2024, 1, 1), 3.0, 1, 2)


def test_passing_and_failing_tests_are_reported(spark):
    df = staged(spark, GOOD, (None, "boat", date(2024, 1, 1), 3.0, 1, 2), (1, None, date(2024, 1, 1), None, 1, 2))
    report = {(r.column_name, r.test): (r.failing_rows, r.passed) for r in X.check_models({X.STAGED: df}).collect()}
    assert report["vendor_id", "not_null"] == (1, False)
    assert report["service_type", "not_null"] == (1, False)
    assert report["service_type", "accepted_values"] == (1, False)
    assert report["pickup_date", "not_null"] == (0, True)
    with pytest.raises(X.ExpectationFailed, match="vendor_id not_null: 1 rows"):
        X.require_passed(X.check_models({X.STAGED: df}))
    X.require_passed(X.check_models({X.STAGED: staged(spark, GOOD)}))


def test_thirteen_tests_are_declared():
    declared = [e.test for tests in X.EXPECTATIONS.values() for e in tests]
    assert (declared.count("not_null"), declared.count("accepted_values")) == (12, 1)


def test_volume_gate(spark):
    df = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 31),), (date(2024, 2, 1),)], "pickup_date date")
    assert X.require_volume(df, 2024, 1, 2) == 2
    with pytest.raises(X.ExpectationFailed, match="2024-01: 2 rows, expected at least 3"):
        X.require_volume(df, 2024, 1, 3)
    december = spark.createDataFrame([(date(2024, 12, 31),), (date(2025, 1, 1),)], "pickup_date date")
    assert X.volume_gate(december, 2024, 12, 1).first() == ("2024-12", 1, 1, True)
