import pytest

from deliverylens.operators import fact as J
from deliverylens.operators.quality import assert_quality, quality_report
from tests.fixtures import staging


def test_quality_passes_on_clean_fact(spark):
    f = J.build_fact(staging(spark))
    checks = assert_quality(quality_report(f))
    assert [v for _, v in checks] == [4, 0, 0, 0, 0]


@pytest.mark.parametrize("expr, name", [
    ("CASE WHEN order_id = 'o1' THEN '' ELSE order_id END AS order_id", "No NULL order_id"),
    ("-actual_delivery_days AS actual_delivery_days", "No negative actual_delivery_days"),
    ("CASE WHEN review_score = 5 THEN 6 ELSE review_score END AS review_score",
     "review_score in range 1-5 or NULL"),
    ("is_delayed + 2 AS is_delayed", "is_delayed only 0 or 1"),
])
def test_each_check_fails_on_a_broken_row(spark, expr, name):
    f = J.build_fact(staging(spark))
    col = expr.split(" AS ")[-1]
    broken = f.selectExpr(*[c for c in f.columns if c != col], expr)
    with pytest.raises(ValueError, match=name):
        assert_quality(quality_report(broken))


def test_empty_fact_fails_count_check(spark):
    f = J.build_fact(staging(spark)).limit(0)
    with pytest.raises(ValueError, match="row count"):
        assert_quality(quality_report(f))
