import pytest

from cartlens.operators import clean, reports, views
from cartlens.schemas import SHOPPING


def lines(spark):
    rows = []
    cats = {"A": 50.0, "B": 40.0, "C": 30.0, "D": 20.0, "E": 10.0, "F": 10.0}
    for i, (cat, price) in enumerate(cats.items()):
        for j in range(i + 1):
            rows.append((f"i{i}{j}", f"c{j}", "F" if j % 2 else "M", 20 + 10 * j, cat, 1, price,
                         ["Cash", "Card"][j % 2], f"{1 + j}/{1 + i}/2022"))
    return clean.enrich_shopping(spark.createDataFrame(rows, SHOPPING))


def test_shares_sum_to_100(spark):
    seg = reports.customer_segments(lines(spark))
    shares = views.segment_share(seg).collect()
    assert abs(sum(r.share_pct for r in shares) - 100) < 0.2
    pay = views.payment_share(reports.payment_summary(lines(spark))).collect()
    assert abs(sum(r.share_pct for r in pay) - 100) < 0.2
    assert [r.is_largest for r in pay].count(True) == 1


def test_top_k_is_deterministic_on_ties(spark):
    cats = reports.category_summary(lines(spark))
    top = [r.category for r in views.top_categories(cats, 5).collect()]
    # revenue: A 50, B 80, C 90, D 80, E 50, F 60 -> ties broken by category
    assert top == ["C", "B", "D", "F", "A"]
    bubble = {r.category: r.is_top for r in views.category_bubble(cats, 2).collect()}
    assert sum(bubble.values()) == 2


def test_pivots_and_fill(spark):
    ln = lines(spark)
    pref = reports.category_preferences(ln)
    wide = views.top_category_gender(pref, n=6)
    row = {r.category: r for r in wide.collect()}["A"]
    assert row["F"] == 0.0 and row["M"] == 50.0
    pag = views.pivot_age_gender(reports.age_gender(reports.customer_segments(ln))).collect()
    assert [r.band_order for r in pag] == sorted(r.band_order for r in pag)


def test_patterns_and_overview(spark):
    ln = lines(spark)
    wk = views.weekday_pattern(reports.weekday_sales(ln)).collect()
    assert all(r.weekday_name for r in wk)
    mp = views.month_pattern(reports.month_sales(ln)).collect()
    assert mp[0].month_name == "January" and mp[0].avg_transaction == mp[0].total_revenue / mp[0].transaction_count
    ov = views.overview(reports.customer_segments(ln), reports.category_summary(ln),
                        reports.payment_summary(ln), reports.month_sales(ln))
    assert {r.panel for r in ov.collect()} == {"segment_share", "top_categories", "payment_share",
                                                "monthly_revenue"}
    direct = views.overview_from_lines(ln, reports.segment_label())
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, ov.collect()))
    with pytest.raises(ValueError, match="total_revenue"):
        views.top_categories(ln)
