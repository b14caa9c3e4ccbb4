import os

from cartlens.operators import basket, clean, reports, value, views
from cartlens.schemas import BEHAVIOUR, SHOPPING
from cartlens.sources.files import read_shopping


def test_empty_in_empty_out(spark):
    lines = clean.enrich_shopping(spark.createDataFrame([], SHOPPING))
    seg = reports.customer_segments(lines)
    cats = reports.category_summary(lines)
    pays = reports.payment_summary(lines)
    frames = [
        seg, reports.segment_counts(seg), reports.age_gender(seg), cats,
        reports.month_category(lines), reports.category_preferences(lines), pays,
        reports.payment_by_age(lines), reports.weekday_sales(lines), reports.month_sales(lines),
        basket.basket_pairs(lines), views.segment_share(seg), views.payment_share(pays),
        views.top_categories(cats), views.category_bubble(cats), views.overview(seg, cats, pays,
                                                                                reports.month_sales(lines)),
    ]
    assert all(f.count() == 0 for f in frames)
    vlines = value.prepare_lines(spark.createDataFrame([], SHOPPING))
    feats = value.customer_features(vlines, rel_error=0.0)
    assert feats.count() == 0
    assert value.median_monetary(value.customer_metrics(vlines), rel_error=0.0).first()[0] is None
    beh = spark.createDataFrame([], BEHAVIOUR)
    assert reports.city_segments(beh).count() == 0 and reports.at_risk_customers(beh).count() == 0


def test_permissive_csv_keeps_bad_lines(spark, scratch):
    path = os.path.join(scratch, "shop.csv")
    with open(path, "w") as fh:
        fh.write(",".join(SHOPPING.fieldNames()) + "\n")
        fh.write("i1,c1,F,30,A,2,5.5,Cash,1/2/2022\n")
        fh.write("i2,c2,M,not-an-age,B,1,3.0,Card,2/3/2022\n")
    df = read_shopping(spark, path, keep_corrupt=True).cache()
    rows = {r.invoice_no: r for r in df.collect()}
    assert rows["i1"]._corrupt_record is None and rows["i1"].age == 30
    assert rows["i2"].age is None and rows["i2"]._corrupt_record.startswith("i2,")
    assert read_shopping(spark, path).columns == SHOPPING.fieldNames()
