"""Property checks with generated inputs."""

from decimal import ROUND_HALF_UP, Decimal, localcontext

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartlens.functions.bands import SCHEMES, band
from cartlens.functions.money import as_money, mean, share_pct

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-5, 130)), min_size=1, max_size=40))
def test_bands_are_total(spark, ages):
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    for name, bands in SCHEMES.items():
        labels = [r[0] for r in df.select(band("age", name)).collect()]
        assert len(labels) == len(ages)
        assert set(labels) <= {b[0] for b in bands}
        assert all(lab == bands[-1][0] for a, lab in zip(ages, labels) if a is None)


@SETTINGS
@given(st.lists(st.integers(0, 10_000_000), min_size=1, max_size=30))
def test_mean_is_exact_half_up(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents], "x double")
    got = df.agg(mean(as_money("x"))).first()[0]
    want = (Decimal(sum(cents)) / len(cents) / 100).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert got == float(want)


@SETTINGS
@given(st.integers(100_001, 400_000), st.integers(0, 10**7), st.sampled_from([-1, 0, 1]), st.sampled_from([2, 6]),
       st.booleans())
def test_mean_rounds_once_over_many_rows(spark, n, units, off, scale, negative):
    """Sums next to a tie of the last place, spread over n > 10^5 rows."""
    cents = (units * n + n // 2 + off) // (10 ** (scale - 2)) * (-1 if negative else 1)
    df = spark.range(n).select(F.when(F.col("id") == 0, F.lit(Decimal(cents) / 100)).otherwise(F.lit(Decimal(0)))
                               .cast("decimal(20,2)").alias("x"))
    got = df.agg(mean("x", scale)).first()[0]
    with localcontext() as exact:
        exact.prec = 80
        want = (Decimal(cents) / 100 / n).quantize(Decimal(1).scaleb(-scale), ROUND_HALF_UP)
    assert got == float(want)


def test_one_amount_among_many_zeros(spark):
    df = spark.range(20_001).select(F.when(F.col("id") == 0, 100.0).otherwise(0.0).alias("x"))
    assert df.agg(mean(as_money("x"))).first()[0] == 0.0


def test_product_is_rounded_not_the_price(spark):
    from cartlens.operators.clean import enrich_shopping
    from cartlens.operators.reports import category_summary
    df = spark.createDataFrame([("i", "A", 3, 10.005), ("j", "A", 1, 0.333)],
                               "invoice_no string, category string, quantity int, price double")
    rows = {r.invoice_no: str(r.total_amount) for r in enrich_shopping(df).collect()}
    assert rows == {"i": "30.02", "j": "0.33"}
    assert category_summary(enrich_shopping(df)).first().avg_price == 5.17


@SETTINGS
@given(st.integers(0, 10**7), st.integers(1, 10**7))
def test_share_rounds_once(spark, part, whole):
    got = spark.range(1).select(share_pct(F.lit(part), F.lit(whole))).first()[0]
    assert got == float((Decimal(100 * part) / whole).quantize(Decimal("0.1"), ROUND_HALF_UP))
