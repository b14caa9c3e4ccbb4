import os

from cartlens.operators import reports
from cartlens.schemas import BEHAVIOUR_RAW
from cartlens.sources.files import read_behaviour

HEADER = ",".join(BEHAVIOUR_RAW.fieldNames())
ROWS = [  # invented customers
    "9001,Female,27,Northport,Amber,1310.40,16,4.8,TRUE,21,Satisfied",
    "9002,Male,33,Eastvale,Pearl,705.15,12,4.2,FALSE,17,Neutral",
    "9003,Female,41,Westmoor,Slate,533.35,8,3.1,TRUE,47,Unsatisfied",
    "9004,Male,29,Southby,Amber,1602.60,20,4.9,FALSE,36,Unsatisfied",
    "9005,Male,38,Westmoor,Slate,421.90,7,3.0,TRUE,52,",
    "9006,Female,50,Westmoor,Slate,466.65,11,3.6,FALSE,14,Unsatisfied",
    "9007,Female,35,Eastvale,Pearl,848.80,13,4.1,TRUE,34,Unsatisfied",
]


def write_sheet(folder):
    path = os.path.join(folder, "sheet.csv")
    with open(path, "w", newline="") as fh:
        fh.write("\r\n".join([HEADER] + ROWS))  # CRLF, no final newline
    return path


def test_read_behaviour_crlf_and_empty_last_field(spark, scratch):
    df = read_behaviour(spark, write_sheet(scratch))
    assert df.columns[0] == "customer_id" and df.columns[-1] == "satisfaction_level"
    rows = {r.customer_id: r for r in df.collect()}
    assert len(rows) == 7 and rows[9005].satisfaction_level is None
    assert rows[9007].satisfaction_level == "Unsatisfied"  # last line kept, no stray CR
    assert rows[9001].discount_applied is True and rows[9001].total_spend == 1310.4


def test_segments_and_at_risk(spark, scratch):
    df = read_behaviour(spark, write_sheet(scratch))
    at_risk = sorted(r.customer_id for r in reports.at_risk_customers(df).collect())
    assert at_risk == [9003, 9004, 9007]          # 9005 has a null level, 9006 is recent
    assert len(reports.at_risk_customers(df).columns) == 11
    city = {r.city: (r.avg_total_spend, r.items_purchased) for r in reports.city_segments(df).collect()}
    assert city["Westmoor"] == (500.0, 19)      # 9005 dropped: (533.35 + 466.65) / 2
    seg = {(r.membership_type, r.age_group, r.city): r.avg_total_spend
           for r in reports.membership_segments(df).collect()}
    assert seg[("Slate", "Between 35-50", "Westmoor")] == 500.0
    assert seg[("Amber", "Under 35", "Southby")] == 1602.6
    assert ("Slate", "Over 50", "Westmoor") not in seg   # 50 is in the closed 35-50 band


def test_six_place_mean(spark):
    df = spark.createDataFrame([("X", 1.0, 1), ("X", 1.0, 1), ("X", 2.0, 1)],
                               "city string, total_spend double, items_purchased int")
    from cartlens.schemas import BEHAVIOUR
    full = df.selectExpr(*[f"{c}" if c in df.columns else
                           f"cast({'1' if t.simpleString() != 'string' else chr(39) + 'x' + chr(39)} as "
                           f"{t.simpleString()}) as {c}"
                           for c, t in ((f.name, f.dataType) for f in BEHAVIOUR.fields)])
    out = reports.city_segments(full).first()
    assert out.avg_total_spend == 1.333333 and out.items_purchased == 3
