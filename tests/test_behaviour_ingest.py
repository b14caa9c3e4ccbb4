"""A landing folder of smoke files and copies of an invented behaviour sheet,
ingested and read back against the plain CSV reader."""

import os
import random

from pyspark.sql import functions as F

from cartlens.schemas import BEHAVIOUR_RAW
from cartlens.sources.files import read_behaviour, snake_case_behaviour
from cartlens.operators import reports
from cartlens.streaming.ingest import read_landed, run_ingest


def sheet(n=120):
    rng = random.Random(8)
    rows = [",".join(BEHAVIOUR_RAW.fieldNames())]
    for k in range(n):
        level = rng.choice(["Satisfied", "Neutral", "Unsatisfied"]) if k % 40 else ""
        rows.append(f"{7000 + k},{rng.choice(['Female', 'Male'])},{rng.randint(18, 70)},Town {k % 5},Tier {k % 3},"
                    f"{rng.randint(100, 90000) / 100},{rng.randint(1, 30)},{rng.randint(10, 50) / 10},"
                    f"{rng.choice(['TRUE', 'FALSE'])},{rng.randint(1, 70)},{level}")
    return "\r\n".join(rows)  # no final newline


def test_landing_folder(spark, scratch):
    spool, bronze, ckpt = (os.path.join(scratch, d) for d in ("spool", "bronze", "ckpt"))
    os.makedirs(spool)
    files = {f"copy{k}.csv": sheet() for k in range(4)} | {f"smoke{k}.txt": "1,1" for k in range(3)}
    for name, text in files.items():
        with open(os.path.join(spool, name), "w", newline="") as f:
            f.write(text)
    run_ingest(spark, spool, bronze, ckpt)
    landed = spark.read.parquet(bronze)
    per_file = {r.source_name: r["count"] for r in landed.groupBy("source_name").count().collect()}
    assert per_file == {name: text.count("\n") + 1 for name, text in files.items()}
    back = snake_case_behaviour(read_landed(spark, bronze, BEHAVIOUR_RAW, source_name="copy2.csv"))
    direct = read_behaviour(spark, os.path.join(spool, "copy2.csv"))
    assert back.count() == 120 and back.na.drop().count() == 117
    assert back.exceptAll(direct).count() == 0 and direct.exceptAll(back).count() == 0
    rows = [r for r in direct.collect() if r.satisfaction_level]
    assert reports.at_risk_customers(back).count() == sum(
        r.days_since_last_purchase > 30 and r.satisfaction_level == "Unsatisfied" for r in rows)
    run_ingest(spark, spool, bronze, ckpt)      # restart: nothing new is read
    assert spark.read.parquet(bronze).count() == landed.count()
    assert landed.where(F.col("line").contains("\r")).count() == 0
