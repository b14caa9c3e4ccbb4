import os
import random
import re

import pytest
from pyspark.sql import functions as F

from cartlens.schemas import SHOPPING
from cartlens.sources.files import read_report, read_shopping, write_report
from cartlens.streaming.ingest import (RedroppedFiles, fields, land_batch, landed_layouts, landed_rejects, read_landed, read_ledger,
                                       redropped, run_ingest)


def write(folder, name, text):
    with open(os.path.join(folder, name), "w", newline="") as fh:
        fh.write(text)


def test_spool_ingest_copies_restart_and_edges(spark, scratch):
    spool, bronze, ckpt = (os.path.join(scratch, d) for d in ("spool", "bronze", "ckpt"))
    os.makedirs(spool)
    header = ",".join(SHOPPING.fieldNames())
    body = "i1,c1,F,30,A,2,5.5,Cash,1/2/2022\r\ni2,c2,M,40,B,1,3.25,Card,2/3/2022"  # no final newline
    write(spool, "sheet1.csv", header + "\r\n" + body)
    write(spool, "sheet2.csv", header + "\r\n" + body)   # same bytes, new name
    write(spool, "empty.csv", header + "\n")              # header only
    write(spool, "smoke.csv", "1,1")                      # any shape lands
    run_ingest(spark, spool, bronze, ckpt)
    landed = spark.read.parquet(bronze)
    assert landed.count() == 2 * 3 + 1 + 1
    assert {r.source_name for r in landed.select("source_name").distinct().collect()} == {
        "sheet1.csv", "sheet2.csv", "empty.csv", "smoke.csv"}
    # restart with one new file: old files are not read again
    write(spool, "sheet3.csv", header + "\n" + "i3,c3,F,50,C,1,1.0,Cash,3/4/2022\n")
    run_ingest(spark, spool, bronze, ckpt)
    assert spark.read.parquet(bronze).count() == 8 + 2
    rows = read_landed(spark, bronze, SHOPPING, source_name="sheet1.csv").collect()
    assert sorted((r.invoice_no, r.quantity, r.price) for r in rows) == [("i1", 2, 5.5), ("i2", 1, 3.25)]
    assert rows[0].invoice_date in ("1/2/2022", "2/3/2022")  # no stray CR on the last field
    assert read_landed(spark, bronze, SHOPPING, source_name="empty.csv").count() == 0
    both = read_landed(spark, bronze, SHOPPING, source_like="sheet%")
    assert both.count() == 5


def test_report_roundtrip_reads_all_parts(spark, scratch):
    df = spark.range(100).select(F.col("id"), (F.col("id") * 2).alias("twice")).repartition(4)
    path = os.path.join(scratch, "report")
    write_report(df, path)
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(parts) == 4
    back = read_report(spark, path, schema=df.schema)
    assert back.count() == 100 and back.agg(F.sum("twice")).first()[0] == 9900
    single = os.path.join(scratch, "single")
    write_report(df, single, single_file=True)
    assert len([f for f in os.listdir(single) if f.startswith("part-")]) == 1


def test_fixed_decimals_and_inventory(spark, scratch):
    from cartlens.sources.files import fixed_decimals, report_inventory
    df = spark.createDataFrame([(1234.5, 3, "x")], "v double, n int, s string")
    assert tuple(fixed_decimals(df).first()) == ("1,234.50", 3, "x")
    root = os.path.join(scratch, "reports")
    write_report(df, f"{root}/a", decimals=2)
    write_report(df.union(df).repartition(2), f"{root}/b")
    inv = {r.report: r.files for r in report_inventory(spark, root).collect()}
    assert inv["a"] >= 1 and inv["b"] >= 1
    assert read_report(spark, f"{root}/a", fixed_decimals(df).schema).first().v == "1,234.50"


def test_spool_batches_and_archive(spark, scratch):
    spool, bronze, ckpt, arch = (os.path.join(scratch, d) for d in ("spool", "bronze", "ckpt", "arch"))
    os.makedirs(spool)
    for i in range(4):
        write(spool, f"f{i}.csv", f"i{i},c{i},F,30,A,1,1.0,Cash,1/1/2022\n")
    q = run_ingest(spark, spool, bronze, ckpt, max_files_per_trigger=1, archive_dir=arch)
    assert spark.read.parquet(bronze).count() == 4
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 4  # one file per batch
    archived = [f for _, _, fs in os.walk(arch) for f in fs if f.endswith(".csv")]
    assert 1 <= len(archived) <= 4      # files of committed batches are moved out of the spool
    assert len(os.listdir(spool)) + len(archived) == 4


def test_polling_stream_picks_up_new_files(spark, scratch):
    from cartlens.streaming.ingest import ingest_spool
    spool, bronze, ckpt = (os.path.join(scratch, d) for d in ("spool", "bronze", "ckpt"))
    os.makedirs(spool)
    write(spool, "a.csv", "i1,c1,F,30,A,1,1.0,Cash,1/1/2022\n")
    q = ingest_spool(spark, spool, bronze, ckpt, available_now=False, processing_time="1 second")
    try:
        q.processAllAvailable()
        write(spool, "b.csv", "i2,c2,F,30,A,1,1.0,Cash,1/1/2022\ni3,c3,F,30,A,1,1.0,Cash,1/1/2022\n")
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(bronze).count() == 3


HEADER = ",".join(SHOPPING.fieldNames())


def test_late_files_are_taken_at_any_age(spark, scratch):
    spool, bronze, ckpt = (os.path.join(scratch, d) for d in ("spool", "bronze", "ckpt"))
    os.makedirs(spool)
    for name, days in (("new.csv", 0), ("mid.csv", 1), ("old.csv", 30)):
        write(spool, name, f"{HEADER}\n{name},c,F,30,A,1,1.0,Cash,1/1/2022\n")
        then = os.path.getmtime(os.path.join(spool, name)) - days * 86400
        os.utime(os.path.join(spool, name), (then, then))
        run_ingest(spark, spool, bronze, ckpt)
    rows = read_landed(spark, bronze, SHOPPING).collect()
    assert sorted(r.invoice_no for r in rows) == ["mid.csv", "new.csv", "old.csv"]


def test_redropped_name_fails_and_is_named(spark, scratch):
    spool, bronze, ckpt = (os.path.join(scratch, d) for d in ("spool", "bronze", "ckpt"))
    os.makedirs(spool)
    write(spool, "a.csv", f"{HEADER}\ni1,c,F,30,A,1,1.0,Cash,1/1/2022\n")
    run_ingest(spark, spool, bronze, ckpt)
    run_ingest(spark, spool, bronze, ckpt)          # the same file: nothing to say
    write(spool, "a.csv", f"{HEADER}\ni1,c,F,30,A,1,1.0,Cash,1/1/2022\ni2,c,F,30,A,1,1.0,Cash,1/1/2022\n")
    write(spool, "b.csv", f"{HEADER}\ni3,c,F,30,A,1,1.0,Cash,1/1/2022\n")
    with pytest.raises(RedroppedFiles, match="a.csv"):
        run_ingest(spark, spool, bronze, ckpt)
    found = redropped(spark, spool, bronze).collect()
    assert [r.source_file.rsplit("/", 1)[1] for r in found] == ["a.csv"]
    run_ingest(spark, spool, bronze, ckpt, on_redrop="ignore")
    assert sorted(r.invoice_no for r in read_landed(spark, bronze, SHOPPING).collect()) == ["i1", "i3"]


def test_landed_lines_are_bound_by_each_files_header(spark, scratch):
    spool, bronze, ckpt = (os.path.join(scratch, d) for d in ("spool", "bronze", "ckpt"))
    os.makedirs(spool)
    write(spool, "plain.csv", f"{HEADER}\ni1,c1,F,30,A,2,5.5,Cash,1/2/2022\n")
    write(spool, "swapped.csv", "Customer_ID,invoice_no,extra," + ",".join(SHOPPING.fieldNames()[2:])
          + "\r\nc2,i2,x,M,many,\"B, C\",1,3.0,Card,2/3/2022\r\n\r\n")
    write(spool, "short.csv", "invoice_no,customer_id\ni3,c3\n")
    run_ingest(spark, spool, bronze, ckpt)
    rows = {r.invoice_no: r for r in read_landed(spark, bronze, SHOPPING, source_like="%p%d%.csv").collect()}
    assert rows["i2"].customer_id == "c2" and rows["i2"].age is None and rows["i2"].category == "B, C"
    assert rows["i2"].quantity == 1 and rows["i2"].invoice_date == "2/3/2022"
    plain = read_landed(spark, bronze, SHOPPING, source_name="plain.csv").first()
    assert (plain.invoice_no, plain.customer_id, plain.price) == ("i1", "c1", 5.5)
    counts = landed_rejects(spark, bronze, SHOPPING, source_name="swapped.csv").first()
    assert (counts.lines, counts.rejected) == (1, 1)
    with pytest.raises(Exception, match="no header line"):
        read_landed(spark, bronze, SHOPPING, source_name="short.csv").collect()
    bare = read_landed(spark, bronze, SHOPPING, source_name="plain.csv", header=False).count()
    assert bare == 2                                # told that there is no header


def test_csv_columns_are_bound_by_name(spark, scratch):
    names = SHOPPING.fieldNames()
    swapped = [names[1], names[0], "extra", *names[2:]]
    one, two, bad = (os.path.join(scratch, d) for d in ("one", "two", "bad"))
    for folder in (one, two, bad):
        os.makedirs(folder)
    write(one, "a.csv", ",".join(swapped) + "\nC1,I1,x,F,30,A,2,5.5,Cash,1/2/2022\n")
    row = read_shopping(spark, one).first()
    assert (row.invoice_no, row.customer_id, row.gender, row.price) == ("I1", "C1", "F", 5.5)
    assert read_shopping(spark, one).columns == names
    write(two, "a.csv", HEADER + "\nI1,C1,F,30,A,2,5.5,Cash,1/2/2022\n")
    write(two, "b.csv", ",".join([names[1], names[0], *names[2:]]) + "\nC2,I2,F,30,A,2,5.5,Cash,1/2/2022\n")
    with pytest.raises(Exception, match="(?i)header"):   # no silent swap in any file
        read_shopping(spark, two).collect()
    write(bad, "a.csv", ",".join(names[1:]) + "\nC1,F,30,A,2,5.5,Cash,1/2/2022\n")
    with pytest.raises(ValueError, match="invoice_no"):
        read_shopping(spark, bad)


def test_fields_equal_the_csv_reader(spark, scratch):
    """Quotes, escaped quotes, commas inside, empty and missing fields; doubled quotes
    are taken as one, which the reader leaves as they are."""
    lines = ['a,b,c', '"a,1",b,"c"', '"a \\"q\\" e",,', ',,', '"",b,""', 'plain only', 'a,"b",c', ' a , "b" ,c',
             'a,"b \\\\ c",d', '"x"']
    df = spark.createDataFrame([(k, line) for k, line in enumerate(lines)], "k int, line string")
    reader = F.from_csv("line", "a string, b string, c string", {"mode": "PERMISSIVE"})
    for r in df.select("line", fields("line").alias("cells"), reader.alias("csv")).collect():
        cells = [c or None for c in r.cells] + [None] * 3
        assert cells[:3] == [c or None for c in r.csv], r.line
    doubled = spark.createDataFrame([('"c ""x"", d",""""',)], "line string").select(fields("line")).first()[0]
    assert doubled == ['c "x", d', '"']
    odd = spark.createDataFrame([('"open,b',), ("x" * 50_000 + "," + ",".join("y" * 3 for _ in range(5000)),)], "line string")
    assert [r.n for r in odd.select(F.size(fields("line")).alias("n")).collect()] == [2, 5001]


@pytest.mark.parametrize("width", [70, 200, 3000])
def test_columns_beyond_any_width_are_bound(spark, scratch, width):
    spool, bronze, ckpt = (os.path.join(scratch, d) for d in ("spool", "bronze", "ckpt"))
    os.makedirs(spool)
    foreign = [f"other{k}" for k in range(width - 9)]
    names = SHOPPING.fieldNames()
    write(spool, "wide.csv", ",".join(foreign + names) + "\n" + "z," * (width - 9) + "i1,c1,F,30,A,2,5.5,Cash,1/2/2022\n")
    run_ingest(spark, spool, bronze, ckpt)
    row = read_landed(spark, bronze, SHOPPING, keep_rejects=True).first()
    assert tuple(row) == ("i1", "c1", "F", 30, "A", 2, 5.5, "Cash", "1/2/2022", False)
    layout = landed_layouts(spark, bronze, SHOPPING).first()
    assert (layout.width, layout.files) == (width, 1) and layout.places == list(range(width - 8, width + 1))


def test_ledger_knows_every_file_and_a_batch_that_runs_again_lands_once(spark, scratch):
    spool, bronze, ckpt = (os.path.join(scratch, d) for d in ("spool", "bronze", "ckpt"))
    os.makedirs(spool)
    write(spool, "a [1]{x}*.csv", f"{HEADER}\ni1,c,F,30,A,1,1.0,Cash,1/1/2022\n")  # a name is no pattern
    write(spool, "c+%20ü.csv", "1,1\n2,2")
    write(spool, "none.csv", "")
    run_ingest(spark, spool, bronze, ckpt)
    taken = {r.source_name: (r.source_length, r.ingest_batch) for r in read_ledger(spark, bronze).collect()}
    assert taken == {"a [1]{x}*.csv": (len(HEADER) + 33, 0), "c+%20ü.csv": (7, 0)}
    assert read_landed(spark, bronze, SHOPPING, source_name="a [1]{x}*.csv").count() == 1
    # the batch runs again, as after a loss between its writing and the checkpoint's commit
    os.remove(os.path.join(ckpt, "commits", "0"))
    os.remove(os.path.join(ckpt, "commits", ".0.crc"))
    run_ingest(spark, spool, bronze, ckpt)
    assert spark.read.parquet(bronze).count() == 4 and read_ledger(spark, bronze).count() == 2
    # ... and when its lines were written and its ledger rows were not
    write(spool, "b.csv", "1,1\n")
    files = spark.read.format("binaryFile").load(os.path.join(spool, "b.csv")).select(
        "path", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_name").alias("source_name"),
        F.col("modificationTime").alias("source_modified"), F.col("length").alias("source_length"))
    for _ in range(2):
        land_batch(files, 7, bronze)
    assert spark.read.parquet(bronze).where("ingest_batch = 7").count() == 1


def test_redropped_empty_file_is_named_and_lines_are_not_read(spark, scratch):
    spool, bronze, ckpt = (os.path.join(scratch, d) for d in ("spool", "bronze", "ckpt"))
    os.makedirs(spool)
    write(spool, "late.csv", "")
    write(spool, "other.csv", "1,1\n")
    run_ingest(spark, spool, bronze, ckpt)
    write(spool, "late.csv", "1,2\n")
    write(spool, "third.csv", "1,3\n")
    with pytest.raises(RedroppedFiles, match="late.csv"):
        run_ingest(spark, spool, bronze, ckpt)
    assert {r.line for r in spark.read.parquet(bronze).collect()} == {"1,1", "1,3"}
    plan = redropped(spark, spool, bronze)._jdf.queryExecution().executedPlan().toString()
    assert "bronze_ledger" in plan and "line#" not in plan


def test_bronze_files_are_bounded_by_bytes(spark, scratch):
    spool, bronze, ckpt = (os.path.join(scratch, d) for d in ("spool", "bronze", "ckpt"))
    os.makedirs(spool)
    for k in range(300):
        write(spool, f"tiny{k}.csv", f"{k},tiny\n")
    write(spool, "huge.csv", "".join(f"{k},huge,{'x' * 90}\n" for k in range(20_000)))  # 2 MB
    query = run_ingest(spark, spool, bronze, ckpt, max_bytes_per_trigger=1 << 20, file_bytes=1 << 20)
    parts = [f for _, _, fs in os.walk(bronze) for f in fs if f.endswith(".parquet")]
    assert len(parts) <= 6 and len([p for p in query.recentProgress if p["numInputRows"]]) >= 2
    landed = spark.read.parquet(bronze)
    assert landed.count() == 20_300 and landed.select("line", "source_name").distinct().count() == 20_300
    with pytest.raises(ValueError, match="files or by bytes"):
        run_ingest(spark, spool, bronze, ckpt, max_bytes_per_trigger=1, max_files_per_trigger=1)


def test_wide_drops_are_sliced_and_leave_the_spool(spark, monkeypatch):
    """Wide files go through the spool a slice at a time, every line once."""
    from cartlens.plans import catalog
    from conftest import SF_SMALL

    held, drained = [], catalog.run_ingest

    def run(spark_, spool, *args, **kwargs):
        base = spool.removesuffix("/*")
        held.append(sorted(os.listdir(base)))
        return drained(spark_, spool, *args, **kwargs)

    monkeypatch.setattr(catalog, "run_ingest", run)
    lines = catalog.shopping_from_tables(spark, SF_SMALL)
    n = lines.count()
    monkeypatch.setattr(catalog, "DROP_CELLS", n * 100)
    bronze = catalog._wide_drops(spark, SF_SMALL, "ingest_sliced")
    assert held == [["0"], ["1"], ["2"]] and os.listdir(os.path.dirname(bronze) + "/spool") == []
    rows = read_landed(spark, bronze, SHOPPING, source_like="part-%")
    assert rows.exceptAll(lines).count() == 0 and rows.count() == n
    found = landed_layouts(spark, bronze, SHOPPING, source_like="part-%").collect()
    assert sorted(r.width for r in found) == [70, 200]


def test_landed_lines_are_not_shuffled_to_their_layouts(spark, scratch):
    spool, bronze, ckpt = (os.path.join(scratch, d) for d in ("spool", "bronze", "ckpt"))
    os.makedirs(spool)
    write(spool, "a.csv", f"{HEADER}\ni1,c,F,30,A,1,1.0,Cash,1/1/2022\n")
    run_ingest(spark, spool, bronze, ckpt)
    rows = read_landed(spark, bronze, SHOPPING)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert rows.count() == 1 and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_the_writer_of_a_ledger_file_reads_prepared_lines(spark, monkeypatch):
    """The one task that writes a file joins nothing."""
    from cartlens.plans import catalog
    from conftest import SF_SMALL

    plans, write_ = [], catalog.write_report

    def watch(df, path, **kwargs):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write_(df, path, **kwargs)

    monkeypatch.setattr(catalog, "write_report", watch)
    got = {r.batch: (r.files, r.lines, r.landed_files) for r in catalog.q_ingest_ledger(spark, SF_SMALL).collect()}
    assert len(plans) == 3 and not any("Join" in p or "Exchange" in p for p in plans)
    lines = catalog.shopping_from_tables(spark, SF_SMALL, ["invoice_no"])
    want = {r.k: (1, r["count"] + 1, 1) for r in lines.groupBy(
        (F.coalesce(F.col("invoice_no").cast("long"), F.lit(0)) % 3).alias("k")).count().collect()}
    assert got == want


OLD_FIELD = r',(?:"[^"\\]*+(?:(?:\\.|"")[^"\\]*+)*+"|[^,]*+)'


def cut(line):
    """The fields of a line by the plain rules, one pattern for all."""
    if '"' not in line:
        return line.split(",")
    found = re.findall(OLD_FIELD, "," + line)
    return [re.sub(r'\\(.)|"(")', r"\1\2", f[2:-1]) if len(f) > 2 and re.search(r'^,".*"$', f) else f[1:] for f in found]


def test_fields_of_odd_lines_are_cut_as_before(spark):
    draw = random.Random(7)
    lines = ["".join(draw.choices('ab",\\ ', weights=(3, 2, 5, 4, 2, 1), k=draw.randint(1, 24))) for _ in range(4000)]
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    for r in df.select("line", fields("line").alias("cells")).collect():
        assert r.cells == cut(r.line), r.line


def test_quotes_are_taken_off_the_bound_fields_only(spark, scratch):
    """A line is cut once, and nothing is done to each of its fields."""
    spool, bronze, ckpt = (os.path.join(scratch, d) for d in ("spool", "bronze", "ckpt"))
    os.makedirs(spool)
    wide = ",".join(f"other{k}" for k in range(90))
    write(spool, "a.csv", f'{wide},{HEADER}\n' + '"a, ""b"" \\"c\\"",' * 90 + '"i,1",c,"F",30,"A ""B"" \\"C\\"",1,1.0,Cash,1/1/2022\n')
    run_ingest(spark, spool, bronze, ckpt)
    rows = read_landed(spark, bronze, SHOPPING)
    assert tuple(rows.first()) == ("i,1", "c", "F", 30, 'A "B" "C"', 1, 1.0, "Cash", "1/1/2022")
    made = [p for p in rows._jdf.queryExecution().optimizedPlan().toString().split("\n") if " AS cells#" in p]
    assert len(made) == 1 and "lambdafunction" not in made[0]


def test_headers_are_found_however_they_are_written(spark, scratch):
    spool, bronze, ckpt = (os.path.join(scratch, d) for d in ("spool", "bronze", "ckpt"))
    os.makedirs(spool)
    rest = ",".join(SHOPPING.fieldNames()[1:])
    for k, first in enumerate(["invoice_no", "\ufeffInvoice_No", ' "in voice_\tNO" ', '"invoice_no"', "INVOICE_NO"]):
        write(spool, f"f{k}.csv", f"{first},{rest}\ni{k},c_invoice_n,F,30,A,1,1.0,Cash,1/1/2022\n")
    run_ingest(spark, spool, bronze, ckpt)
    assert sorted(r.invoice_no for r in read_landed(spark, bronze, SHOPPING).collect()) == [f"i{k}" for k in range(5)]
    assert [(r.width, r.files) for r in landed_layouts(spark, bronze, SHOPPING).collect()] == [(9, 5)]


def test_a_batch_of_much_text_lands_in_many_tasks(spark, scratch):
    spool, bronze, ckpt = (os.path.join(scratch, d) for d in ("spool", "bronze", "ckpt"))
    os.makedirs(spool)
    for k in range(8):
        write(spool, f"f{k}.csv", "".join(f"{k},{i},{'x' * 90}\n" for i in range(10_000)))  # 1 MB
    run_ingest(spark, spool, bronze, ckpt, file_bytes=8 << 20)
    parts = [f for _, _, fs in os.walk(bronze) for f in fs if f.endswith(".parquet")]
    assert len(parts) == 4 and spark.read.parquet(bronze).count() == 80_000


@pytest.mark.parametrize("width, text", [(70, "x"), (200, 'a, "b" c')])
def test_wide_files_are_those_of_the_csv_sink(spark, scratch, width, text):
    """The foreign columns are rendered once for all lines, not cell by cell."""
    from cartlens.plans import catalog

    odd = [("1", "2", "F", 3, 'A, "b"', 4, 5.5, 'Ca"sh', "1/1/2020"), (None,) * 9, ("", " x ", "", 3, "#c\\", None, 1e10, "\\", "1,1")]
    df = spark.createDataFrame(odd * 5, SHOPPING)
    foreign = [F.lit(text).alias(f"other{k}") for k in range(width - 9)]
    for name, some, empty in (("all", df, False), ("none", df.where("false"), True)):
        write_report(some.select(*foreign[:-3], *df.columns[:3:-1], *foreign[-3:], *df.columns[3::-1]), f"{scratch}/csv/{name}")
        lines = catalog._wide(some, width, text, empty)
        assert lines.columns == ["line"]
        write_report(lines, f"{scratch}/text/{name}", "text")
        files = [[open(f"{scratch}/{kind}/{name}/{f}", "rb").read() for f in sorted(os.listdir(f"{scratch}/{kind}/{name}")) if f.startswith("part-")]
                 for kind in ("csv", "text")]
        assert files[0] == files[1]


def test_a_slices_files_are_written_by_as_many_tasks(spark):
    from cartlens.plans import catalog
    from conftest import SF_SMALL

    bronze = catalog._wide_drops(spark, SF_SMALL, "ingest_even")
    even = min(catalog.DROP_FILES, spark.sparkContext.defaultParallelism)
    assert [r.files for r in landed_layouts(spark, bronze, SHOPPING, source_like="part-%").collect()] == [even] * 2
