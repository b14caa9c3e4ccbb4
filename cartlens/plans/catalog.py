"""The query catalogue: every operator applied to the test tables.

Each entry is ``f(spark, sf_dir) -> DataFrame`` and reads whole tables. The
segment thresholds are scaled to the test data (the source's 1000/10/100 are
meant for single shopping baskets; on order-sized lines nearly everyone would
be "High Value").
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..operators import basket, clean, reports, value, views
from ..schemas import BEHAVIOUR_RENAME, BRONZE, SHOPPING
from ..session import checkpointed, remove_shared, shared_path
from ..sources.files import (fixed_decimals, read_behaviour, read_report, read_shopping, report_inventory,
                             write_report)
from ..sources.report_set import ReportSet
from ..sources.tables import behaviour_from_tables, shopping_from_tables
from ..streaming.ingest import landed_layouts, landed_rejects, read_landed, read_ledger, run_ingest

SEGMENT_THRESHOLDS = dict(high_value=1_200_000.0, frequent=45, high_ticket=28_000.0)

# The pivoted domains of the test tables (so that no job looks them up).
GENDERS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
METHODS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

#: Cells (lines times columns) of the wide files that are in the spool at a time, about,
#: and the files they are written as.
DROP_CELLS, DROP_FILES = 160_000_000, 8

#: Folders of the forests' node tables in the shared folder.
FOREST, SPEND_FOREST = "forest", "spend_forest"

CUSTOMER_COLS = ["invoice_no", "customer_id", "gender", "age", "quantity", "price"]


def materialized(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (``spark.checkpoint.dir``) of an input that a view
    reads more than once; the computation behind it then runs once."""
    return checkpointed(df)


def lines(spark, sf, columns=None) -> DataFrame:
    return clean.enrich_shopping(shopping_from_tables(spark, sf, columns))


def segments(spark, sf) -> DataFrame:
    return reports.customer_segments(lines(spark, sf, CUSTOMER_COLS), **SEGMENT_THRESHOLDS)


def categories(spark, sf) -> DataFrame:
    return reports.category_summary(lines(spark, sf, ["invoice_no", "category", "quantity", "price"]))


def monthly_categories(spark, sf) -> DataFrame:
    return reports.month_category(
        lines(spark, sf, ["invoice_no", "category", "quantity", "price", "invoice_date"]))


def preferences(spark, sf) -> DataFrame:
    return reports.category_preferences(
        lines(spark, sf, ["invoice_no", "category", "gender", "age", "quantity", "price"]))


def payments(spark, sf) -> DataFrame:
    return reports.payment_summary(
        lines(spark, sf, ["invoice_no", "payment_method", "quantity", "price"]))


def dated(spark, sf) -> DataFrame:
    return lines(spark, sf, ["invoice_no", "quantity", "price", "invoice_date"])


def wide_lines(spark, sf, columns) -> DataFrame:
    """Lines with one category per customer: a wide domain, with absent cells."""
    shopping = shopping_from_tables(spark, sf, ["customer_id", *columns])
    return clean.enrich_shopping(shopping.withColumn("category", F.col("customer_id")))


def value_lines(spark, sf, key=None) -> DataFrame:
    cols = ["invoice_no", "quantity", "price"] + ([key] if key else [])
    if key is None:
        cols = CUSTOMER_COLS
    return value.prepare_lines(shopping_from_tables(spark, sf, cols))


def metrics(spark, sf) -> DataFrame:
    return materialized(value.customer_metrics(value_lines(spark, sf)))


def features(spark, sf) -> DataFrame:
    return value.features_of(metrics(spark, sf), rel_error=0.0)


def behaviour(spark, sf) -> DataFrame:
    return behaviour_from_tables(spark, sf)


def _forest(spark, sf):
    """The fitted forest as its node table (in the shared folder, which the SQL of the
    model queries reads back) and the rows to score with it."""
    vectors = materialized(value.value_features(features(spark, sf)))
    train, test = value.split_customers(vectors)
    return value.forest_nodes(value.value_model(train), shared_path(spark, FOREST)), test


def _scored(spark, sf):
    nodes, test = _forest(spark, sf)
    # nine digits: sums over trees in any order agree
    return value.score_nodes(test, nodes).withColumn("p_high", F.round("p_high", 9))


def q_value_predictions(spark, sf):
    return _scored(spark, sf).select("customer_id", "customer_value", (F.col("p_high") > 0.5).cast("int").alias("prediction"), "p_high")


def q_value_auc(spark, sf):
    auc = value.rank_auc(_scored(spark, sf), "p_high", "customer_value")
    return auc.select(F.lit("areaUnderROC").alias("metric"), F.col("auc").alias("value"))


def q_feature_importance(spark, sf):
    nodes, _ = _forest(spark, sf)
    return value.node_importance(nodes).withColumn("importance", F.round("importance", 9))


def q_spend_regression(spark, sf):
    """Spend predicted from the other features, for the customers held out, in cents."""
    vectors = materialized(value.value_features(metrics(spark, sf), value.SPEND_FEATURES))
    train, test = value.split_customers(vectors)
    nodes = value.forest_nodes(value.spend_model(train), shared_path(spark, SPEND_FOREST), value.SPEND_FEATURES)
    scored = value.score_nodes(test, nodes, "prediction")
    return scored.select("customer_id", "monetary", F.round("prediction", 2).alias("prediction"))


def q_spend_errors(spark, sf):
    """The errors of those predictions."""
    errors = value.regression_errors(materialized(q_spend_regression(spark, sf)))  # the trees are walked once
    return errors.select("n", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2")])


def _comparable(df, *columns):
    """Integer columns that hold nulls as doubles: clients show those alike."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def q_enrich_dates(spark, sf):
    df = lines(spark, sf, ["invoice_no", "category", "age", "quantity", "price", "invoice_date"])
    df = _comparable(df, "quantity", "month", "year", "day_of_week")
    return df.select("invoice_no", "category", "quantity", F.col("price").cast("double").alias("price"),
                     F.col("total_amount").cast("double").alias("total_amount"),
                     # ISO text: compares the same in any engine (timestamp units differ)
                     F.date_format("invoice_date", "yyyy-MM-dd HH:mm:ss").alias("invoice_date"),
                     "valid_date", "month", "year", "day_of_week", "age_group")


def _drain(spark, name, *drops, fmt="csv"):
    """Write each frame into a spool folder and drain it into bronze, one after
    the other; a frame may come with the age in days its files shall have. Files
    leave the spool when they have landed, so it holds one frame's at a time."""
    base = shared_path(spark, name, unique=True)
    for k, (df, age) in enumerate(drops):
        write_report(df, f"{base}/spool/{k}", fmt)
        if age:
            _backdate(spark, f"{base}/spool/{k}", age)
        run_ingest(spark, f"{base}/spool/*", f"{base}/bronze", f"{base}/_checkpoint")
        remove_shared(spark, f"{base}/spool/{k}")
    return f"{base}/bronze"


def _staged_apart(spark, name, df, *by):
    """``df`` written once, in a folder for each value of the columns ``by``, and read back.
    What was shuffled for it is removed then."""
    path, tidy = shared_path(spark, name, "lines", unique=True), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(tidy, None)
    spark.conf.set(tidy, "true")
    try:
        df.write.partitionBy(*by).option("compression", "zstd").parquet(path)
    finally:
        if was is None:
            spark.conf.unset(tidy)
        else:
            spark.conf.set(tidy, was)
    return spark.read.schema(df.schema).parquet(path)


def _backdate(spark, folder, days):
    """Set the modification time of a folder's files (file metadata only)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(path):
        then = status.getModificationTime() - days * 86_400_000
        fs.setTimes(status.getPath(), then, then)


def q_ingest_roundtrip(spark, sf):
    """Shopping lines written as CSV files into a spool folder, drained by the
    stream into bronze, and parsed back to typed rows."""
    bronze = _drain(spark, "ingest", (shopping_from_tables(spark, sf), 0))
    return _comparable(read_landed(spark, bronze, SHOPPING, source_like="part-%"), "quantity")


def q_ingest_late_files(spark, sf):
    """The lines in two drains; the second one's files are 30 days older."""
    lines = shopping_from_tables(spark, sf)
    late = F.pmod(F.coalesce(F.xxhash64("customer_id"), F.lit(0)), F.lit(3)) == 0
    bronze = _drain(spark, "ingest_late", (lines.where(~late), 0), (lines.where(late), 30))
    return _comparable(read_landed(spark, bronze, SHOPPING, source_like="part-%"), "quantity")


def _reordered(df):
    """The columns in reverse order, with a foreign one between."""
    return df.select(*df.columns[:4:-1], F.lit("x").alias("remark"), *df.columns[4::-1])


def q_ingest_reordered(spark, sf):
    """The lines as files with another column order and a foreign column."""
    bronze = _drain(spark, "ingest_reordered", (_reordered(shopping_from_tables(spark, sf)), 0))
    return _comparable(read_landed(spark, bronze, SHOPPING, source_like="part-%"), "quantity")


def q_ingest_rejects(spark, sf):
    """The lines with a quantity that is no number on every seventh order."""
    lines = shopping_from_tables(spark, sf).withColumn(
        "quantity", F.when(F.col("invoice_no").cast("long") % 7 == 0, "many").otherwise(F.col("quantity").cast("string")))
    bronze = _drain(spark, "ingest_rejects", (lines, 0))
    return (landed_rejects(spark, bronze, SHOPPING, source_like="part-%")
            .agg(F.sum("lines").alias("lines"), F.sum("rejected").alias("rejected")))


def _rendered(columns, groups):
    """``columns`` as the CSV sink writes them, a group of neighbours at a time: one of
    constants only is rendered once, not for every line."""
    ends = [sum(groups[:k + 1]) for k in range(len(groups))]
    return F.concat_ws(",", *[F.to_csv(F.struct(*columns[end - n:end])) for n, end in zip(groups, ends) if n])


def _wide(df, width, text, empty=False):
    """The columns in reverse order behind and between foreign ones, ``width`` in all, as the
    lines of CSV files: a header is the first line of every task, or of one if all are ``empty``."""
    foreign = [F.lit(text).alias(f"other{k}") for k in range(width - len(df.columns))]
    mine = [F.col(c) for c in df.columns]
    columns = [*foreign[:-3], *mine[:3:-1], *foreign[-3:], *mine[3::-1]]
    groups = [len(foreign) - 3, len(mine) - 4, 3, 4]
    named = df.select(*columns).columns
    head = _rendered([F.lit(n).alias(n) for n in named], [width])
    if empty:
        return df.sparkSession.range(0, 1, 1, 1).select(head.alias("line"))
    first = F.monotonically_increasing_id() % (1 << 33) == 0  # the task's rows are numbered from here on
    line = _rendered(columns, groups)
    return df.select(F.explode(F.when(first, F.array(head, line)).otherwise(F.array(line))).alias("line"))


def _wide_drops(spark, sf, name):
    """The lines as wide files, dropped and drained in slices of about DROP_CELLS: the
    files are many times as large as the tables and are never all in the spool."""
    lines = shopping_from_tables(spark, sf)
    far = F.pmod(F.coalesce(F.xxhash64("customer_id"), F.lit(0)), F.lit(2)) == 0
    n = shopping_from_tables(spark, sf, ["invoice_no"]).count()
    slices = {width: max(1, -(-n * width // DROP_CELLS)) for width in (70, 200)}
    line = F.xxhash64(*lines.columns)
    number = F.when(far, F.pmod(line, F.lit(slices[200]))).otherwise(F.pmod(line, F.lit(slices[70])))
    file = F.pmod(F.xxhash64(F.lit(1), *lines.columns), F.lit(DROP_FILES))
    # a slice's files lie in as many tasks, each slice's in others
    tasks = max(DROP_FILES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    task = F.pmod(F.xxhash64("__width", "__slice") + file, F.lit(tasks)).cast("int")
    staged = _staged_apart(spark, name, lines.withColumns(
        {"__width": F.when(far, 200).otherwise(70), "__slice": number.cast("int")}).repartitionById(tasks, task),
        "__width", "__slice")
    full = {tuple(r) for r in staged.select("__width", "__slice").distinct().collect()}
    drops = [(_wide(staged.where((F.col("__width") == width) & (F.col("__slice") == k)).select(*lines.columns), width, text,
                    empty=(width, k) not in full), 0)
             for width, text in ((70, "x"), (200, 'a, "b" c')) for k in range(slices[width])]
    return _drain(spark, name, *drops, fmt="text")


def q_ingest_wide(spark, sf):
    """The lines as files of 70 and of 200 columns, the latter with quoted commas."""
    bronze = _wide_drops(spark, sf, "ingest_wide")
    return _comparable(read_landed(spark, bronze, SHOPPING, source_like="part-%"), "quantity")


def q_ingest_layouts(spark, sf):
    """The distinct header layouts of those files."""
    found = landed_layouts(spark, _wide_drops(spark, sf, "ingest_layouts"), SHOPPING, source_like="part-%")
    return found.select("width", F.array_join("places", " ").alias("places"), (F.col("files") > 0).alias("seen"))


def _empty_file(spark, path):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where).close()


def q_ingest_ledger(spark, sf):
    """Three drains of a file each, the second with an empty file besides: what the
    ledger holds of each micro-batch, the lines that landed, and of how many files.
    A file is written by one task, so the lines are made before, by many tasks and once
    for all drains; the writer reads its file's columns as compressed Parquet."""
    base, lines = shared_path(spark, "ingest_ledger", unique=True), shopping_from_tables(spark, sf)
    rest = F.coalesce(F.col("invoice_no").cast("long"), F.lit(0)) % 3
    staged = _staged_apart(spark, "ingest_ledger", lines.withColumn("__rest", rest.cast("int"))
                           .sortWithinPartitions("__rest", "invoice_no"), "__rest")
    for k in range(3):
        write_report(staged.where(F.col("__rest") == k).select(*lines.columns), f"{base}/spool/{k}", single_file=True)
        if k == 1:
            _empty_file(spark, f"{base}/spool/{k}/nothing.csv")
        run_ingest(spark, f"{base}/spool/*", f"{base}/bronze", f"{base}/_checkpoint")
    files = read_ledger(spark, f"{base}/bronze").groupBy(F.col("ingest_batch").alias("batch")).agg(
        F.count("*").alias("files"))
    landed = spark.read.schema(BRONZE).parquet(f"{base}/bronze").groupBy("ingest_batch").agg(
        F.count("*").alias("lines"), F.count_distinct("source_file").alias("landed_files"))
    return files.join(landed, F.col("batch") == F.col("ingest_batch")).drop("ingest_batch")


def q_shopping_csv_reordered(spark, sf):
    """Shopping lines written in another column order, bound back by name."""
    path = shared_path(spark, "csv", "shopping_reordered", unique=True)
    write_report(_reordered(shopping_from_tables(spark, sf)), path)
    return _comparable(read_shopping(spark, path), "quantity")


def q_exact_price(spark, sf):
    """Amounts and means over prices with more than two decimals."""
    sold = shopping_from_tables(spark, sf, ["category", "quantity", "price", "invoice_no"])
    sold = sold.withColumn("price", F.col("price") * F.lit(1.0) - F.lit(0.005))
    return reports.category_summary(clean.enrich_shopping(sold)).select(
        "category", "total_revenue", "avg_price")


def q_sorted_positions(spark, sf):
    """The category report's rows with their place in its order."""
    place = F.row_number().over(Window.orderBy(F.monotonically_increasing_id()))
    return categories(spark, sf).select(place.alias("place"), "category", "total_revenue")


def q_value_test_keys(spark, sf):
    """The customers the model is tested on, with their labels."""
    _, test = value.split_customers(value.value_features(features(spark, sf)))
    return test.select("customer_id", "customer_value")


def q_report_inventory(spark, sf):
    """Report folders with files, and whether their parts hold anything."""
    base = shared_path(spark, "inventory", unique=True)
    write_report(categories(spark, sf), f"{base}/category_analysis", single_file=True)
    write_report(payments(spark, sf), f"{base}/payment_analysis", single_file=True)
    return report_inventory(spark, base).select("report", "files", (F.col("bytes") > 0).alias("filled"))


def q_run_status(spark, sf):
    """The status table of a run over lines that lack the payment method."""
    from . import runs
    root = shared_path(spark, "runs", unique=True)
    runs.shopping_run(spark, shopping_from_tables(spark, sf).drop("payment_method"), root, SEGMENT_THRESHOLDS)
    status = ReportSet(spark, root).read("run_status", spark.createDataFrame([], runs.STATUS).schema, "parquet")
    return (status.where(~F.col("report").startswith("views/"))
            .select("report", "state", F.coalesce("rows", F.lit(-1)).cast("long").alias("rows")))


def q_report_set(spark, sf):
    """The category report of the current set, after a published run over the lines of
    even orders, one over all, and one that stopped half-way."""
    found = ReportSet(spark, shared_path(spark, "report_set", unique=True))
    lines = shopping_from_tables(spark, sf, ["invoice_no", "category", "quantity", "price"])
    for only, publish in ((F.col("invoice_no") % 2 == 0, True), (F.lit(True), True), (F.col("invoice_no") % 3 == 0, False)):
        version = found.begin()
        report = reports.category_summary(clean.enrich_shopping(lines.where(only)))
        write_report(report, f"{version}/category_analysis", fmt="parquet")
        if publish:
            found.publish(version)
    return found.read("category_analysis", report.schema, "parquet")


def q_shopping_csv(spark, sf):
    """Shopping lines written as CSV with a header and scanned back with the
    explicit-schema reader."""
    path = shared_path(spark, "csv", "shopping", unique=True)
    write_report(shopping_from_tables(spark, sf), path)
    return _comparable(read_shopping(spark, path), "quantity")


def q_behaviour_csv(spark, sf):
    """Behaviour rows written as CSV under the sheet's header names (with
    spaces) and read back with the behaviour reader."""
    path = shared_path(spark, "csv", "behaviour", unique=True)
    raw = {v: k for k, v in BEHAVIOUR_RENAME.items()}
    sheet = behaviour(spark, sf)
    write_report(sheet.select(*[F.col(c).alias(raw[c]) for c in sheet.columns]), path)
    return read_behaviour(spark, path)


def q_report_roundtrip(spark, sf):
    """A multi-part report written as CSV and read back from all its parts."""
    path = shared_path(spark, "reports", "customer_segments", unique=True)
    seg = segments(spark, sf)
    write_report(seg, path)
    return read_report(spark, path, schema=seg.schema)


def queries() -> dict:
    R, V, C = reports, views, clean
    return {
        # segmentation
        "customer_stats": lambda s, d: R.customer_stats(lines(s, d, CUSTOMER_COLS)),
        "customer_segments": segments,
        "segment_counts": lambda s, d: R.segment_counts(segments(s, d)),
        "age_gender": lambda s, d: R.age_gender(segments(s, d)),
        # categories, payments, time
        "category_summary": categories,
        "month_category": monthly_categories,
        "category_preferences": preferences,
        "payment_summary": payments,
        "payment_by_age": lambda s, d: R.payment_by_age(
            lines(s, d, ["invoice_no", "age", "payment_method"])),
        "weekday_sales": lambda s, d: R.weekday_sales(dated(s, d)),
        "month_sales": lambda s, d: R.month_sales(dated(s, d)),
        # cleaning and profiles
        "enrich_dates": q_enrich_dates,
        "clean_fill": lambda s, d: C.clean_fill(shopping_from_tables(s, d)),
        "clean_drop": lambda s, d: C.clean_drop(behaviour(s, d)),
        "profile_table": lambda s, d: C.profile_table(s.read.parquet(f"{d}/lineitem.parquet")),
        "profile_schema": lambda s, d: C.profile_schema(s.read.parquet(f"{d}/lineitem.parquet")).select(
            "column_name", "data_type"),
        "sorted_positions": q_sorted_positions,
        "exact_price": q_exact_price,
        "fixed_decimals": lambda s, d: fixed_decimals(categories(s, d).select("category", "total_revenue", "avg_price")),
        "report_inventory": q_report_inventory,
        "profile_nulls": lambda s, d: C.profile_nulls(shopping_from_tables(s, d)),
        "profile_ranges": lambda s, d: C.profile_ranges(metrics(s, d), ["frequency", "monetary"]),
        # behaviour sheet
        "membership_segments": lambda s, d: R.membership_segments(behaviour(s, d)),
        "city_segments": lambda s, d: R.city_segments(behaviour(s, d)),
        "at_risk_customers": lambda s, d: R.at_risk_customers(behaviour(s, d)),
        # basket
        "basket_pairs": lambda s, d: basket.basket_pairs(lines(s, d, ["invoice_no", "category"])),
        # value features
        "consumption_gender": lambda s, d: R.consumption_by(value_lines(s, d, "gender"), "gender"),
        "consumption_age": lambda s, d: R.consumption_by(value_lines(s, d, "age"), "age_group"),
        "consumption_payment": lambda s, d: R.consumption_by(
            value_lines(s, d, "payment_method"), "payment_method"),
        "customer_features": features,
        "median_monetary": lambda s, d: value.median_monetary(metrics(s, d), rel_error=0.0),
        "median_rank_error": lambda s, d: value.median_rank_error(metrics(s, d)),
        "label_value": lambda s, d: features(s, d).select("customer_id", "monetary", "customer_value"),
        # views
        "segment_share": lambda s, d: V.segment_share(segments(s, d)),
        "age_spending": lambda s, d: V.age_spending(segments(s, d)),
        "payment_share": lambda s, d: V.payment_share(payments(s, d)),
        "top_categories": lambda s, d: V.top_categories(categories(s, d)),
        "top_category_trend": lambda s, d: V.top_category_trend(R.month_category(
            lines(s, d, ["invoice_no", "category", "quantity", "price", "invoice_date"]), undated=True)),
        "top_category_gender": lambda s, d: V.top_category_gender(preferences(s, d), genders=GENDERS),
        "top_categories_wide": lambda s, d: V.top_categories(R.category_summary(
            wide_lines(s, d, ["invoice_no", "quantity", "price"]))),
        "top_category_gender_wide": lambda s, d: V.top_category_gender(R.category_preferences(
            wide_lines(s, d, ["gender", "age", "quantity", "price"])), genders=GENDERS),
        "gender_value_mix_wide": lambda s, d: V.gender_value_mix(features(s, d).withColumn("gender", F.col("customer_id"))),
        "payment_top5_share_wide": lambda s, d: V.payment_top5_share(R.consumption_by(
            value.prepare_lines(shopping_from_tables(s, d, ["invoice_no", "quantity", "price", "payment_method", "gender"])
                                .withColumn("payment_method", F.concat_ws(" ", "payment_method", "gender"))), "payment_method")),
        "category_bubble": lambda s, d: V.category_bubble(categories(s, d)),
        "weekday_pattern": lambda s, d: V.weekday_pattern(R.weekday_sales(dated(s, d))),
        "month_pattern": lambda s, d: V.month_pattern(R.month_sales(dated(s, d))),
        "pivot_age_gender": lambda s, d: V.pivot_age_gender(R.age_gender(segments(s, d)), GENDERS),
        "pivot_age_payment": lambda s, d: V.pivot_age_payment(
            R.payment_by_age(lines(s, d, ["invoice_no", "age", "payment_method"])), METHODS),
        "value_counts": lambda s, d: V.value_counts(features(s, d)),
        "gender_value_mix": lambda s, d: V.gender_value_mix(features(s, d)),
        "payment_top5_share": lambda s, d: V.payment_top5_share(
            R.consumption_by(value_lines(s, d, "payment_method"), "payment_method")),
        "monetary_histogram": lambda s, d: V.monetary_histogram(metrics(s, d)),
        "overview": lambda s, d: V.overview_from_lines(lines(s, d), R.segment_label(**SEGMENT_THRESHOLDS)),
        # value model (its SQL walks the node table that the query wrote)
        "split_counts": lambda s, d: value.split_counts(value.value_features(features(s, d))),
        "value_test_keys": q_value_test_keys,
        "score_auc": lambda s, d: value.rank_auc(features(s, d), "avg_transaction", "customer_value"),
        "value_predictions": q_value_predictions,
        "value_auc": q_value_auc,
        "feature_importance": q_feature_importance,
        "spend_regression": q_spend_regression,
        "spend_errors": q_spend_errors,
        # sources and sinks
        "ingest_roundtrip": q_ingest_roundtrip,
        "ingest_late_files": q_ingest_late_files,
        "ingest_reordered": q_ingest_reordered,
        "ingest_rejects": q_ingest_rejects,
        "ingest_wide": q_ingest_wide,
        "ingest_layouts": q_ingest_layouts,
        "ingest_ledger": q_ingest_ledger,
        "report_roundtrip": q_report_roundtrip,
        "run_status": q_run_status,
        "report_set": q_report_set,
        "shopping_csv_reordered": q_shopping_csv_reordered,
        "shopping_csv": q_shopping_csv,
        "behaviour_csv": q_behaviour_csv,
    }
