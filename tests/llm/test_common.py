"""Offsets over many keys, small Arrow batches, and the clean-up of staged tables."""

import os

from cartlens.llm import common


def test_offsets_equal_running_totals(spark):
    rows = [(k, (k * 7) % 5 + 1) for k in range(0, 500, 3)]
    got = common.with_offsets(spark.createDataFrame(rows, "bucket long, n long"), "bucket", "n", group=16).collect()
    total = 0
    for r in sorted(got, key=lambda r: r.bucket):
        assert r.offset == total
        total += r.n
    assert len(got) == len(rows)


def test_text_batches_are_small(spark):
    sizes = spark.range(5000, numPartitions=1)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    n = [r.n for r in common.map_texts(sizes, run, "n long").collect()]
    assert sum(n) == 5000 and max(n) <= common.ARROW_ROWS


def test_staged_tables_can_be_cleared(spark):
    df = common.staged(spark.range(3), "clear_me")
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:").rstrip("/") + "/cartlens/llm"
    assert df.count() == 3 and os.listdir(folder)
    common.clear_staged(spark)
    assert not os.path.exists(folder)
