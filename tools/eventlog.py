"""Job and stage timings of catalogue queries from Spark's event log.

Runs the named queries twice (the second run is reported) with the event log
written to a fresh scratch folder, then prints per-job and per-stage wall
times and task counts.

usage: python tools/eventlog.py SF_DIR QUERY [QUERY ...]
"""

from __future__ import annotations

import glob
import io
import json
import sys
import tempfile
import time

sys.path.insert(0, ".")


def read_events(folder):
    import zstandard

    for path in sorted(glob.glob(f"{folder}/eventlog_v2_*/events_*") or glob.glob(f"{folder}/*")):
        with open(path, "rb") as fh:
            raw = fh.read()
        if path.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode("utf-8").splitlines():
            yield json.loads(line)


def main():
    sf, names = sys.argv[1], sys.argv[2:]
    folder = tempfile.mkdtemp(prefix="cartlens-eventlog-")
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[8]")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", folder)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from cartlens.plans.catalog import queries

    q = queries()
    marks = []
    for name in names:
        for run in range(2):
            t0 = time.time() * 1000
            q[name](spark, sf).write.format("noop").mode("overwrite").save()
            if run:
                marks.append((name, t0, time.time() * 1000))
    spark.stop()
    jobs, stages = {}, {}
    for e in read_events(folder):
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            jobs[e["Job ID"]] = [e["Submission Time"], None, e["Stage IDs"]]
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]][1] = e["Completion Time"]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Number of Tasks"],
                                      si.get("Completion Time", 0) - si.get("Submission Time", 0))
    for name, start, end in marks:
        print(f"== {name}: {end - start:.0f} ms")
        for jid, (s, c, sids) in sorted(jobs.items()):
            if start <= s <= end:
                detail = ", ".join(f"stage {i}: {stages[i][0]} tasks {stages[i][1]} ms"
                                   for i in sids if i in stages)
                print(f"  job {jid} at +{s - start:.0f} ms, {((c or s) - s)} ms  [{detail}]")


if __name__ == "__main__":
    main()
