"""The stream of events: late rows within the watermark count, later ones don't; a restart goes on."""

import os
import time
from datetime import date, datetime

from tidemark.streaming import demand


def put(spark, folder, name, rows):
    made = spark.createDataFrame([(datetime.fromisoformat(t), "a", v) for t, v in rows], "ts timestamp, event_type string, value double").coalesce(1)
    made.write.parquet(f"{folder}/{name}")
    time.sleep(1.1)  # files are taken in the order of their times
    return f"{folder}/{name}"


def test_late_rows_and_restart(spark, tmp_path):
    source = str(tmp_path / "in")
    os.makedirs(source)
    put(spark, source, "b=1", [("2024-01-10T05:00:00", 1.0), ("2024-01-09T23:00:00", 2.0)])
    put(spark, source, "b=2", [("2024-01-12T01:00:00", 4.0)])  # the watermark is 2024-01-11 01:00 from here on
    put(spark, source, "b=3", [("2024-01-12T02:30:00", 0.0)])  # rows are measured against the watermark that the batch before had
    put(spark, source, "b=4", [("2024-01-11T03:00:00", 8.0), ("2024-01-09T05:00:00", 16.0)])
    read = lambda: spark.readStream.schema("ts timestamp, event_type string, value double").option("maxFilesPerTrigger", 1).parquet(f"{source}/*")
    rows = {r.stay_date: (r.events, r.value) for r in demand.follow(read(), f"file://{tmp_path}/out").collect()}
    assert rows == {date(2024, 1, 9): (1, 2.0), date(2024, 1, 10): (1, 1.0), date(2024, 1, 11): (1, 8.0), date(2024, 1, 12): (2, 4.0)}
    put(spark, source, "b=5", [("2024-01-12T02:00:00", 32.0)])
    rows = {r.stay_date: (r.events, r.value) for r in demand.follow(read(), f"file://{tmp_path}/out").collect()}
    assert rows[date(2024, 1, 12)] == (3, 36.0) and rows[date(2024, 1, 9)] == (1, 2.0)
