"""The streaming counter equals the batch net flow once all windows close."""

import tempfile

from pyspark.sql import functions as F

from flowgrid.operators import clean, flow
from flowgrid.plans import adapters
from flowgrid.streaming.hourly import hourly_flow_stream
from tests.conftest import SF_SMALL


def test_stream_matches_batch(spark):
    m = adapters.mobility(spark, SF_SMALL)
    t = clean.normalize_ids(clean.filter_complete_rows(m["trips"], clean.TRIP_REQUIRED)).select(
        "started_at", "ended_at", "start_station_id", "end_station_id")
    src = tempfile.mkdtemp(prefix="fg-stream-src-")
    t.write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(t.schema).parquet(src)
    q = (hourly_flow_stream(stream, "1000 days").writeStream.format("memory").queryName("fg_hourly")
         .outputMode("complete").start())
    q.processAllAvailable()
    q.stop()
    got = spark.table("fg_hourly")
    want = flow.net_flow_single_pass(t)
    diff = got.join(want, ["station_id", "date_hour"], "full").where(~got["net_flow"].eqNullSafe(want["net_flow"]))
    assert diff.count() == 0
    assert got.count() == want.count()
