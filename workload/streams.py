"""Arriving files."""

from pyspark.sql import functions as F

from lakestrata.settings import work_folder
from lakestrata.streaming.arrivals import arriving_parquet, land_arrivals
from workload.registration import query, run_at


@query("SELECT 'run-1' AS SYSRUNID, 'EVENTS' AS SOURCESYSTEM, event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events")
def arriving_files_landed(t):
    """All files of the folder in one run, none of them again in the next."""
    place = work_folder(t.spark, "arrivals")
    for _ in range(2):
        stream = arriving_parquet(t.spark, t.dir, t.events.schema, "events.parquet").select("event_id", "user_id", "event_type", "ts")
        land_arrivals(stream, place + "/rows", place + "/progress", run_at(1), "EVENTS")
    out = t.spark.read.parquet(place + "/rows")
    return out.select("SYSRUNID", "SOURCESYSTEM", "event_id", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))
