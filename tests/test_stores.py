"""What services and stores do once: joins of a service's catalogue, trips of a stored one."""
import datetime as dt
import glob

from pyspark.sql import functions as F

from routeweave.functions import codec
from routeweave.plans import queries_more
from routeweave.sources import catalogue as store
from routeweave.sources import payloads
from routeweave.streaming import ingest
from routeweave.streaming import serve as svc
from tests.test_shared_searches import _catalogue, _requests


def test_a_service_joins_its_trips_once(spark, tmp_path, monkeypatch):
    """Two micro-batches, one join of trips with their places."""
    joined, city_trips = [], svc.city_trips
    monkeypatch.setattr(svc, "city_trips", lambda *tables: joined.append(1) or city_trips(*tables))
    messages = codec.encode_requests(_requests(spark, range(4)))
    for part in (0, 1):
        messages.filter(F.col("request_id") % 2 == part).coalesce(1).write.parquet(f"{tmp_path}/in/part={part}")
    stream = svc.read_messages(spark, "parquet", f"{tmp_path}/in", maxFilesPerTrigger=1, recursiveFileLookup="true")
    svc.serve(stream, _catalogue(spark), f"{tmp_path}/out", f"{tmp_path}/ckpt", trigger={"availableNow": True}).awaitTermination()
    replies = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted(r.request_id for r in replies) == [0, 1, 2, 3] and {r.batch_id for r in replies} == {0, 1}
    assert joined == [1]


def test_stored_trips_are_made_once_unless_ids_repeat(spark, tmp_path, monkeypatch):
    made, legs_once = [], store.legs_once
    monkeypatch.setattr(store, "legs_once", lambda rows: made.append(1) or legs_once(rows))
    cat = _catalogue(spark)
    n = cat.trips.count()
    v = store.write_catalogue(cat, f"{tmp_path}/plain")
    assert not made and store.read_city_trips(spark, f"{tmp_path}/plain", v).count() == store.read_catalogue(spark, f"{tmp_path}/plain", v).trips.count() == n
    cat.trips = cat.trips.unionByName(cat.trips.withColumn("price", F.col("price") - 1)).unionByName(cat.trips)
    v = store.write_catalogue(cat, f"{tmp_path}/again")
    trips = store.read_catalogue(spark, f"{tmp_path}/again", v).trips
    assert made and trips.count() == trips.select("leg_id").distinct().count() == store.read_city_trips(spark, f"{tmp_path}/again", v).count() == n


def test_legs_of_documents_are_packed(spark, tmp_path):
    trips = spark.createDataFrame([("1", "2", "A", "B", 3, 4, "FLIGHT", dt.date(2024, 1, 1), True, 9.5)],
                                  "origin_place_id STRING, dest_place_id STRING, o_name STRING, d_name STRING, o_city INT, d_city INT, provider STRING, "
                                  "departure_date DATE, is_direct BOOLEAN, price DOUBLE").withColumns({"departure_dt": F.lit(""), "arrival_dt": F.lit("")})
    for name, docs in (("quotes", payloads.flight_quote_documents(trips)), ("journeys", payloads.bus_journey_documents(trips))):
        docs.withColumn("fetched_at", F.lit("2024-01-01 00:00:00").cast("timestamp")).write.parquet(f"{tmp_path}/{name}")
    legs = ingest.fresh_legs(ingest.read_documents(spark, f"{tmp_path}/quotes"), ingest.read_documents(spark, f"{tmp_path}/journeys"))
    ingest.append_legs(legs, f"{tmp_path}/legs", f"{tmp_path}/ckpt", {"availableNow": True}).awaitTermination()
    files = glob.glob(f"{tmp_path}/legs/departure_date=*/*.parquet")
    assert files and all(".zstd." in f for f in files) and ingest.read_legs(spark, f"{tmp_path}/legs", legs.schema).count() == 1


def test_many_messages_are_written_into_more_files(spark):
    assert queries_more._files(spark.range(600_000), 3) == 3 and queries_more._files(spark.range(1_000_001), 3) == 5
