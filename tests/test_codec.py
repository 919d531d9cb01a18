from pyspark.sql import functions as F

from routeweave.functions import codec

GOOD = ('{"src":"+45.1250000,+5.2500000","departureDate":"2024-01-05","dst":"+47.5000,+9.7500",'
        '"priceRange":[100,200],"timeTravelRange":[2,5]}')


def _msgs(spark, rows):
    return spark.createDataFrame(rows, "request_id BIGINT, key STRING, value STRING")


def test_decode_statuses(spark):
    rows = [
        (1, "input-42", GOOD),
        (2, "input-42", "not json at all"),
        (3, "input-42", "[1, 2, 3]"),
        (4, "input-42", '{"src":"+1,+2"}'),
        (5, "input42", GOOD),
        (6, "output-42", GOOD),          # a reply, not a request (F1)
        (7, "input-42", '{"src": "+1,+2", "dst"'),
        (8, "input-42", GOOD.replace("2024-01-05", "05/01/2024")),
        (9, "input-", GOOD),
    ]
    out = {r.request_id: r for r in codec.decode_requests(_msgs(spark, rows)).collect()}
    assert set(out) == {1, 2, 3, 4, 5, 7, 8, 9}
    assert out[1].status == "OK"
    assert out[1].user_id == "42"
    assert out[1].src_lat == 45.125 and out[1].src_lon == 5.25
    assert out[1].price_range == [100.0, 200.0] and out[1].time_range == [2.0, 5.0]
    assert str(out[1].departure_date) == "2024-01-05"
    assert out[2].status == "BAD_JSON"
    assert out[3].status == "NOT_OBJECT"
    assert out[4].status == "MISSING_FIELD"
    assert out[5].status == out[9].status == "BAD_KEY"
    assert (out[5].user_id, out[9].user_id) == ("input42", "input-")
    assert out[8].status == "BAD_DATE" and out[8].departure_date is None
    assert out[7].status == "BAD_JSON"


def test_range_text(spark):
    df = spark.createDataFrame([("20,150",), ("",), ("7",), ("1,2,3",)], "t STRING")
    got = [r[0] for r in df.select(codec.range_from_text(F.col("t"))).collect()]
    assert got == [[20.0, 150.0], [], [7.0], [1.0, 2.0, 3.0]]


def test_encode_decode_round_trip(spark):
    req = spark.createDataFrame(
        [(9, "5", "+45.0000,+5.0000", "+46.0000,+6.5000", "2024-01-02", [0.0, 100.0], [])],
        "request_id BIGINT, user_id STRING, src STRING, dst STRING, d STRING, "
        "price_range ARRAY<DOUBLE>, time_range ARRAY<DOUBLE>").withColumn("departure_date", F.to_date("d"))
    msg = codec.encode_requests(req).collect()[0]
    assert msg.key == "input-5"
    assert msg.value == ('{"src":"+45.0000,+5.0000","departureDate":"2024-01-02","dst":"+46.0000,+6.5000",'
                         '"priceRange":[0.0,100.0],"timeTravelRange":[]}')
    back = codec.decode_requests(codec.encode_requests(req)).collect()[0]
    assert back.status == "OK" and back.dst_lon == 6.5 and back.price_range == [0.0, 100.0]
    assert back.time_range == []


def test_control_characters_survive(spark):
    req = spark.createDataFrame([(9, "5", 'a"b\\c\n\t\u0001', "+46.0,+6.5", "2024-01-02", [], [])],
                                "request_id BIGINT, user_id STRING, src STRING, dst STRING, d STRING, "
                                "price_range ARRAY<DOUBLE>, time_range ARRAY<DOUBLE>").withColumn("departure_date", F.to_date("d"))
    back = codec.decode_requests(codec.encode_requests(req)).collect()[0]
    assert back.status == "OK" and back.src == 'a"b\\c\n\t\u0001'


def test_reply_key_and_user_filter(spark):
    df = _msgs(spark, [(1, "output-7", "a"), (2, "output-71", "b"), (3, "input-7", "c")])
    assert [r.request_id for r in codec.responses_for(df, 7).collect()] == [1]
    k = spark.createDataFrame([("7",)], "u STRING").select(codec.reply_key(F.col("u"))).collect()[0][0]
    assert k == "output-7"
