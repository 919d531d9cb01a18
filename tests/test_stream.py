import tempfile

from pyspark.sql import functions as F

from routeweave.functions import codec
from routeweave.plans.search import search
from routeweave.sources import fixtures
from routeweave.streaming import serve as svc
from tests.conftest import SF0001


def test_stream_equals_batch_and_restarts(spark):
    base = tempfile.mkdtemp(prefix="rw-stream-")
    msgs = codec.encode_requests(fixtures.requests(spark, SF0001))
    bad = spark.createDataFrame([(10_000_001, "input-3", "not json"), (10_000_002, "noise", "x")],
                                "request_id BIGINT, key STRING, value STRING")
    first = msgs.filter(F.col("request_id") < 500).unionByName(bad)
    second = msgs.filter(F.col("request_id") >= 500)
    first.coalesce(2).write.parquet(f"{base}/in/part=1")
    cat = fixtures.catalogue(spark, SF0001)

    def run():
        stream = svc.read_messages(spark, "parquet", f"{base}/in", maxFilesPerTrigger=1, recursiveFileLookup="true")
        q = svc.serve(stream, cat, f"{base}/out", f"{base}/ckpt", trigger={"availableNow": True})
        q.awaitTermination()
    run()
    second.coalesce(1).write.parquet(f"{base}/in/part=2")
    run()                                           # restart: resumes from the checkpoint
    out = spark.read.parquet(f"{base}/out")
    assert len({r.query_id for r in out.select("query_id").distinct().collect()}) == 1
    got = {(r.request_id, r.key, r.value) for r in out.collect()}
    assert out.count() == len(got)                   # no duplicates across batches and restarts
    batch = search(fixtures.requests(spark, SF0001), cat).responses
    want = {(r.request_id, r.key, r.value) for r in batch.collect()}
    want.add((10_000_001, "output-3", "Ups! There was some error in the query..."))
    assert got == want


def test_client_reads_own_replies(spark):
    base = tempfile.mkdtemp(prefix="rw-client-")
    rows = [(1, "output-5", "mine"), (2, "output-6", "theirs"), (3, "input-5", "request")]
    spark.createDataFrame(rows, "request_id BIGINT, key STRING, value STRING").write.parquet(f"{base}/topic")
    stream = svc.read_messages(spark, "parquet", f"{base}/topic")
    got = svc.collect_responses(stream, 5, timeout_s=5, query_name="client_5").collect()
    assert [(r.key, r.value) for r in got] == [("output-5", "mine")]


def test_cli_requests_get_their_own_replies(spark, tmp_path):
    """Two published requests, answered in one micro-batch from a stored
    catalogue; then the same from messages that share a request id."""
    from routeweave import cli
    from routeweave.sources import catalogue as store
    cat = str(tmp_path / "cat")
    store.write_catalogue(fixtures.catalogue(spark, SF0001), cat)
    inbox = str(tmp_path / "inbox")
    ends = {"42": ("+45.0000,+5.0000", "+47.0000,+8.0000"), "43": ("+49.0000,+11.0000", "+46.0000,+6.5000")}
    for user, (src, dst) in ends.items():
        cli.main(["request", "--user", user, "--src", src, "--dst", dst, "--date", "2024-01-02", "--price", "", "--time", "",
                  "--sink", "parquet", "--path", inbox])
    sent = spark.read.parquet(inbox)
    assert sent.select("request_id").distinct().count() == 2

    def answers(messages):
        return {r.key: r.value for r in svc.answer(messages, cat).collect()}
    alone = {}
    for user in ends:
        alone |= answers(sent.filter(F.col("key") == f"input-{user}"))
    assert set(alone) == {"output-42", "output-43"} and len(set(alone.values())) == 2
    q = svc.serve(svc.read_messages(spark, "parquet", inbox), cat, str(tmp_path / "out"), str(tmp_path / "ckpt"),
                  trigger={"availableNow": True})
    q.awaitTermination()
    assert {r.key: r.value for r in spark.read.parquet(str(tmp_path / "out")).collect()} == alone
    assert answers(sent.withColumn("request_id", F.lit(5).cast("long"))) == alone


def test_batch_reads_only_its_days(spark, tmp_path):
    import io
    from contextlib import redirect_stdout

    from routeweave.sources import catalogue as store
    store.write_catalogue(fixtures.catalogue(spark, SF0001), str(tmp_path))
    req = fixtures.requests(spark, SF0001).filter("departure_date = DATE'2024-01-03'")
    _, ctrips = svc.batch_catalogue(spark, str(tmp_path), req)
    buf = io.StringIO()
    with redirect_stdout(buf):
        ctrips.explain("formatted")
    assert "PartitionFilters: [" in buf.getvalue() and "2024-01-03" in buf.getvalue()
    assert ctrips.select("departure_date").distinct().count() == 1
