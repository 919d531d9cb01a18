"""Command line: run the search service, publish a request, follow replies.

    python -m routeweave.cli serve --catalogue PATH --source kafka \
        --option kafka.bootstrap.servers=HOST:9092 --option subscribe=TOPIC \
        --sink kafka --sink-option kafka.bootstrap.servers=HOST:9092 --sink-option topic=TOPIC \
        --checkpoint PATH
    python -m routeweave.cli request --user 42 --src +45.1000,+5.2000 --dst +47.0000,+8.1000 \
        --date 2024-01-02 --price 20,150 --time 0,24 --sink parquet --path PATH
    python -m routeweave.cli follow --user 42 --source parquet --path PATH
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from routeweave.functions.codec import encode_requests, range_from_text
from routeweave.session import get_session
from routeweave.streaming import serve as svc


def _opts(pairs):
    return dict(p.split("=", 1) for p in (pairs or []))


def main(argv=None):
    ap = argparse.ArgumentParser(prog="routeweave")
    sub = ap.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("serve")
    s.add_argument("--catalogue", required=True)
    s.add_argument("--source", default="kafka")
    s.add_argument("--path")
    s.add_argument("--option", action="append")
    s.add_argument("--sink", default="parquet")
    s.add_argument("--sink-path")
    s.add_argument("--sink-option", action="append")
    s.add_argument("--checkpoint", required=True)
    r = sub.add_parser("request")
    for a in ("--user", "--src", "--dst", "--date"):
        r.add_argument(a, required=True)
    r.add_argument("--price", default="")
    r.add_argument("--time", default="")
    r.add_argument("--sink", default="parquet")
    r.add_argument("--path")
    r.add_argument("--option", action="append")
    f = sub.add_parser("follow")
    f.add_argument("--user", required=True)
    f.add_argument("--source", default="kafka")
    f.add_argument("--path")
    f.add_argument("--option", action="append")
    f.add_argument("--timeout", type=int, default=svc.CLIENT_TIMEOUT_S)
    args = ap.parse_args(argv)
    spark = get_session()

    if args.cmd == "serve":
        stream = svc.read_messages(spark, args.source, args.path, **_opts(args.option))
        q = svc.serve(stream, args.catalogue, args.sink_path, args.checkpoint,
                      sink_format=args.sink, sink_options=_opts(args.sink_option))
        q.awaitTermination()
    elif args.cmd == "request":
        one = spark.createDataFrame([(args.user, args.src, args.dst, args.date, args.price, args.time)],
                                    "user_id STRING, src STRING, dst STRING, d STRING, p STRING, t STRING")
        req = one.select(F.abs(F.xxhash64(F.uuid())).alias("request_id"), "user_id", "src", "dst",
                         F.col("d").try_cast("date").alias("departure_date"),
                         range_from_text(F.col("p")).alias("price_range"),
                         range_from_text(F.col("t")).alias("time_range"))
        msg = encode_requests(req)
        if args.sink == "kafka":
            msg.select("key", "value").write.format("kafka").options(**_opts(args.option)).save()
        else:
            msg.write.mode("append").format(args.sink).save(args.path)
    else:
        stream = svc.read_messages(spark, args.source, args.path, **_opts(args.option))
        for row in svc.collect_responses(stream, args.user, args.timeout).collect():
            print(row.value)


if __name__ == "__main__":
    main()
