"""Message codec: request JSON in, reply keys out.

Messages are ``(request_id BIGINT, key STRING, value STRING)``; the key is
``input-<user>`` for requests and ``output-<user>`` for replies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The request payload layout, the key prefixes and statuses.
REQUEST_FIELDS = "src STRING, departureDate STRING, dst STRING, " \
                 "priceRange ARRAY<DOUBLE>, timeTravelRange ARRAY<DOUBLE>"
INPUT_PREFIX = "input"
OUTPUT_PREFIX = "output-"
STATUS_OK = "OK"
STATUS_BAD_JSON = "BAD_JSON"
STATUS_NOT_OBJECT = "NOT_OBJECT"
STATUS_MISSING_FIELD = "MISSING_FIELD"
STATUS_BAD_KEY = "BAD_KEY"
STATUS_BAD_DATE = "BAD_DATE"
STATUS_NO_CITY = "NO_CITY"


def select_requests(messages: DataFrame) -> DataFrame:
    """keep request messages (key starts with ``input``)."""
    return messages.filter(F.col("key").startswith(INPUT_PREFIX))


def responses_for(messages: DataFrame, user_id) -> DataFrame:
    """keep the replies addressed to one user."""
    return messages.filter(F.col("key") == F.concat(F.lit(OUTPUT_PREFIX), F.lit(str(user_id))))


def user_from_key(key: Column) -> Column:
    """Second dash-separated part of the key; null when absent or empty."""
    return F.nullif(F.get(F.split(key, "-"), 1), F.lit(""))


def reply_key(user_id: Column) -> Column:
    """``output-<user>``."""
    return F.concat(F.lit(OUTPUT_PREFIX), user_id)


def coordinate(text: Column, idx: int) -> Column:
    """One number of an ISO-6709 ``+DD.DDDD,+DDD.DDDD`` pair (null if bad)."""
    part = F.trim(F.get(F.split(text, ","), idx))
    return part.try_cast("double")


def range_from_text(text: Column) -> Column:
    """``"20,150"`` -> ``[20.0, 150.0]``; blank text -> empty list."""
    return F.when(F.trim(F.coalesce(text, F.lit(""))) == "", F.array().cast("array<double>")) \
        .otherwise(F.transform(F.split(text, ","), lambda x: F.trim(x).try_cast("double")))


def encode_requests(requests: DataFrame) -> DataFrame:
    """Requests -> messages laid out as the console client writes
    them: key ``input-<user>``, value a JSON object with five fields."""
    value = F.to_json(F.struct(
        F.col("src"), F.col("departure_date").cast("string").alias("departureDate"), F.col("dst"),
        F.col("price_range").alias("priceRange"), F.col("time_range").alias("timeTravelRange")))
    return requests.select(
        "request_id",
        F.concat(F.lit(INPUT_PREFIX + "-"), F.col("user_id").cast("string")).alias("key"),
        value.alias("value"))


def decode_requests(messages: DataFrame) -> DataFrame:
    """F1 + J1 + J2 + J4 + J5: request messages -> typed requests with a
    ``status`` per row instead of an exception (one bad message never
    stops the stream)."""
    m = select_requests(messages)
    parsed = F.from_json(F.col("value"), REQUEST_FIELDS + ", _corrupt STRING",
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    head = F.substring(F.ltrim(F.col("value")), 1, 1)
    other_json = (((head == "[") & F.from_json(F.col("value"), "ARRAY<STRING>").isNotNull())
                  | F.trim(F.col("value")).try_cast("double").isNotNull()
                  | F.trim(F.col("value")).isin("true", "false", "null"))
    p = m.select("request_id", "key", "value", parsed.alias("j"))
    date = F.col("j.departureDate").try_cast("date")
    user = user_from_key(F.col("key"))
    missing = (F.col("j.src").isNull() | F.col("j.dst").isNull() | F.col("j.departureDate").isNull()
               | F.col("j.priceRange").isNull() | F.col("j.timeTravelRange").isNull())
    status = (F.when(F.col("value").isNull(), F.lit(STATUS_BAD_JSON))
              .when(other_json, F.lit(STATUS_NOT_OBJECT))
              .when(F.col("j._corrupt").isNotNull(), F.lit(STATUS_BAD_JSON))
              .when(missing, F.lit(STATUS_MISSING_FIELD))
              .when(user.isNull(), F.lit(STATUS_BAD_KEY))
              .when(date.isNull(), F.lit(STATUS_BAD_DATE))
              .otherwise(F.lit(STATUS_OK)))
    return p.select(
        "request_id",
        # a message without a user is answered under its whole key
        F.coalesce(user, F.col("key")).alias("user_id"),
        F.col("j.src").alias("src"),
        F.col("j.dst").alias("dst"),
        coordinate(F.col("j.src"), 0).alias("src_lat"),
        coordinate(F.col("j.src"), 1).alias("src_lon"),
        coordinate(F.col("j.dst"), 0).alias("dst_lat"),
        coordinate(F.col("j.dst"), 1).alias("dst_lon"),
        date.alias("departure_date"),
        F.col("j.priceRange").alias("price_range"),
        F.col("j.timeTravelRange").alias("time_range"),
        status.alias("status"))
