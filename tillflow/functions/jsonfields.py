"""JSON fields: the file-arrival event and a config object."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARRIVAL_EVENT = T.StructType(
    [
        T.StructField(
            "Records",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            "s3",
                            T.StructType(
                                [
                                    T.StructField("bucket", T.StructType([T.StructField("name", T.StringType())])),
                                    T.StructField("object", T.StructType([T.StructField("key", T.StringType())])),
                                ]
                            ),
                        )
                    ]
                )
            ),
        )
    ]
)

CONFIG = T.StructType(
    [
        T.StructField("host", T.StringType()),
        T.StructField("port", T.IntegerType()),
        T.StructField("password", T.StringType()),
        T.StructField("user", T.StringType()),
    ]
)


def arrival_event(bucket: Column, key: Column) -> Column:
    """Event text for one created object (the inverse of ``event_fields``)."""
    record = F.struct(F.struct(F.struct(bucket.alias("name")).alias("bucket"), F.struct(key.alias("key")).alias("object")).alias("s3"))
    return F.to_json(F.struct(F.array(record).alias("Records")))


def event_fields(event: Column) -> tuple[Column, Column]:
    """(bucket name, object key) of record 0; only the first record is used."""
    rec = F.get(F.from_json(event, ARRIVAL_EVENT)["Records"], 0)["s3"]
    return rec["bucket"]["name"], rec["object"]["key"]


def event_objects(event: Column) -> Column:
    """(bucket, key) of every record of an event, as an array; keys as the store has them.

    Events carry keys in URL encoding. A text that is no event gives null, a
    record without bucket or key does not count.
    """
    records = F.transform(
        F.from_json(event, ARRIVAL_EVENT)["Records"],
        lambda r: F.struct(r["s3"]["bucket"]["name"].alias("bucket"), F.try_url_decode(r["s3"]["object"]["key"]).alias("key")),
    )
    return F.filter(records, lambda r: r["bucket"].isNotNull() & r["key"].isNotNull())


def parse_object(text: Column, schema: T.StructType = CONFIG) -> Column:
    """JSON object text (newlines allowed) to a typed struct."""
    return F.from_json(text, schema)
