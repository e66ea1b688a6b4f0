"""Record types. Fixed by the data model; nothing is inferred."""

from pyspark.sql import types as T

#: One line of a session sidecar.
META = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("sequence", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ts_ms", T.LongType()),
    ]
)

#: One cut clip, in output field order.
CLIP = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("path", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("complete", T.BooleanType()),
    ]
)

#: Total write order of store rows: the run, then any place inside the run's input.
WRITE_SEQ = T.StructType(
    [
        T.StructField("run", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("major", T.LongType()),
        T.StructField("minor", T.LongType()),
    ]
)

#: One row of the keyed store.
STORE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("expire_at", T.LongType()),
        T.StructField("write_seq", WRITE_SEQ),
    ]
)

CLIP_FIELDS = CLIP.fieldNames()
STORE_FIELDS = STORE.fieldNames()
