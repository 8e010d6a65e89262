"""Entity schemas (declared once, passed to every reader; nothing is inferred).

Raw = as collected / staged in the operational store. Clean = warehouse form.
"""

from __future__ import annotations

from pyspark.sql import types as T

PARTICIPANT = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField("username", T.StringType()),
        T.StructField("reply", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("love", T.IntegerType()),
        T.StructField("brick", T.IntegerType()),
    ]
)

THREADS_RAW = T.StructType(
    [
        T.StructField("thread_id", T.IntegerType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("author_name", T.StringType(), False),
        T.StructField("author_id", T.IntegerType(), False),
        T.StructField("reply_count", T.StringType()),
        T.StructField("view_count", T.StringType()),
        T.StructField("participants", T.ArrayType(PARTICIPANT)),
        T.StructField("created_at", T.StringType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("f", T.IntegerType()),
        T.StructField("status", T.ArrayType(T.StringType())),
    ]
)

THREADS_CLEAN = T.StructType(
    [
        T.StructField("thread_id", T.IntegerType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("author_name", T.StringType(), False),
        T.StructField("author_id", T.IntegerType(), False),
        T.StructField("reply_count", T.LongType()),
        T.StructField("view_count", T.LongType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("f", T.IntegerType()),
        T.StructField("status", T.ArrayType(T.StringType())),
        T.StructField("word_count", T.MapType(T.StringType(), T.LongType())),
    ]
)

USERS_RAW = T.StructType(
    [
        T.StructField("user_id", T.IntegerType(), False),
        T.StructField("username", T.StringType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("location", T.StringType()),
        T.StructField("join_date", T.StringType()),
        T.StructField("last_seen", T.StringType()),
        T.StructField("message", T.IntegerType()),
        T.StructField("reaction", T.IntegerType()),
        T.StructField("point", T.IntegerType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)

USERS_CLEAN = T.StructType(
    [
        T.StructField("user_id", T.IntegerType(), False),
        T.StructField("username", T.StringType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("location", T.StringType()),
        T.StructField("join_date", T.DateType()),
        T.StructField("last_seen", T.TimestampNTZType()),
        T.StructField("message", T.IntegerType()),
        T.StructField("reaction", T.IntegerType()),
        T.StructField("point", T.IntegerType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)

PARTICIPANTS_CLEAN = T.StructType(
    [
        T.StructField("thread_id", T.IntegerType()),
        T.StructField("user_id", T.IntegerType()),
        T.StructField("username", T.StringType()),
        T.StructField("reply", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("love", T.IntegerType()),
        T.StructField("brick", T.IntegerType()),
    ]
)

WATERMARK = T.StructType(
    [
        T.StructField("entity", T.StringType(), False),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)

#: A watermark (no tie) and the rows extracted at its stamp (key and content digest).
TIES = T.StructType(WATERMARK.fields + [T.StructField("tie_key", T.StringType()), T.StructField("tie_digest", T.StringType())])

# Fixed values (must equal the reference's): primary keys, NOT NULL columns
# and declared widths (VARCHAR(n)) of the warehouse tables.
KEYS = {"threads": ["thread_id"], "users": ["user_id"], "participants": ["thread_id", "user_id", "created_at"]}
NOT_NULL = {
    "threads": ["thread_id", "title", "author_name", "author_id"],
    "users": ["user_id", "username", "title", "join_date"],
}
WIDTHS = {
    "threads": {"author_name": 100},
    "users": {"username": 100, "title": 100, "location": 100},
}


def columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]
