"""Schemas of the tables and in-flight records."""

from pyspark.sql import types as T


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


_STAMPS = (("created_at", T.TimestampType(), True), ("updated_at", T.TimestampType(), True))

FRONTIER = _struct(
    ("url_id", T.LongType(), False),
    ("url", T.StringType(), False),
    ("host", T.StringType(), False),
    ("depth", T.IntegerType(), False),
    *_STAMPS,
)
DOCUMENTS = _struct(
    ("doc_id", T.StringType(), False),
    ("url", T.StringType(), False),
    ("content", T.StringType(), True),
    ("title", T.StringType(), True),
    *_STAMPS,
)
CHUNKS = _struct(
    ("chunk_id", T.StringType(), False),
    ("doc_id", T.StringType(), True),
    ("chunk_start", T.LongType(), True),
    ("chunk_end", T.LongType(), True),
    ("embedding", T.ArrayType(T.FloatType()), True),
    *_STAMPS,
)
# One crawled page on its way to the parser.
MESSAGE = _struct(
    ("id", T.StringType(), True),
    ("content", T.StringType(), True),
    ("depth", T.IntegerType(), True),
    ("url", T.StringType(), True),
)
SITE_CONFIG = T.StructType(
    [
        T.StructField(
            "sites",
            T.ArrayType(
                _struct(
                    ("url", T.StringType(), True),
                    ("depth", T.IntegerType(), True),
                    ("rps", T.IntegerType(), True),
                )
            ),
        )
    ]
)
SEARCH_REQUEST = _struct(
    ("query", T.StringType(), True),
    ("limit", T.LongType(), True),
    ("offset", T.LongType(), True),
)
QUEUE_MESSAGE = _struct(("id", T.StringType(), True), ("event_time", T.TimestampType(), True))
