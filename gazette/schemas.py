"""Explicit schemas of every table; nothing is inferred from JSON."""

from pyspark.sql import types as T


def _strings(names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names.split()]


def _fields(**types: T.DataType) -> list[T.StructField]:
    return [T.StructField(n, t) for n, t in types.items()]


_TIME, _FLAG, _INT = T.TimestampNTZType(), T.BooleanType(), T.IntegerType()

# Bronze is text as it arrived; batch and stream add their own metadata.
BRONZE = T.StructType(
    _strings(
        "article_id title author published_at category content_html content source "
        "source_country url canonical_url scraped_at"
    )
)
BRONZE_BATCH = T.StructType(BRONZE.fields + _strings("ingestion_mode ingested_at"))
BRONZE_STREAM = T.StructType(BRONZE_BATCH.fields + _strings("stream_received_at"))
HOUR_FOLDERS = _strings("date hour")

ARTICLES_DETAIL = T.StructType(
    _strings("article_id title author source")
    + _fields(published_at=_TIME)
    + _strings("url canonical_url content category")
    + _fields(ingested_at=_TIME, quarantine=_FLAG, created_at=_TIME)
)

ARTICLES_SILVER = T.StructType(
    _strings("article_id title title_normalized author content content_clean")
    + _fields(content_length=_INT, word_count=_INT)
    + _strings("source category detected_language")
    + _fields(published_at=_TIME)
    + _strings("url canonical_url")
    + _fields(
        quarantine=_FLAG,
        data_quality_score=T.DecimalType(3, 2),
        silver_timestamp=_TIME,
        scraped_at=_TIME,
    )
)

QUARANTINE_AUDIT = T.StructType(
    _strings("article_id action performed_by reason") + _fields(performed_at=_TIME)
)

TRANSFORMATION_AUDIT = T.StructType(
    _strings("article_id transformation_type input_value output_value")
    + _fields(performed_at=_TIME, transformation_timestamp=_TIME)
)

URL_OWNER = T.StructType(_strings("url article_id"))

# Changes of the gold counts; their sums are the counts.
_LONG, _DATE = T.LongType(), T.DateType()
ARTICLE_COUNTS = T.StructType(
    _fields(published_day=_DATE) + _strings("source theme category") + _fields(n=_LONG)
)
KEYWORD_COUNTS = T.StructType(_strings("keyword") + _fields(n=_LONG))
CHECK_COUNTS = T.StructType(_strings("name") + _fields(published_at=_TIME, n=_LONG))
TREND_COUNTS = T.StructType(
    _fields(trend_date=_DATE)
    + _strings("source")
    + _fields(
        articles=_LONG, words=_LONG, counted=_LONG, score=T.DecimalType(28, 2), scored=_LONG
    )
)

# What a batch did not take, as text.
SET_ASIDE = T.StructType(_strings("article_id reason record") + _fields(set_aside_at=_TIME))

SOURCE_CONFIG = T.StructType(_strings("name country rss_url"))
