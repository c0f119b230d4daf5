"""Source configuration, read as data from the shared path.

The file is a YAML list below `sources:`, one entry per `-` with plain or quoted
values, one a line. Entries are checked as a table: what cannot be used is kept
aside with the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette import constants as C
from gazette.functions.text import null_if_blank

FIELDS = ("name", "country", "rss_url")
NO_NAME, NO_URL, REPEATED = "no name", "no rss_url", "name repeated"


def _value(entry: Column, field: str) -> Column:
    """A field's value without quotes and comments; null if it is missing or empty."""
    written = F.regexp_extract(entry, rf"(?m)^[ \t-]*{field}[ \t]*:[ \t]*(.*?)[ \t]*$", 1)
    quoted = F.regexp_extract(written, r"""^(["'])(.*)\1[ \t]*(?:#.*)?$""", 2)
    bare = F.regexp_replace(written, r"(?:^|[ \t]+)#.*$", "")
    return null_if_blank(F.when(written.rlike(r"""^["']"""), quoted).otherwise(bare))


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """All entries of the file with their position: position, name, country, rss_url."""
    whole = spark.read.text(path, wholetext=True).select(
        F.regexp_extract("value", r"(?s)(?:^|\n)sources:[ \t]*\r?\n(.*?)(?:\n\w|\z)", 1).alias("body")
    )
    entries = whole.select(F.posexplode(F.split("body", r"(?m)^[ \t]*-[ \t]")).alias("position", "entry"))
    found = entries.where("position > 0")
    return found.select("position", *[_value(F.col("entry"), f).alias(f) for f in FIELDS])


def checked(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable sources, entries kept aside with a reason).

    The first entry of a name counts; a missing country is Unknown.
    """
    again = F.row_number().over(Window.partitionBy("name").orderBy("position")) > 1
    reason = (
        F.when(F.col("name").isNull(), NO_NAME)
        .when(F.col("rss_url").isNull(), NO_URL)
        .when(F.col("_again"), REPEATED)
    )
    # an entry that cannot be used does not take its name
    usable = entries.where("name IS NOT NULL AND rss_url IS NOT NULL").withColumn("_again", again)
    others = entries.where("name IS NULL OR rss_url IS NULL").withColumn("_again", F.lit(False))
    judged = usable.unionByName(others).withColumn("reason", reason).drop("_again")
    kept = judged.where("reason IS NULL").orderBy("position")
    return (
        kept.select("name", F.coalesce("country", F.lit(C.UNKNOWN)).alias("country"), "rss_url"),
        judged.where("reason IS NOT NULL"),
    )


def load_sources(spark: SparkSession, path: str) -> list[tuple[str, str, str]]:
    """The usable sources of a file as (name, country, rss_url), in its order."""
    return [tuple(row) for row in checked(read_entries(spark, path))[0].collect()]


def write_sources(spark: SparkSession, path: str, sources: list[tuple]) -> None:
    """A file of sources, for tests and first installations."""
    lines = ["sources:"]
    for source in sources:
        for i, (field, value) in enumerate(zip(FIELDS, source, strict=True)):
            if value is not None:
                lines.append(f"  {'-' if i == 0 else ' '} {field}: '{value}'")
    rows = spark.createDataFrame([("\n".join(lines),)], "value string")
    rows.coalesce(1).write.mode("overwrite").text(path)
