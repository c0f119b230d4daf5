"""Gold: count tables and keywords, from one pass each over the articles."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from gazette import constants as C
from gazette.operators import gold
from gazette.operators.lookups import with_country


def lake_facts(silver: DataFrame) -> DataFrame:
    """The gold keys of the lake's articles; country comes with the article."""
    keyed = gold.with_theme(gold.with_published_day(silver), "content_final")
    return keyed.select(*[gold.COUNT_KEYS[t] for t in gold.LAKE_TABLES])


def warehouse_facts(detail: DataFrame, sources: list[tuple] = C.SOURCES) -> DataFrame:
    """The gold keys of the warehouse's articles; country comes from the configuration."""
    keyed = gold.with_theme(gold.with_published_day(with_country(detail, sources)), "content")
    return keyed.select(*[gold.COUNT_KEYS[t] for t in gold.WAREHOUSE_TABLES])


def lake_tables(silver: DataFrame) -> dict[str, DataFrame]:
    tables = gold.count_tables(lake_facts(silver), gold.LAKE_TABLES)
    words = gold.top_keywords(silver, "content_final", C.LAKE_TOP_KEYWORDS)
    return {**tables, "top_keywords": words}


def warehouse_tables(
    detail: DataFrame, as_of: datetime, sources: list[tuple] = C.SOURCES
) -> dict[str, DataFrame]:
    tables = gold.count_tables(warehouse_facts(detail, sources), gold.WAREHOUSE_TABLES)
    words = gold.top_keywords(detail, "title", C.WAREHOUSE_TOP_KEYWORDS, C.WAREHOUSE_STOPWORDS)
    return {
        name: gold.stamped(df, as_of) for name, df in {**tables, "top_keywords": words}.items()
    }
