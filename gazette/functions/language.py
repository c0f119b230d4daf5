"""Language by indicator vote."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gazette import constants as C
from gazette.functions.text import blank_if_null, count_present


def vote_counts(text: Column) -> Column:
    """Number of French and of English indicators present in the text."""
    lowered = F.lower(blank_if_null(text))
    return F.struct(
        count_present(lowered, C.FRENCH_INDICATORS).alias("fr"),
        count_present(lowered, C.ENGLISH_INDICATORS).alias("en"),
    )


def vote_winner(text: Column, votes: Column) -> Column:
    return (
        F.when(blank_if_null(text) == "", "unknown")
        .when(votes["fr"] > votes["en"], "fr")
        .when(votes["en"] > votes["fr"], "en")
        .otherwise("mixed")
    )
