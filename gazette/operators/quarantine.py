"""Row rules that decide whether an article can be trusted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette import constants as C
from gazette.functions import urls
from gazette.functions.text import blank_if_null, contains_any, null_if_blank, strip_space


def _share(title: Column, other: str) -> Column:
    """Share of characters left after the pattern's matches are deleted."""
    kept = F.length(F.regexp_replace(title, other, ""))
    return kept / F.greatest(F.length(title), F.lit(1))


def _with_rule_inputs(df: DataFrame) -> DataFrame:
    """Add the cleaned inputs as columns, so that each is computed once."""
    canonical = F.col("canonical_url") if "canonical_url" in df.columns else F.lit(None)
    stripped = df.withColumns(
        {
            "_title": strip_space(blank_if_null(F.col("title"))),
            "_content": strip_space(blank_if_null(F.col("content"))),
            "_source": F.lower(blank_if_null(F.col("source"))),
            "_url": F.coalesce(
                null_if_blank(strip_space(canonical.cast("string"))),
                strip_space(blank_if_null(F.col("url"))),
            ),
        }
    )
    return stripped.withColumns(
        {
            "_low_title": F.lower("_title"),
            "_host": urls.host(F.col("_url")),
            "_path": urls.path(F.col("_url")),
        }
    )


def _title_and_content_reasons() -> list[Column]:
    title, content = F.col("_title"), F.col("_content")
    titled = title != ""
    return [
        F.when(~titled, "title_missing").when(F.length(title) < 8, "title_too_short"),
        F.when(titled & contains_any(F.col("_low_title"), C.GENERIC_TITLE_WORDS), "title_generic"),
        F.when(
            titled & (_share(title, r"[^\p{Lu}]") > 0.80) & (F.length(title) > 5),
            "title_all_caps",
        ),
        F.when(titled & (_share(title, "[^!?.,:;-]") > 0.30), "title_overpunctuated"),
        F.when(
            (content != "") & (F.length(content) < 80) & (F.length(title) < 25),
            "content_sparse",
        ),
    ]


def _publisher_reasons() -> list[Column]:
    """Host and path a known publisher's articles must have."""
    source, host, path = F.col("_source"), F.col("_host"), F.col("_path")
    # publisher name in the source, host part, paths of its articles
    publishers = [
        ("bbc", "bbc.com", path.startswith("/news/")),
        ("hespress", "hespress", path.endswith(".html")),
        ("reuters", "reuters.com", contains_any(path, C.REUTERS_SECTIONS)),
    ]
    wrong_host = wrong_path = F.lit(None).cast("string")
    for name, domain, article_path in reversed(publishers):
        is_publisher = F.contains(source, F.lit(name))
        off_domain = F.when(~F.contains(host, F.lit(domain)), "url_domain_mismatch")
        off_path = F.when((path != "") & ~article_path, "url_path_unexpected")
        wrong_host = F.when(is_publisher, off_domain).otherwise(wrong_host)
        wrong_path = F.when(is_publisher, off_path).otherwise(wrong_path)
    return [wrong_host, wrong_path]


def with_quarantine(df: DataFrame) -> DataFrame:
    """Add reasons (ordered codes), reason (their text) and quarantine (flag).

    A URL that cannot be judged is the only reason reported for its article.
    """
    url = F.col("_url")
    staged = _with_rule_inputs(df)
    reasons = (
        F.when(url == "", F.array(F.lit("url_missing")))
        .when(~urls.has_web_scheme(url), F.array(F.lit("url_invalid_scheme")))
        .when(urls.has_broken_host(url), F.array(F.lit("url_parse_error")))
        .otherwise(
            F.array_compact(F.array(*_title_and_content_reasons(), *_publisher_reasons()))
        )
    )
    flagged = staged.withColumn("reasons", reasons).drop(
        *[c for c in staged.columns if c not in df.columns]
    )
    return flagged.withColumns(
        {
            "reason": F.substring(F.array_join("reasons", ";"), 1, C.REASON_TEXT_CHARS),
            "quarantine": F.size("reasons") > 0,
        }
    )


def suspicious_title(title: Column) -> Column:
    """Title too short, from a menu, or mostly upper case."""
    stripped = strip_space(title)
    upper = F.length(F.regexp_replace(stripped, r"[^\p{Lu}]", ""))
    return F.coalesce(
        (F.length(stripped) < C.SUSPICIOUS_TITLE_CHARS)
        | contains_any(F.lower(stripped), C.TITLE_BLACKLIST)
        | (upper > F.length(stripped) * 0.6),
        F.lit(True),
    )


def suspicious_url(url: Column, source: Column) -> Column:
    """URL missing, not a web URL, or not where that source puts its articles."""
    stripped = strip_space(blank_if_null(url))
    host, path = urls.host(stripped), urls.path(stripped)
    name = F.lower(blank_if_null(source))
    # exact source name, host part, paths of its articles
    known = [
        ("bbc news", "bbc.com", path.startswith("/news/")),
        ("hespress", "hespress.com", path.endswith(".html")),
        ("reuters world", "reuters.com", F.contains(path, F.lit("/world/"))),
    ]
    elsewhere = F.lit(False)
    for source_name, domain, article_path in known:
        at_home = F.contains(host, F.lit(domain)) & article_path
        elsewhere = F.when(name == source_name, ~at_home).otherwise(elsewhere)
    return ~urls.has_web_scheme(stripped) | urls.has_broken_host(stripped) | elsewhere


def reliable(df: DataFrame) -> DataFrame:
    return df.filter(~F.coalesce("quarantine", F.lit(False)))


def quarantined(df: DataFrame) -> DataFrame:
    return df.filter(F.coalesce("quarantine", F.lit(False)))


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reliable, quarantined); an unknown flag counts as reliable."""
    return reliable(df), quarantined(df)
