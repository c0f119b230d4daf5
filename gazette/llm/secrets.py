"""Secret scans: candidates by pattern, false positives removed by a random forest.

A candidate is a part, between assignments, of a long run of key characters with a
digit; a word may hold several runs and parts. The forest looks at its length, its character transitions, how much of it a dictionary
covers, whether it stands in a path or address, and the words beside it. The
dictionary and the letter transitions are counted over all documents, outside
candidates. Everything
is DataFrame operations.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.session import shared_dir

SPACE = r"[\x20\x09-\x0D]+"
_KEY = r"A-Za-z0-9+/_=.:-"
#: At the start of a run of 12 key characters or more, up to its first digit.
CANDIDATE = rf"(?<![{_KEY}])(?=[{_KEY}]{{12}})[A-Za-z+/_=.:-]*+[0-9]"
RUN = rf"{CANDIDATE}[{_KEY}]*+"
#: Words that announce a secret.
ANNOUNCED = r"(?i)(passw|pwd|secret|token|api.?key|access.?key|credential|bearer|auth)"
#: Parts of addresses and file names.
ADDRESS = r"://|[.](com|org|net|html?|json|txt|py|js)\b"
#: Formats that are secrets for certain, for labels.
KNOWN_SECRET = r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abprs]-[A-Za-z0-9-]{10,}$"
#: The same formats within a longer run.
KNOWN_INSIDE = (
    r"(?<![A-Za-z0-9])(?:(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36})(?![A-Za-z0-9])"
    r"|xox[abprs]-[A-Za-z0-9-]{10,})"
)
#: Parts of a run before a value that may announce it.
BEFORE = 8
#: Formats that are none: numbers, addresses, dates, versions, words with a number.
KNOWN_PLAIN = r"^[0-9TZ.:/+-]+$|^[a-z]+[._-]?[0-9]{1,4}$|^[0-9]{1,4}[._-]?[a-z]+$"
#: Documents that hold a word of the dictionary, at least, and their share of all documents.
IN_DOCUMENTS, IN_SHARE = 5, 1e-5
#: Labelled findings that the forest learns from, at most, chosen by a hash.
SAMPLE = 20_000
TREES, DEPTH, SEED = 32, 6, 7
SECRET = 0.5
MASK = "[SECRET]"
FEATURES = [
    "length", "digits", "capitals", "small", "kinds", "distinct", "changes", "transitions",
    "covered", "slashes", "dots", "address", "hexadecimal", "announced", "assigned", "quoted",
    "words_beside",
]


def candidates(docs: DataFrame) -> DataFrame:
    """Each candidate value: doc_id, position (number of its word), value and its context."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    words = F.split("text", SPACE)
    found = F.filter(
        F.sequence(F.lit(0), F.size("words") - 1),
        lambda i: F.get(F.col("words"), i).rlike(CANDIDATE),
    )
    near = (
        docs.where(F.col("text").rlike(CANDIDATE))
        .select("doc_id", words.alias("words"))
        .withColumn("position", F.explode(found))
        .select(
            "doc_id",
            F.col("position").cast("long"),
            F.get("words", F.col("position")).alias("word"),
            *(
                F.coalesce(F.get("words", F.col("position") + by), F.lit("")).alias(name)
                for by, name in ((-2, "second_before"), (-1, "before"), (1, "after"))
            ),
        )
    )
    return _valued(near)


def _valued(near: DataFrame) -> DataFrame:
    """The values in each word: all parts of all its runs, split at assignments.

    A part that holds a known format, or ends in a few characters after a colon or an
    equals sign, counts without what surrounds it as well. `main` marks one value of
    each word, the last part of its first run.
    """
    runs = near.select("*", F.posexplode(F.regexp_extract_all("word", F.lit(RUN), 0)).alias("_n", "run"))
    split = runs.withColumn("run", F.regexp_replace("run", r"[.:-]+$", "")).withColumn(
        "parts", F.split("run", rf"[=:](?=[^=:][{_KEY}]{{5}})")
    )
    # what stands before a part in its run, so far as it could announce it
    name = F.expr(
        f"if(_i = 0, '', concat(array_join(slice(parts, greatest(_i - {BEFORE - 1}, 1), "
        f"least(_i, {BEFORE})), '='), '='))"
    )
    part = F.regexp_replace("part", r"[.:-]+$", "")
    values = F.array_distinct(
        F.concat(
            F.array(part),
            F.array(F.regexp_replace(part, "^([^=:]+)[=:]+[^=:].*$", "$1")),
            F.regexp_extract_all(part, F.lit(KNOWN_INSIDE), 0),
        )
    )
    return (
        split.select("*", F.posexplode("parts").alias("_i", "part"))
        .withColumn("name", name)
        .withColumn("_last", (F.col("_n") == 0) & (F.col("_i") == F.size("parts") - 1))
        .drop("parts")
        .select("*", F.posexplode(values).alias("_v", "value"))
        .withColumn("main", F.col("_last") & (F.col("_v") == 0))
        .drop("_n", "_i", "_v", "_last", "part")
        .where("length(value) >= 8")
    )


def dictionary(docs: DataFrame) -> DataFrame:
    """Words of small letters (word, documents) that several documents hold outside candidates.

    A key in many copies would otherwise bring its own letters into the dictionary.
    """
    least = max(IN_DOCUMENTS, math.ceil(docs.count() * IN_SHARE))
    rest = F.lower(F.regexp_replace("text", RUN, " "))
    words = F.array_distinct(F.regexp_extract_all(rest, F.lit("[a-z]{3,24}"), 0))
    counted = docs.select(F.explode(words).alias("word")).groupBy("word")
    return counted.agg(F.count("*").alias("documents")).where(F.col("documents") >= least)


def transitions(words: DataFrame) -> dict[str, float]:
    """Log probabilities of letter pairs in the dictionary, 26 * 26 at most."""
    pairs = F.transform(
        F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substr("word", i, F.lit(2))
    )
    rows = (
        words.select(F.explode(pairs).alias("pair"), "documents")
        .groupBy("pair")
        .agg(F.sum("documents").alias("n"))
        .collect()
    )
    starts: dict[str, int] = {}
    for pair, n in rows:
        starts[pair[0]] = starts.get(pair[0], 0) + n
    return {pair: math.log((n + 1) / (starts[pair[0]] + 26)) for pair, n in rows}


def _likely(value: Column, known: dict[str, float]) -> Column:
    """Mean log probability of the value's letter pairs; the lowest for unknown ones."""
    lowest = F.lit(math.log(1e-4))
    if not known:
        return lowest
    table = F.map_from_arrays(F.array(*map(F.lit, known)), F.array(*map(F.lit, known.values())))
    pairs = F.transform(
        F.sequence(F.lit(1), F.length(value) - 1),
        lambda i: F.coalesce(F.try_element_at(table, F.substr(F.lower(value), i, F.lit(2))), lowest),
    )
    return F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x) / F.size(pairs)


def described(found: DataFrame, words: DataFrame, known: dict[str, float]) -> DataFrame:
    """The candidates with FEATURES."""
    values = found.select("value").distinct()
    runs = F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,24}"), 0)
    parts = values.select("value", F.explode(runs).alias("word"))
    covered = (
        parts.join(words.select("word"), "word")
        .groupBy("value")
        .agg(F.sum(F.length("word")).alias("letters"))
    )
    value, size = F.col("value"), F.length("value").cast("double")

    def share(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)) / size

    def has(column: str | Column, pattern: str) -> Column:
        return F.regexp_like(column, F.lit(pattern)).cast("double")

    changes = "(?<=[0-9])[A-Za-z]|(?<=[A-Za-z])[0-9]|(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]"
    before = F.concat_ws(" ", "second_before", "before", "name")
    kinds = [has(value, p) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]")]
    word_like = "^[\\p{L}]+[.,;:!?]?$"
    columns = {
        "length": size,
        "digits": share("[0-9]"),
        "capitals": share("[A-Z]"),
        "small": share("[a-z]"),
        "kinds": kinds[0] + kinds[1] + kinds[2] + kinds[3],
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / size,
        "changes": share(changes),
        "covered": F.coalesce(F.col("letters"), F.lit(0)) / size,
        "slashes": share("/"),
        "dots": share("[.]"),
        "address": has("word", f"@|{ADDRESS}"),
        "hexadecimal": has(value, "^([0-9a-f]{16,}|[0-9A-F]{16,})$"),
        "announced": has(before, ANNOUNCED),
        "assigned": has(before, "[=:]\\s*$"),
        "quoted": has("word", "[\"'`]"),
        "words_beside": has("before", word_like) + has("after", word_like),
    }
    with_likeness = values.withColumn("transitions", _likely(value, known))
    facts = with_likeness.join(covered, "value", "left")
    return found.join(facts, "value").withColumns(columns)


def labelled(rows: DataFrame) -> DataFrame:
    """Label 1 or 0 for candidates whose format or context tells, null for the others."""
    told = (F.col("announced") == 1) & (F.col("assigned") == 1) & (F.col("digits") > 0)
    ordinary = F.col("value").rlike(KNOWN_PLAIN) | (F.col("covered") >= 0.6)
    plain = ordinary | (F.col("address") == 1)
    # an assigned value in the query of an address is not the address
    query = ~F.col("run").rlike(ADDRESS) & ~F.contains("word", F.lit("@"))
    label = (
        F.when(F.col("value").rlike(KNOWN_SECRET) | (told & ~ordinary & (~plain | query)), 1.0)
        .when(plain & (F.col("announced") == 0), 0.0)
    )
    return rows.withColumn("label", label)


def scan(docs: DataFrame, findings: DataFrame | None = None, sample: int = SAMPLE) -> DataFrame:
    """The secrets in documents (doc_id, text).

    Returns doc_id, position (number of the word, from 0), value and probability
    (at least SECRET). `findings` may give labelled findings (word, second_before,
    before, after, label 0 or 1) to learn from, where label 1 speaks of the last part of
    the word's first run and label 0 of all its values; without it, candidates whose format
    or context tells are labelled. At most `sample` labelled rows are used. If one
    class is missing, labelled secrets alone are reported. A null or empty text has
    none. Each value of a word is reported, also one within another. Repeated rows are
    reported each. Other columns are not read.
    """
    shared_dir(docs.sparkSession)
    words = dictionary(docs).checkpoint()
    known = transitions(words)
    rows = labelled(described(candidates(docs), words, known)).checkpoint()
    if findings is None:
        taught = rows
    else:
        near = findings.select("word", "second_before", "before", "after", "label")
        taught = described(_valued(near).where("label = 0 or main"), words, known)
    taught = (
        taught.where("label in (0, 1)")
        .select("label", *FEATURES)
        .orderBy(F.xxhash64(*FEATURES), *FEATURES, "label")
        .limit(sample)
        .checkpoint()
    )
    if taught.select("label").distinct().count() < 2:
        judged = rows.withColumn("probability", F.coalesce("label", F.lit(0.0)))
    else:
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features")
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED)
        model = forest.fit(vectors.transform(taught.coalesce(1)))
        judged = model.transform(vectors.transform(rows.drop("label", "probability")))
        # a format that only secrets have needs no vote
        certain = F.col("value").rlike(KNOWN_SECRET)
        judged = judged.withColumn(
            "probability", F.when(certain, 1.0).otherwise(vector_to_array("probability")[1])
        )
    return judged.where(F.col("probability") >= SECRET).select(
        "doc_id", "position", "value", "probability"
    )


def masked(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents, all columns, with the found values replaced in their texts.

    A column n_chars, if there is one, follows the new text. Values are replaced
    wherever they stand in the texts with their doc_id, longer ones first.
    """
    values = found.groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.sort_array(F.collect_set(F.struct(F.length("value").alias("n"), "value")), False).alias("values")
    )
    # the given columns stand in a struct, so that no name of theirs gets in the way
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("key"))
    joined = rows.join(values, F.col("key").eqNullSafe(F.col("id")), "left")
    text = F.aggregate(
        F.col("values.value"), F.col("row.text"), lambda t, v: F.replace(t, v, F.lit(MASK))
    )
    clean = F.col("values").isNull()
    out = {name: F.col("row").getField(name) for name in docs.columns}
    out["text"] = F.when(clean, out["text"]).otherwise(text)
    if "n_chars" in out:
        length = F.length(out["text"]).cast(docs.schema["n_chars"].dataType)
        out["n_chars"] = F.when(clean, out["n_chars"]).otherwise(length)
    return joined.select(*(column.alias(name) for name, column in out.items()))
