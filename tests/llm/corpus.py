"""Small documents with the cases that every operator must handle."""

import random

from pyspark.sql import types as T

#: Columns whose names operators use inside must not get in the way.
DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("chunk", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("node", T.StringType()),
        T.StructField("key", T.StringType()),
    ]
)


def words(rng, n):
    parts = ["th", "er", "on", "an", "é", "ing", "re", "at", "ü"]
    return ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n)]


def texts(seed=3, n=60):
    """Null, empty and blank texts, copies, near copies, shared passages, long texts."""
    rng = random.Random(seed)
    passage, other = " ".join(words(rng, 60)), " ".join(words(rng, 70))
    out = [None, "", " \n\t ", "one", "one", "漢字 漢字 漢字", "a b", "x" * 5000]
    for _ in range(n):
        body = words(rng, rng.choice([3, 20, 60, 150]))
        if rng.random() < 0.4:
            at = rng.randrange(len(body))
            body[at:at] = [rng.choice([passage, other, passage[7:]])]
        out.append(" ".join(body).replace(" th ", "\nTh  "))
    copies = rng.choices(out[8:], k=20)
    near = [t.replace("er", "ER").replace(t.split()[0], "new", 1) for t in rng.choices(out[8:], k=10)]
    out += copies + near + [" ".join(words(rng, 6000)), "de " * 300]
    return out


def documents(spark, values=None, sources=("a", "b", "é", None)):
    values = texts() if values is None else values
    rows = [
        (i, t, "en", sources[i % len(sources)], len(t) if t is not None else None, "c", "s", "n", "k")
        for i, t in enumerate(values)
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


def with_odd_rows(spark, df):
    """Two rows without an id and one that repeats."""
    first = df.where("doc_id = 20")
    text = first.first()["text"]
    odd = spark.createDataFrame([(None, text, *[None] * 7), (None, None, *[None] * 7)], DOCUMENTS)
    return df.unionByName(first).unionByName(odd)
