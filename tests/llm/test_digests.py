"""Digests of texts against plain counting, and the order of documents."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from corpus import DOCUMENTS, documents, texts, with_odd_rows

from gazette.llm import digests, queries

SF = "/root/testdata/sf0.001"


def plain(text):
    """The digest by its definition, one triplet at a time."""
    data = (text or "").encode()
    counts = Counter()
    for kind, (i, j) in enumerate(((1, 2), (1, 3), (2, 3))):
        for p in range(len(data) - j):
            value = data[p] + (data[p + i] << 8) + (data[p + j] << 16) + (kind << 24)
            counts[(value * 2654435761) % 2**32 >> 24] += 1
    ranked = sorted(counts[b] for b in range(256))
    codes = [sum(counts[b] > ranked[q] for q in (63, 127, 191)) for b in range(256)]
    length, step = 0, 1
    while step <= len(data):
        length, step = length + 1, step + max(1, step // 8)
    head = "".join("%x" % (4 * a + b) for a, b in zip(codes[::2], codes[1::2], strict=True))
    return f"{head}{length:02x}"


def plain_likeness(one, other):
    def codes(digest):
        return [c for x in digest[:128] for c in divmod(int(x, 16), 4)], int(digest[128:], 16)

    (a, m), (b, n) = codes(one), codes(other)
    chance = sum(abs(x - y) for x in a for y in b) / 256
    body = sum(abs(x - y) for x, y in zip(a, b, strict=True)) / chance if chance else 0
    return max(0.0, 1 - body - min(20, abs(m - n)) / 20)


def order(rows):
    """Documents in their total order; the hash of a text only breaks ties of one id."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def test_digest_is_its_definition(spark, monkeypatch):
    monkeypatch.setattr(digests, "SLICE_BYTES", 1000)
    rows = digests.fingerprints(documents(spark)).collect()
    values = texts()
    assert len(rows) == len(values)
    for r in rows:
        assert r["fingerprint"] == plain(values[r["doc_id"]])
        assert r["n_bytes"] == len((values[r["doc_id"]] or "").encode())


def test_a_long_text_is_counted_in_slices():
    rng = random.Random(1)
    text = "".join(rng.choices("abcdé \n", k=3 * digests.SLICE_BYTES // 2)).encode()
    body = np.frombuffer(b"xy" + text + b"z", np.uint8)
    got = digests.digests(body, np.array([0, 2, 2 + len(text), 3 + len(text)]))
    alone = digests.digests(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert (got[1] == alone[0]).all()
    assert digests.as_hex(got[[0, 2]]) == [plain("xy"), plain("z")]


def test_likeness_is_its_definition_and_bounded():
    values = texts()
    known = [plain(t) for t in values]
    rng = random.Random(2)
    pairs = [(rng.choice(known), rng.choice(known)) for _ in range(300)]
    pairs += [(k, k) for k in known] + [(known[1], known[1][:128] + "ff")]
    a, b = (digests.from_hex([p[i] for p in pairs]) for i in (0, 1))
    got = digests.likeness(a, b)
    assert np.allclose(got, [plain_likeness(*p) for p in pairs], atol=1e-12)
    assert (got == digests.likeness(b, a)).all() and got.min() >= 0 and got.max() <= 1
    assert (got[300:-1] == 1).all() and got[-1] == 0


@pytest.mark.parametrize("part_bytes", [2000, 1 << 20])
def test_edited_likeness(spark, part_bytes, monkeypatch):
    monkeypatch.setattr(digests, "FEWEST", 1)
    values = texts()
    got = {r["doc_id"]: r for r in digests.edited_likeness(documents(spark), part_bytes).collect()}
    assert sorted(got) == list(range(len(values)))
    for i, text in enumerate(values):
        text, after = text or "", values[(i + 1) % len(values)] or ""
        n = len(text) // 4
        changed = text[: len(text) - n] + after[:n]
        r = got[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["fingerprint"] == plain(text) and r["edited_fingerprint"] == plain(changed)
        assert abs(r["near_edited"] - plain_likeness(plain(text), plain(changed))) < 1e-12
        assert abs(r["near_next"] - plain_likeness(plain(text), plain(after))) < 1e-12


@pytest.mark.parametrize("part_bytes", [1000, 1 << 20])
def test_ties_nulls_and_repeated_rows(spark, part_bytes):
    """Every row has one successor, whichever way rows of one id are ordered."""
    df = with_odd_rows(spark, documents(spark))
    hot = spark.createDataFrame(
        [(None, t, *[None] * 7) for t in ["same"] * 40 + [f"other {i}" for i in range(40)]], DOCUMENTS
    )
    df = df.unionByName(hot).repartition(7)
    rows = [(r["doc_id"], r["text"] or "") for r in df.collect()]
    got = digests.edited_likeness(df, part_bytes).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    assert Counter(r["fingerprint"] for r in got) == Counter(plain(t) for _, t in rows)
    again = digests.edited_likeness(df.repartition(3), part_bytes).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    # a copy is followed by its copy, but for the last one
    same = [r for r in got if r["fingerprint"] == plain("same")]
    assert sum(r["near_next"] == 1 for r in same) >= 39
    ordered = order(rows)
    last = [r for r in got if r["doc_id"] == ordered[-1][0]]
    assert any(r["near_next"] == plain_likeness(r["fingerprint"], plain(t))
               for r in last for i, t in rows if i is None)


def test_small_tables(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    assert digests.edited_likeness(empty).count() == 0 and digests.fingerprints(empty).count() == 0
    (one,) = digests.edited_likeness(documents(spark, ["abcdefgh"])).collect()
    assert one["near_next"] == 1.0
    assert one["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()
    rows = digests.edited_likeness(documents(spark, [None, "", None])).collect()
    assert [r["near_next"] for r in rows] == [1.0] * 3 and {r["n_chars"] for r in rows} == {0}


def test_compared_keeps_columns_and_nulls(spark):
    df = spark.createDataFrame(
        [(plain("a text"), plain("a text"), 1), (None, plain("a"), 2), (plain("a" * 90), plain("b c"), 3)],
        "one string, other string, likeness_ long",
    )
    got = {r["likeness_"]: r["likeness"] for r in digests.compared(df, "one", "other").collect()}
    assert got[1] == 1 and got[2] is None and got[3] < 0.5


def test_edited_texts_are_nearer_than_others(spark):
    rows = queries.op11_text_digests(spark, SF).collect()
    near, far = (np.array([r[c] for r in rows]) for c in ("near_edited", "near_next"))
    assert (near > far).mean() >= 0.98
    assert (near[:, None] > far[None, :]).mean() >= 0.98
