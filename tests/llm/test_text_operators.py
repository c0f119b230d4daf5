"""Operators on texts against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from corpus import DOCUMENTS, documents, texts, with_odd_rows, words
from pyspark.sql import functions as F

from gazette.llm import (
    chunks, decontamination, hashing, katz, pii, quality, queries, repeats, simhash, suffixes,
)

SMALL = {"chunk_bytes": 4000}
SF = "/root/testdata/sf0.001"


def lowered(text):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()


def covered(n, starts, width):
    out = [False] * n
    for s in starts:
        out[s : s + width] = [True] * width
    return out


def spans(mask):
    edges = np.flatnonzero(np.diff(np.concatenate(([0], np.array(mask, np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


@pytest.mark.parametrize("width", [3, 35])
def test_repeated_windows(spark, width):
    rows = {i: (t or "").encode().split() for i, t in enumerate(texts())}
    seen = Counter(tuple(w[i : i + width]) for w in rows.values() for i in range(len(w) - width + 1))
    got = repeats.repeated_windows(documents(spark), width, **SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        w = rows[r["doc_id"]]
        starts = [i for i in range(len(w) - width + 1) if seen[tuple(w[i : i + width])] > 1]
        gone = covered(len(w), starts, width)
        assert r["n_words"] == len(w)
        assert [(s["start"], s["end"]) for s in r["removed"]] == spans(gone)
        assert r["kept"].encode() == b" ".join(x for x, g in zip(w, gone, strict=True) if not g)


def crafted(n):
    """Two words of n letters (a power of two) that collide modulo 2^64, whatever the base."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return one, one.translate(str.maketrans("ab", "ba"))


def test_crafted_words_are_told_apart(spark):
    first, second = crafted(1024)
    same = [f"w{i}" for i in range(34)]
    df = documents(spark, [" ".join([first, *same]), " ".join([second, *same])])
    assert {r["removed"] == [] for r in repeats.repeated_windows(df, 35).collect()} == {True}
    one, other = crafted(2048)
    rows = [(0, one, True), (1, other, False), (2, one, False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean")
    known = {r["doc_id"]: r["n_known"] for r in katz.katz_scores(docs, order=3).collect()}
    assert known == {0: 2, 1: 1, 2: 2}


def test_word_hashes_are_polynomials_modulo_a_prime(monkeypatch):
    monkeypatch.setattr(hashing, "LONG_WORD", 300)
    rng = np.random.default_rng(3)
    words = [rng.integers(33, 255, int(n)).astype(np.uint8).tobytes() for n in [1, 2, 3, 17, 256, 300, 301, 5000, 1]]
    body = np.frombuffer(b" ".join(words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    for base in (hashing.WORD_BASE, hashing.SECOND_BASE):
        got = hashing.word_hashes(body, starts, ends, base)
        plain = [sum((c + 1) * pow(base, i, hashing.PRIME) for i, c in enumerate(w)) % hashing.PRIME
                 for w in words[:6]]
        assert got[:6].tolist() == hashing.mix(np.array(plain, np.uint64)).tolist()
        assert len(set(got.tolist())) == len(set(words))  # long words too


def test_short_words_have_the_same_polynomials():
    rng = np.random.default_rng(4)
    sizes = [*range(1, 42), 32, 33, 1, 8, 32, 33]
    words = [rng.integers(33, 256, n).astype(np.uint8).tobytes() for n in sizes[:41]]
    words += [b"\xff" * n for n in sizes[41:]]  # the greatest sums
    body = np.frombuffer(b" ".join(words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - np.array(sizes)
    for base in (hashing.WORD_BASE, hashing.SECOND_BASE, hashing.PRIME - 2):
        plain = [sum((c + 1) * pow(base, i, hashing.PRIME) for i, c in enumerate(w)) % hashing.PRIME for w in words]
        want = hashing.mix(np.array(plain, np.uint64)).tolist()
        assert hashing.word_hashes(body, starts, ends, base).tolist() == want
        some = np.array([40, 3, 44, 31])  # any words, in any order
        assert hashing.word_hashes(body, starts[some], ends[some], base).tolist() == [want[i] for i in some]


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 70_000])
def test_distinct_and_among(n):
    rng = np.random.default_rng(n)
    values = hashing.mix(rng.integers(0, 1 + n // 2, n).astype(np.uint64))
    values[:2] = [0, (1 << 64) - 1][: len(values)]
    keys = hashing.distinct(values)
    assert keys.tolist() == sorted(set(values.tolist()))
    for some in (keys, keys[::3], keys[:1], keys[:0], keys ^ np.uint64(1)):
        some = np.sort(some)
        known = set(some.tolist())
        assert hashing.among(values, some).tolist() == [v in known for v in values.tolist()]


def test_removed_words_of_texts_that_touch():
    rng = random.Random(6)
    rows = ["a", "", "b c", " ", "d  e\tf ", "\n\u00e9 \u00df", "g", *(" ".join("x" * rng.randint(1, 3) for _ in range(9)) for _ in range(40))]
    data = [t.encode() for t in rows]
    own = hashing.Words(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    for share in (0, 0.5, 0.9, 1):
        gone = np.array([rng.random() < share for _ in own.starts])
        want, removed = [], []
        for t, a, b in zip(data, own.borders, own.borders[1:], strict=False):
            want.append(b" ".join(w for w, g in zip(t.split(), gone[a:b], strict=True) if not g).decode())
            removed.append([{"start": s, "end": e} for s, e in spans(gone[a:b])])
        assert repeats.kept_words(own, gone).to_pylist() == want
        assert repeats.spans_by_text(gone, own.borders).to_pylist() == removed


def test_steps_of_repeats_sort_hashes_and_hash_few_words_twice(monkeypatch):
    """np.unique alone fills a hash table, by far the dearest step of a chunk."""
    acts = []

    class Recorder:
        n = 4
        each = each_with = lambda self, *args: acts.append(args[-2])

    monkeypatch.setattr(chunks, "Chunks", lambda docs, **options: Recorder())
    monkeypatch.setattr(chunks, "answer", lambda *args: None)
    repeats.repeated_windows(None, 5)
    plain, hashed = np.unique, Counter()

    def unique(values, **wanted):
        assert wanted, "a hash table of all windows"
        return plain(values, **wanted)

    def word_hashes(body, starts, ends, base):
        hashed[base] += len(starts)
        return hash_words(body, starts, ends, base)

    hash_words = hashing.word_hashes
    monkeypatch.setattr(np, "unique", unique)
    for module in (hashing, repeats):
        monkeypatch.setattr(module, "word_hashes", word_hashes, raising=False)
    data = [b"one two three four five six"] * 2 + [b" ".join(b"w%d" % i for i in range(500))]
    sizes = np.array([len(t) for t in data])
    texts = chunks.Texts(np.arange(3), sizes, np.frombuffer(b"".join(data), np.uint8), np.zeros(3, bool))
    ask, ask_again, remove = acts

    def reply(asked, rule, *kinds):
        parts = [chunks.unsqueeze(b, np.uint8, *kinds) for b in asked["body"].to_pylist()]
        bodies = [chunks.squeeze(rule(chunks.long_keys(k), None, *c)) for k, *c in parts]
        return asked.select(["bucket", "chunk"]).append_column("body", [bodies])

    asked = ask(0, texts)
    replies = reply(asked, lambda keys, sender: np.zeros(len(keys), bool))
    asked = ask_again(0, texts, replies)
    assert hashed == {hashing.WORD_BASE: 1024, hashing.SECOND_BASE: 12}
    got = remove(0, texts, reply(asked, repeats._confirmed, np.uint64, bool)).to_pydict()
    assert got["kept"] == ["", "", data[2].decode()]


def test_only_confirmed_windows_repeat():
    whole = np.array([5, 6, 7, 5, 8, 9], np.uint64)
    keys, sender = whole & np.uint64(1), np.array([0, 0, 0, 1, 1, 1])  # the first hash sees two windows
    many = np.array([False, True, False, False, False, False])
    assert repeats._confirmed(keys, sender, whole, many).tolist() == [5, 6, 0, 5, 0, 0]


@pytest.mark.parametrize("width", [16, 50])
def test_remove_repeats(spark, width, monkeypatch):
    # a low bound, so that crowded anchors are dealt by their windows
    monkeypatch.setattr(suffixes, "SORTED_TOGETHER", 2)
    rows = {i: (t or "").encode() for i, t in enumerate(texts())}
    first = {}
    for i in sorted(rows):
        for s in range(len(rows[i]) - width + 1):
            first.setdefault(rows[i][s : s + width], i)
    got = suffixes.remove_repeats(documents(spark), width, **SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        t = rows[r["doc_id"]]
        starts = [s for s in range(len(t) - width + 1) if first[t[s : s + width]] < r["doc_id"]]
        gone = covered(len(t), starts, width)
        assert r["n_bytes"] == len(t)
        assert [(s["start"], s["end"]) for s in r["removed"]] == spans(gone)
        assert bytes(r["kept"]) == bytes(c for c, g in zip(t, gone, strict=True) if not g)


def test_suffix_sort():
    rng = np.random.default_rng(0)
    text = rng.integers(0, 3, 3000).astype(np.uint8)
    starts = rng.integers(0, 2900, 500)
    group = np.sort(rng.integers(0, 20, 500))
    order = suffixes.Suffixes(text, starts, 40).sort(group)
    keys = [(group[i], text[starts[i] : starts[i] + 40].tobytes()) for i in range(500)]
    assert [keys[i] for i in order] == sorted(keys)


def test_katz_is_brute_force(spark):
    rows = {i: lowered(t) + ["end"] for i, t in enumerate(texts())}
    train = {i for i in rows if i % 4}
    uni, bi = Counter(), Counter()
    for i in train:
        uni.update(rows[i])
        bi.update(zip(["begin", *rows[i]], rows[i], strict=False))
    n, types, k = sum(uni.values()), len(uni), katz.GOOD_TURING

    def table(counts):
        return katz.discounts(np.array([sum(c == r for c in counts.values()) for r in range(1, k + 2)]))

    def cut(c, d):
        return c - d[k + 1] if c > k else c * d[c]

    d1, d2 = table(uni), table(bi)
    single = {w: cut(c, d1) / n for w, c in uni.items()}
    unknown = 1 - sum(single.values())
    history = {**uni, "begin": len(train)}
    after = defaultdict(list)
    for (h, w), c in bi.items():
        after[h].append((w, c))
    weight = {
        h: (1 - sum(cut(c, d2) / history[h] for _, c in ws)) / (1 - sum(single[w] for w, _ in ws))
        for h, ws in after.items()
    }
    for h in after:  # exactly normalised
        whole = sum(
            cut(bi[h, w], d2) / history[h] if (h, w) in bi else weight[h] * single[w] for w in uni
        )
        assert abs(whole + weight[h] * unknown - 1) < 1e-9
    docs = documents(spark).withColumn("train", F.col("doc_id") % 4 != 0)
    got = katz.katz_scores(docs, **SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        w = rows[r["doc_id"]]
        score = sum(
            math.log10(
                cut(bi[h, x], d2) / history[h] if (h, x) in bi
                else weight.get(h, 1) * single.get(x, unknown)
            )
            for h, x in zip(["begin", *w], w, strict=False)
        )
        base = sum(math.log10((uni[x] + 1) / (n + types + 1)) for x in w)
        assert abs(r["score"] - score) < 1e-6 and abs(r["base_score"] - base) < 1e-6
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(x in uni for x in w), n)


def test_katz_trigrams_and_no_training(spark):
    docs = documents(spark).withColumn("train", F.col("doc_id") % 4 != 0)
    by_order = [
        katz.katz_scores(docs, order, **SMALL).where("train").agg(F.sum("score")).first()[0]
        for order in (1, 2, 3)
    ]
    assert by_order[0] < by_order[1] < by_order[2] < 0
    none = katz.katz_scores(docs.withColumn("train", F.lit(None).cast("boolean")), **SMALL)
    assert none.agg(F.min("score"), F.max("base_score"), F.max("train_tokens")).first() == (0, 0, 0)


def test_katz_query_is_brute_force_trigrams(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = {r["doc_id"]: ["begin", "begin", *lowered(r["text"]), "end"] for r in docs}
    train = [i for i in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = [Counter(), Counter(), Counter()]
    for i in train:
        for at in range(2, len(rows[i])):
            for m in range(3):
                counts[m][tuple(rows[i][at - m : at + 1])] += 1
    n, k = sum(counts[0].values()), katz.GOOD_TURING
    of = [{(): n}, {**counts[0], ("begin",): len(train)}, {**counts[1], ("begin",) * 2: len(train)}]
    tables = [
        katz.discounts(np.array([sum(c == r for c in own.values()) for r in range(1, k + 2)]))
        for own in counts
    ]

    def seen(gram):
        m = len(gram) - 1
        c, d = counts[m][gram], tables[m]
        return (c - d[k + 1] if c > k else c * d[c]) / of[m][gram[:-1]]

    unknown = 1 - sum(seen(g) for g in counts[0])
    weights = [{}, {}, {}]

    def probability(gram):
        m = len(gram) - 1
        if gram in counts[m]:
            return seen(gram)
        return weights[m].get(gram[:-1], 1) * probability(gram[1:]) if m else unknown

    for m in (1, 2):
        left, rest = defaultdict(lambda: 1.0), defaultdict(lambda: 1.0)
        for g in counts[m]:
            left[g[:-1]] -= seen(g)
            rest[g[:-1]] -= probability(g[1:])
        weights[m].update((h, left[h] / rest[h]) for h in left)
    got = {r["doc_id"]: r["score"] for r in queries.op6_katz_scores(spark, SF).collect()}
    assert set(got) == set(rows)
    for i, w in rows.items():
        score = sum(math.log10(probability(tuple(w[at - 2 : at + 1]))) for at in range(2, len(w)))
        assert abs(got[i] - score) < 1e-6 * abs(score)


def test_places_come_back():
    rng = np.random.default_rng(5)
    sorted_ = np.sort(rng.integers(0, 1 << 63, 3000).astype(np.uint64))
    arrays = [
        np.diff(sorted_, prepend=np.uint64(0)), rng.integers(0, 3, 9).astype(np.uint32), rng.random(700),
        rng.random(2001) < 0.1, np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(500, np.int64),
        np.array([1 << 40]), *[rng.integers(0, 9, n).astype(np.uint8) for n in range(9, 60)],
    ]
    back = chunks.unsqueeze_places(chunks.squeeze_places(*arrays), *[a.dtype.type if a.dtype != bool else bool for a in arrays])
    assert all(a.dtype == b.dtype and np.array_equal(a, b) for a, b in zip(arrays, back, strict=True))


def test_katz_asks_with_few_bytes():
    # before: 6 bytes of each hash, and four of its count compressed across its zeros
    text = np.frombuffer(" ".join(f"w{i}" for i in range(60_000)).encode(), np.uint8)
    texts = chunks.Texts(np.array([1]), np.array([len(text)]), text, np.array([True]))
    grams = katz.Grams(texts, 3)
    sent = sum(len(b) for b in katz.ask_counts(0, grams, 20)["body"].to_pylist())
    assert sent < 5.3 * sum(len(k) for k in grams.keys)


def test_katz_shares_are_exchanged_where_several_chunks_need_them():
    keys = np.array([1, 2, 3, 4, 5, 1, 3, 4, 5], np.uint64)  # of two chunks
    counts = np.array([1, 1, 0, 2, 1, 1, 1, 0, 0], np.uint32)
    held = np.array([0, 1, 1, 1, 0, 1, 0, 1, 0], bool)
    _, owner, wanted, _ = katz.total_counts(keys, counts, held, katz.GOOD_TURING)
    assert owner.tolist() == [True, True, False, True, True, False, True, False, False]
    # 2 is used by its one holder, 5 by none
    assert dict(zip(keys.tolist(), wanted.tolist(), strict=True)) == {1: True, 2: False, 3: True, 4: True, 5: False}


def components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("crowded", [2, 1024])
def test_simhash(spark, crowded, monkeypatch):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    mark = {}
    for i, t in enumerate(texts()):
        w = [x.decode() for x in lowered(t)]
        shingles = [" ".join(w[j : j + 3]) for j in range(max(1, len(w) - 2))] if w else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        mark[i] = sum(
            1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
        )
    radius = 6  # wider than in production, so that there is more to find
    near = [(a, b) for a in mark for b in mark if a < b and (mark[a] ^ mark[b]).bit_count() <= radius]
    want = components(mark, near)
    got = simhash.near_duplicates(documents(spark), 3, radius).collect()
    assert {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in got} == {
        i: (mark[i], want[i]) for i in mark
    }


def plain_fingerprint(text, size=3):
    w = [x.decode() for x in lowered(text)]
    own = [" ".join(w[j : j + size]) for j in range(max(1, len(w) - size + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in own]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def rng_of(seed):
    return random.Random(seed)


@pytest.mark.parametrize("radius", [2, 6])
def test_one_of_each_group_stays(spark, radius):
    long = " ".join(f"word{i}" for i in range(300))
    other = " ".join(f"other{i}" for i in range(300))
    rows = list(enumerate(texts()))
    # near copies, an id in two groups, ids that repeat, rows without an id
    rows += [(900, long), (901, long + " tail"), (902, long + " tail more"), (901, other), (950, other)]
    rows += [(5, "row of the fifth id"), (5, "row of the fifth id"), (None, other), (None, "alone it stays")]
    rows += [(None, "alone it stays"), (None, None), (3000, "z " * 50_000), (3001, "z " * 60_000)]
    df = spark.createDataFrame(
        [(i, t, f"f{n}", f"r{n}") for n, (i, t) in enumerate(rows)],
        "doc_id long, text string, fingerprint string, root string",
    )
    mark = [plain_fingerprint(t) for _, t in rows]
    nodes = range(len(rows))
    near = [(a, b) for a in nodes for b in nodes if a < b and (mark[a] ^ mark[b]).bit_count() <= radius]
    group = components(nodes, near)

    def order(n):
        i, t = rows[n]
        signed = mark[n] - (1 << 64) * (mark[n] >> 63)
        return (i is None, i or 0, signed, t is not None, (t or "").encode())

    want = {}
    for n in nodes:
        want[group[n]] = min(want.get(group[n], n), n, key=order)
    got = simhash.one_of_each_group(df, 3, radius)
    assert got.columns == df.columns
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in got.collect()) == sorted(
        (rows[n][0] or -1, rows[n][1] or "") for n in want.values()
    )
    assert simhash.one_of_each_group(df.limit(0)).count() == 0


def test_quality_learns_the_labels(spark):
    rows = queries.op1_quality_scores(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    right = (F.col("predicted") == F.col("quality")).cast("int")
    held_out = rows.join(labels, "doc_id").where("held_out").agg(F.avg(right), F.count("*")).first()
    assert held_out[0] >= 0.95 and held_out[1] > 50
    assert rows.where("score < 0 or score > 1 or score is null").count() == 0


def test_quality_statistics_are_those_of_the_text(spark):
    body, offsets = (b"A a a b. #!" + "é\n".encode()), np.array([0, 11, 11, 14])
    rows = quality.text_statistics(np.frombuffer(body, np.uint8), offsets) / quality.GRID
    names = dict(zip(quality.STATISTICS, rows.T, strict=True))
    more, extra = quality.MORE_BYTES, quality.MORE_WORDS
    assert names["symbols"][0] == pytest.approx(math.log(quality.SHARE + 2 / (11 + more)), abs=0.01)
    assert names["repeated_neighbours"][0] == pytest.approx(math.log(quality.SHARE + 1 / (5 + extra)), abs=0.01)
    assert names["distinct_words"][0] == pytest.approx(math.log((4 + extra) / (5 + extra)), abs=0.01)
    assert (rows[1] == quality.text_statistics(np.zeros(0, np.uint8), np.array([0, 0]))[0] / quality.GRID).all()


def test_quality_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(9, 1), (10, 1), (11, None)], "doc_id long, quality int")
    for labels, score in ((none, 0.5), (one, 1.0)):
        got = quality.quality_scores(documents(spark), labels)
        assert {r["score"] for r in got.collect()} == {score}


PERSONAL = [
    "mail a.b@x.example.com, or c@d.e twice: c@d.e.", "@ a@ @b x@y z@w.", "a@b@c.de é@é.fr q@q.q@r.r",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112",
    "4111111111111111 5500005555555559 12 3", "+1 (437) 555-0689 x +49 1 2 +123456789012345678",
    "+1  ()   " + " " * 500 + "9", "7" * 3000, None, "", "nothing here", "é" * 9 + " +33 1 23 45 67 89",
]


def test_personal_data_base_spans(spark):
    patterns = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and (
            sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
    ]
    values = PERSONAL + texts()
    df = documents(spark, values)
    got = {r["doc_id"]: r["spans"] for r in pii.personal_data(df).collect()}
    for i, t in enumerate(values):
        want = [
            (kind, *m.span()) for kind, p, ok in patterns for m in re.finditer(p, t or "") if ok(m[0])
        ]
        assert [(s["kind"], s["start"], s["end"]) for s in got[i] if s["base"]] == want, t
        for s in got[i]:
            if not s["base"]:
                assert not any(s["start"] < e and b < s["end"] for _, b, e in want)


def test_the_field_carries_labels_to_distant_mentions():
    """The same number again, without the plus that the pattern wants."""
    rng = np.random.default_rng(1)
    taught = []
    for i in range(120):
        number = f"{rng.integers(100, 999)}-{rng.integers(1000, 9999)}"
        word = ["call", "ring", "dial"][i % 3]
        taught.append(f"{word} +1 (555) {number} today {i % 7} times and again +1 (555) {number} there")
    graphs = [pii.graph_of(t, pii.base_spans(t)) for t in taught]
    at = np.cumsum([0, *[len(g.labels) for g in graphs]])

    def links(name):
        rows = [(a + s, b + s) for g, s in zip(graphs, at, strict=False) for a, b in getattr(g, name)]
        return np.array(rows, np.int64).reshape(-1, 2)

    weights = pii.learn(
        np.concatenate([g.features for g in graphs]),
        np.concatenate([g.labels for g in graphs]), links("chain"), links("skip"),
    )
    phone = pii.KINDS.index("phone") + 1
    assert weights.skip[phone, phone] > weights.skip[phone, 0]
    text = "call +1 (555) 321-7654 today 3 times, room 12, number (555) 321-7654 there"
    alone = "room 12 and 3 times, page 321 there"
    added = pii.added_spans(text, weights, pii.base_spans(text))
    assert [text[a:b] for _, a, b in added] == ["(555) 321-7654"]
    assert pii.added_spans(alone, weights, []) == []


def test_the_query_adds_second_mentions(spark, tmp_path):
    """Weights learnt from the query's own table find planted mentions, and no strangers."""
    rng = np.random.default_rng(4)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")

    def number(size):
        return "".join(str(d) for d in rng.integers(0, 10, size))

    def card():
        body = "4" + number(14)
        return next(body + str(d) for d in range(10) if pii.luhn(body + str(d)))

    planted, want = [], {}
    for i in range(60):
        kind = pii.KINDS[i % 4]
        if kind == "phone":
            first = f"+1 ({number(3)}) 555-{number(4)}"
            second = first.replace("+1 (", "").replace(") ", "-")
            stranger = f"{number(3)}-556-{number(4)}"
        elif kind == "card":
            first, other = card(), card()
            second, stranger = (".".join(x[j : j + 4] for j in (0, 4, 8, 12)) for x in (first, other))
        elif kind == "ip":
            parts = [str(x) for x in rng.integers(10, 256, 8)]
            first, second, stranger = ".".join(parts[:4]), "-".join(parts[:4]), "-".join(parts[4:])
        else:
            name = f"{'abcdefghij'[i % 10]}lex.{number(3)}"
            first, second, stranger = f"{name}@mail{i}.example.com", name, f"kim.{number(3)}"
        fill = [" ".join(words(rng_of(10 * i + j), 20)) for j in range(4)]
        text = f"{fill[0]} {first} {fill[1]} {second} {fill[2]} {stranger} {fill[3]}"
        planted.append((10**9 + i, text))
        at = text.index(f" {second} ", len(fill[0]) + len(first) + 2) + 1
        want[10**9 + i] = f"{kind}:{at}:{at + len(second)}"
    more = spark.createDataFrame(planted, "doc_id long, text string")
    docs.unionByName(more).write.parquet(f"{tmp_path}/documents.parquet")
    added = set()
    for r in queries.op3_personal_data(spark, str(tmp_path)).collect():
        known = pii.base_spans(next((t for i, t in planted if i == r["doc_id"]), ""))
        base = {f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in known}
        if r["doc_id"] in want:
            added |= {(r["doc_id"], s) for s in r["spans"].split(",") if s not in base}
        else:  # in the table itself a mention rarely stands twice
            n = sum(r[f"n_{k}"] for k in pii.KINDS)
            added |= {(r["doc_id"], s) for s in r["spans"].split(",")[n:]} if r["spans"] else set()
    found = added & set(want.items())
    assert len(found) >= 0.9 * len(want), sorted(set(want.items()) - found)
    assert len(found) >= 0.9 * len(added), sorted(added - found)


def test_decontamination(spark):
    items = [
        (1, "Who wrote the long letter about the seven ships of winter? It was the old captain himself."),
        (2, "The river runs below the mill and past the orchard. Then it meets the sea."),
        (3, "two words"), (4, None), (5, ""), (None, "An item without any number that is still an item here"),
        (1, "Who wrote the long letter about the seven ships of winter? It was the old captain himself."),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    filler = " ".join(t for t in texts() if t)[:6000]
    values = [
        filler + " " + items[0][1].upper().replace(" ", "  ") + " " + filler,
        "nothing of it", items[1][1][:40], None, "", "so two  WORDS, here", items[5][1],
        filler[:997] + items[1][1].replace(",", "") + "### " + filler,
    ]
    df = documents(spark, values)
    got = Counter((r["doc_id"], r["item_id"]) for r in decontamination.hits(df, bench).collect())
    assert got == {(0, 1): 2, (5, 3): 1, (6, None): 1, (7, 2): 1}
    clean = decontamination.without_items(df, bench)
    assert clean.columns == df.columns
    assert {r["doc_id"] for r in clean.collect()} == {1, 2, 3, 4}
    assert decontamination.hits(df, bench.limit(0)).count() == 0


def test_block_max_wand_returns_all_above_the_threshold():
    rng = np.random.default_rng(2)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [" ".join(rng.choice(vocabulary, rng.integers(3, 20))) for _ in range(300)]
    index = decontamination.Index(list(range(300)), items, retrieved=0.6)
    dense = np.zeros((len(index.terms), 300))
    dense[index.term, index.item] = index.weight
    assert index.block_items > 1
    for _ in range(40):
        terms = np.unique(rng.integers(0, len(index.terms), rng.integers(1, 25)))
        scores = dense[terms].sum(0)
        got = dict(decontamination.block_max_wand(index, terms.tolist()))
        assert got == pytest.approx({i: scores[i] for i in np.flatnonzero(scores >= 1 - 1e-9)})


def plain_hits(texts, items):
    """Items whose five-word sequences, or those of a long part, are in one text, by plain sets.

    The texts are shorter than a passage, so a text is one passage.
    """
    def words(text):
        return re.findall(r"[a-z0-9\u0080-\uffff]+", lowered_text(text))

    def grams(text, size):
        w = words(text)
        return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}

    out = {}
    for d, text in texts.items():
        for i, item in items.items():
            size = min(5, len(words(item)))
            parts = decontamination.question_and_answer(item)
            have = grams(text, size) if size else set()
            shares = [len(grams(p, size) & have) / len(grams(p, size)) if size and grams(p, size) else 0.0
                      for p in (item, *parts)]
            long = [s for p, s in zip(parts, shares[1:], strict=True) if len(words(p)) >= 12]
            if shares[0] >= 0.6 or any(s >= 0.8 for s in long):
                out[d, i] = shares
    return out


def lowered_text(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@pytest.mark.parametrize("index_bytes", [8 << 20, 1500])
def test_hits_are_brute_force_in_one_index_or_several(spark, index_bytes):
    """Whole items, questions alone, answers alone, parts of them, and what only looks alike."""
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(400)]

    def some(n):
        return " ".join(rng.choice(vocabulary, n))

    items, texts = {}, {}
    for i, (q, a) in enumerate([(18, 60), (60, 18), (14, 14), (30, 3), (3, 30), (8, 8)] * 4):
        question, answer = some(q) + "?", some(a)
        items[i] = f"{question} {answer}"
        cut = question.split()
        for kind, body in enumerate((items[i], question, answer, " ".join(cut[: len(cut) // 2]),
                                     " ".join(rng.permutation(items[i].split())))):
            texts[10 * i + kind] = f"{some(12)} {body} {some(9)}"
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = plain_hits(texts, items)
    assert {k % 10 for k, _ in want} == {0, 1, 2}
    got = decontamination.hits(df, bench, index_bytes=index_bytes).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == set(want)
    for r in got:
        ours = [r["overlap"], r["question_overlap"], r["answer_overlap"]]
        assert ours == pytest.approx(want[r["doc_id"], r["item_id"]])
    if index_bytes < 2000:
        whole = decontamination.hits(df, bench).collect()
        assert sorted((*r[:2], round(r[2], 9)) for r in got) == sorted((*r[:2], round(r[2], 9)) for r in whole)


OPERATORS = {
    "repeats": lambda df: repeats.repeated_windows(df, 5, **SMALL),
    "suffixes": lambda df: suffixes.remove_repeats(df, 20, **SMALL),
    "katz": lambda df: katz.katz_scores(df.withColumn("train", F.lit(True)), **SMALL),
    "simhash": simhash.near_duplicates,
    "quality": lambda df: quality.quality_scores(df, df.select("doc_id", (F.col("doc_id") % 2).alias("quality"))),
    "pii": pii.personal_data,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_empty_tables(spark, name):
    df = with_odd_rows(spark, documents(spark))
    assert OPERATORS[name](df).count() == df.count()
    assert OPERATORS[name](spark.createDataFrame([], DOCUMENTS)).count() == 0
    null = spark.createDataFrame([(1, *[None] * 8), (2, *[None] * 8)], DOCUMENTS)
    assert OPERATORS[name](null).count() == 2


def test_rows_with_one_id_take_nothing_from_each_other(spark):
    text = "the same string of more than twenty bytes " * 3
    df = spark.createDataFrame([(None, text), (4, text), (4, text)], "doc_id long, text string")
    got = suffixes.remove_repeats(df, 20).select("doc_id", F.length("kept").alias("n")).collect()
    assert sorted((r["doc_id"] or 0, r["n"]) for r in got) == [(0, len(text)), (4, 0), (4, 0)]
    got = suffixes.remove_repeats(df.where("doc_id = 4"), 20).select(F.length("kept")).collect()
    assert [r[0] for r in got] == [len(text)] * 2


def test_query_digests(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op10_repeated_windows(spark, SF).collect():
        if not r["n_removed"]:
            kept = " ".join(re.findall(r"[^\x20\x09-\x0D]+", docs[r["doc_id"]]))
            assert r["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
    for r in queries.op6_katz_scores(spark, SF).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
