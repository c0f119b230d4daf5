"""Katz backoff language model, counted and scored over all documents.

Chunks send each distinct n-gram of every order with its training count to the
buckets and get the count over all chunks back, together with the counts of
counts from which the Good-Turing discounts follow. One chunk is the owner of
each n-gram seen in training; the owners' shares of a history's probability mass
are summed in a second exchange, of all orders at once, which gives the exactly
normalised backoff weight. Only histories that texts outside training have, in
several chunks, need it. Such a token waits for its weights in a row that goes
along; all else of a text's score is known before.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gazette.llm import chunks as C
from gazette.llm.hashing import Words, blocks, mix
from gazette.session import shared_dir

SCORES = (
    "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)
#: Counts up to this one are discounted by Good-Turing; larger ones lose as much as it does.
GOOD_TURING = 5
_BEGIN, _END = np.uint64(0x1F83D9ABFB41BD6B), np.uint64(0x5BE0CD19137E2179)
_STEP = np.uint64(0x9FB21C651E98DF25)
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def discounts(counts_of_counts: np.ndarray) -> np.ndarray:
    """d[r]: the share of a count r that stays; the last is what each larger count loses.

    counts_of_counts[r - 1] types occur r times. Where Good-Turing gives no share
    between 0 and 1 (too few types), half a count is taken off.
    """
    k = len(counts_of_counts) - 1
    n = counts_of_counts.astype(float)
    out = np.ones(k + 2)
    tail = (k + 1) * n[k] / n[0] if n[0] else 1.0
    for r in range(1, k + 1):
        share = 0.0
        if n[r - 1] and tail < 1:
            share = ((r + 1) * n[r] / n[r - 1] / r - tail) / (1 - tail)
        out[r] = share if 0 < share < 1 else (r - 0.5) / r
    out[k + 1] = k * (1 - out[k])
    return out


def discounted(counts: np.ndarray, table: np.ndarray) -> np.ndarray:
    k = len(table) - 2
    return np.where(counts > k, counts - table[k + 1], counts * table[np.minimum(counts, k)])


class Grams:
    """The tokens of a chunk and the hashes of the n-grams that end at each."""

    def __init__(self, texts: C.Texts, order: int):
        tokens, counts = [], []
        for first, last in blocks(texts.offsets):
            words = Words(texts.body, texts.offsets[first : last + 1], lower=True)
            own = np.diff(words.borders)
            block = np.full(len(words.starts) + last - first, _END, np.uint64)
            block[np.arange(len(words.starts)) + np.repeat(np.arange(last - first), own)] = (
                words.hashes()
            )
            tokens.append(block)
            counts.append(own + 1)
        self.sizes = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        token = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
        self.borders = np.concatenate(([0], np.cumsum(self.sizes)))
        self.starts = self.borders[:-1]
        self.train = np.repeat(texts.marks, self.sizes)
        self.order = order
        #: by order: distinct hashes, place of each token's n-gram among them, one example each
        self.keys, self.place, self.example = [], [], []
        #: by order: the history that a text begins with
        self.begins = []
        begin, gram = _BEGIN, token
        for n in range(order):
            if n:
                history = np.empty_like(gram)
                history[1:] = gram[:-1]
                history[self.starts] = begin
                self.begins.append(begin)
                gram = mix(history * _STEP + token)
                begin = mix(np.array([begin]) * _STEP + _BEGIN)[0]
            by_key = np.argsort(gram)
            ranked = gram[by_key]
            new = np.concatenate(([True], ranked[1:] != ranked[:-1]))[: len(ranked)]
            place = np.empty(len(gram), np.int64)
            place[by_key] = np.cumsum(new) - 1
            self.keys.append(ranked[new])
            self.place.append(place)
            self.example.append(by_key[new])

    def train_counts(self, n: int) -> np.ndarray:
        size = len(self.keys[n])
        return np.bincount(self.place[n], self.train, size).astype(np.uint32)

    def histories(self, m: int) -> np.ndarray:
        """Place of each token's history among the keys of order m; behind them, the begin's."""
        out = np.empty(len(self.place[0]), np.int64)
        out[1:] = self.place[m - 1][:-1]
        out[self.starts] = len(self.keys[m - 1])
        return out

    def held_histories(self, m: int) -> np.ndarray:
        """The keys of order m that stand before a token which is not for training."""
        out = np.zeros(len(self.keys[m - 1]) + 1, bool)
        out[self.histories(m)[~self.train]] = True
        return out[:-1]


def _messages(chunk: int, bodies: list[bytes]) -> pa.Table:
    n = len(bodies)
    return pa.table(
        {
            "bucket": pa.array(np.arange(n), pa.int32()),
            "chunk": pa.array(np.full(n, chunk), pa.int32()),
            "body": pa.array(bodies, pa.binary()),
        }
    )


def _replies(chunks: list[int], bucket: int, bodies: list[bytes]) -> pa.Table:
    return pa.table(
        {
            "chunk": pa.array(chunks, pa.int32()),
            "bucket": pa.array(np.full(len(chunks), bucket), pa.int32()),
            "body": pa.array(bodies, pa.binary()),
        }
    )


def _by(table: pa.Table, name: str) -> list[tuple[int, bytes]]:
    return sorted(zip(table[name].to_pylist(), table["body"].to_pylist(), strict=True))


def ask_counts(chunk: int, grams: Grams, n: int) -> pa.Table:
    """Keys, training counts and use as held history, of all orders, a message to each bucket."""
    bodies: list[list[np.ndarray]] = [[] for _ in range(n)]
    for order in range(grams.order):
        keys, counts = grams.keys[order], grams.train_counts(order)
        held = grams.held_histories(order + 1) if order + 1 < grams.order else np.zeros(len(keys), bool)
        parts = zip(C.sorted_keys(keys, n), C.bucket_slices(keys, n), strict=True)
        for body, (short, own) in zip(bodies, parts, strict=True):
            body += [short, counts[own], held[own]]
    return _messages(chunk, [C.squeeze_places(*b) for b in bodies])


def _sole(own: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Entries that hold all of their key's training count."""
    return (own > 0) & (own == total)


def total_counts(keys: np.ndarray, counts: np.ndarray, held: np.ndarray, limit: int):
    """Total of each key, whether this entry is its owner, whether the key's shares
    must be exchanged, and statistics of the totals.

    Shares are exchanged for histories seen in training and used in held texts,
    unless one chunk has all of both and can sum them up alone.
    """
    order, first = C.grouped(keys)
    sizes = np.diff(np.append(first, len(keys)))
    total, owner = np.zeros(len(keys), np.uint32), np.zeros(len(keys), bool)
    wanted = np.zeros(len(keys), bool)
    stats = np.zeros(limit + 3, np.int64)
    if len(keys):
        sums = np.add.reduceat(counts[order].astype(np.uint64), first)
        total[order] = np.repeat(sums, sizes)
        trained = np.flatnonzero(counts[order])
        group = np.repeat(np.arange(len(first)), sizes)[trained]
        owner[order[trained[np.flatnonzero(np.diff(group, prepend=-1))]]] = True
        uses, here, both = (
            np.add.reduceat(x[order].astype(np.int64), first)
            for x in (held, counts > 0, held & (counts > 0))
        )
        alone = (uses == 1) & (here == 1) & (both == 1)
        wanted[order] = np.repeat((uses > 0) & (here > 0) & ~alone, sizes)
        stats[: limit + 1] = np.bincount(np.minimum(sums, limit + 2).astype(int), minlength=limit + 3)[
            1 : limit + 2
        ]
        stats[limit + 1], stats[limit + 2] = (sums > 0).sum(), sums.sum()
    return total, owner, wanted, stats


class Model:
    """What a chunk knows of the model: counts of its n-grams and global statistics."""

    def __init__(self, grams: Grams, replies: pa.Table, limit: int):
        order = grams.order
        kinds = [np.uint32, bool, bool, np.int64] * order
        parts = [C.unsqueeze_places(body, *kinds) for _, body in _by(replies, "bucket")]
        columns = list(zip(*parts, strict=True))
        self.grams, self.count, self.owner, self.wanted, stats = grams, [], [], [], []
        for m in range(order):
            others, owner, wanted, seen = columns[4 * m : 4 * m + 4]
            own = grams.train_counts(m)
            self.count.append((own + np.concatenate(others)).astype(np.int64))
            self.owner.append(np.concatenate(owner) ^ _sole(own, self.count[m]))
            self.wanted.append(np.concatenate(wanted))
            stats.append(np.sum(seen, axis=0))
        self.discounts = [discounts(s[: limit + 1]) for s in stats]
        self.types, self.tokens = int(stats[0][limit + 1]), int(stats[0][limit + 2])
        # what the discounts of single words leave goes to the unknown word
        left = float(np.dot(stats[0][:limit], np.arange(1, limit + 1) * (1 - self.discounts[0][1:-1])))
        left += float(self.types - stats[0][:limit].sum()) * self.discounts[0][-1]
        self.unknown = left / self.tokens if self.tokens else 1.0
        # a text begins as often as it ends
        token = grams.keys[0]
        at = int(np.searchsorted(token, _END))
        found = at < len(token) and token[at] == _END
        self.texts = int(self.count[0][at]) if found else 0

    def histories(self, m: int) -> np.ndarray:
        """How often the history of each token was seen, for order m + 1."""
        return np.append(self.count[m - 1], self.texts)[self.grams.histories(m)]

    def seen(self, m: int) -> np.ndarray:
        """Discounted probability of each token's n-gram, 0 where it was not seen."""
        counts = self.count[m][self.grams.place[m]]
        of = self.histories(m) if m else np.full(len(counts), self.tokens)
        return np.where(counts > 0, discounted(counts, self.discounts[m]) / np.maximum(of, 1), 0.0)


class Shares:
    """What a chunk gives to the backoff weights of order m + 1, and those it needs.

    An n-gram seen in training has its lower-order one seen there too, so its
    lower-order probability is known without any weight.
    """

    def __init__(self, model: Model, m: int, seen: list[np.ndarray], needed: np.ndarray):
        grams = model.grams
        self.place, self.needed = grams.histories(m), needed
        size = len(grams.keys[m - 1]) + 1
        owned = grams.example[m][model.owner[m]]
        self.seen, self.lower = (
            np.bincount(self.place[owned], x[owned], size) for x in (seen[m], seen[m - 1])
        )
        asked = np.zeros(size, bool)
        asked[self.place[needed]] = True
        far = np.append(model.wanted[m - 1], True)
        given = np.zeros(size, bool)
        given[self.place[owned]] = True
        rows = np.flatnonzero(far & (given | asked))
        keys = np.append(grams.keys[m - 1], grams.begins[m - 1])[rows]
        by_key = np.argsort(keys)
        self.rows, self.keys = rows[by_key], keys[by_key]
        self.given, self.asked = given[self.rows], asked[self.rows]
        self.far = far

    def known(self) -> tuple[np.ndarray, np.ndarray]:
        """Tokens whose weight this chunk has alone, and the weights."""
        at = self.needed[~self.far[self.place[self.needed]]]
        own = self.place[at]
        return at, (1 - self.seen[own]) / (1 - self.lower[own])

    def open(self) -> tuple[np.ndarray, np.ndarray]:
        """Tokens that wait for a weight, and its place among the weights asked for."""
        at = self.needed[self.far[self.place[self.needed]]]
        slot = np.zeros(len(self.far), np.int64)
        slot[self.rows[self.asked]] = np.arange(self.asked.sum())
        return at, slot[self.place[at]]

    def bodies(self, n: int) -> list[list[np.ndarray]]:
        out = []
        for short, own in zip(C.sorted_keys(self.keys, n), C.bucket_slices(self.keys, n), strict=True):
            given = self.rows[own][self.given[own]]
            out.append([short, self.given[own], self.seen[given], self.lower[given], self.asked[own]])
        return out


def weights(keys: np.ndarray, given: np.ndarray, seen: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """The backoff weight of each entry's history; seen, lower: of the entries with `given`."""
    out = np.zeros(len(keys))
    if len(keys):
        order, first = C.grouped(keys)
        sums = []
        for values in (seen, lower):
            whole = np.zeros(len(keys))
            whole[given] = values
            sums.append(1 - np.add.reduceat(whole[order], first))
        out[order] = np.repeat(sums[0] / sums[1], np.diff(np.append(first, len(keys))))
    return out


#: Columns of a chunk's documents while some of their weights are open.
_OPEN = [np.int64, bool, np.int64, np.int64, np.int64, float, float]


def katz_scores(docs: DataFrame, order: int = 2, good_turing: int = GOOD_TURING, **options) -> DataFrame:
    """Score documents (doc_id, text, train) by a model of those with train = true.

    Tokens are words between ASCII white space, A-Z in lower case, and one end per
    text. Returns doc_id, train, n_tokens, n_known (tokens seen in training),
    train_tokens, base_score (add-one unigrams, log10) and score (log10 probability
    under Katz backoff of the given order). The discounts leave mass to one unknown
    word, so the probabilities after every history sum to one. A null or empty text
    is its end alone. A null train counts as false. Without training rows every
    token is unknown: both scores are 0. Rows with one doc_id are separate texts.
    Other columns are not read.
    """
    dealt = C.Chunks(docs, mark="train", **options)
    n, limit = dealt.n, good_turing

    def ask(chunk, texts):
        return ask_counts(chunk, Grams(texts, order), n)

    def count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = _by(table, "chunk")
        parts = [C.unsqueeze_places(body, *[np.uint64, np.uint32, bool] * order) for _, body in rows]
        bodies: list[list[np.ndarray]] = [[] for _ in parts]
        for m in range(order):
            columns = list(zip(*[p[3 * m : 3 * m + 3] for p in parts], strict=True))
            counts = np.concatenate(columns[1])
            keys = np.concatenate([np.cumsum(short, dtype=np.uint64) for short in columns[0]])
            total, owner, wanted, stats = total_counts(keys, counts, np.concatenate(columns[2]), limit)
            others, owner = total - counts, owner ^ _sole(counts, total)
            ends = np.cumsum([len(k) for k in columns[0]])
            for body, own in zip(bodies, map(slice, [0, *ends[:-1]], ends), strict=True):
                body += [others[own], owner[own], wanted[own], stats]
        return _replies([c for c, _ in rows], key[0].as_py(), [C.squeeze_places(*b) for b in bodies])

    def share(chunk, texts, replies):
        """Shares for the buckets, and in a row of its own (no body there) what is open here."""
        grams = Grams(texts, order)
        model = Model(grams, replies, limit)
        seen = [model.seen(m) for m in range(order)]
        p = np.log10(np.where(seen[0] > 0, seen[0], model.unknown))
        needed: list[np.ndarray] = [np.zeros(0, np.int64)] * order
        unseen = np.ones(len(p), bool)
        for m in range(order - 1, 0, -1):
            unseen &= seen[m] == 0
            needed[m] = np.flatnonzero(unseen & (model.histories(m) > 0))
        document = np.repeat(np.arange(len(grams.sizes)), grams.sizes)
        bodies: list[list[np.ndarray]] = [[] for _ in range(n)]
        later = []
        for m in range(1, order):
            found = seen[m] > 0
            p[found] = np.log10(seen[m][found])
            shares = Shares(model, m, seen, needed[m])
            at, own = shares.known()
            p[at] += np.log10(own)
            at, slots = shares.open()
            later += [np.diff(document[at], prepend=0), slots]
            for body, part in zip(bodies, shares.bodies(n), strict=True):
                body += part
        counts = model.count[0][grams.place[0]]
        base = np.log10((counts + 1) / (model.tokens + model.types + 1))
        p, base, known = (np.add.reduceat(x, grams.starts) for x in (p, base, counts > 0))
        tokens = np.array([model.tokens])
        rows = [texts.ids, texts.marks, grams.sizes, known.astype(np.int64), tokens, base, p, *later]
        table = _messages(chunk, [C.squeeze_places(*b) for b in bodies])
        waits = pa.array([None] * n + [C.squeeze_places(*rows)], pa.binary())
        own = pa.table({"bucket": [chunk % n], "chunk": [chunk], "body": [None]}, schema=table.schema)
        return pa.concat_tables([table, own]).append_column("open", waits)

    def weigh(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """Weights for the chunks; rows that wait for weights go back as they came."""
        sent = table.filter(table["body"].is_valid())
        rows = _by(sent, "chunk")
        kinds = [np.uint64, bool, float, float, bool] * (order - 1)
        parts = [C.unsqueeze_places(body, *kinds) for _, body in rows]
        bodies: list[list[np.ndarray]] = [[] for _ in parts]
        for m in range(order - 1):
            columns = list(zip(*[p[5 * m : 5 * m + 5] for p in parts], strict=True))
            keys = [np.cumsum(short, dtype=np.uint64) for short in columns[0]]
            whole = weights(*(np.concatenate(c) for c in (keys, *columns[1:4])))
            ends = np.cumsum([len(k) for k in keys])
            for body, own, asked in zip(bodies, map(slice, [0, *ends[:-1]], ends), columns[4], strict=True):
                body.append(whole[own][asked])
        back = _replies([c for c, _ in rows], key[0].as_py(), [C.squeeze_places(*b) for b in bodies])
        back = back.append_column("open", pa.nulls(len(rows), pa.binary()))
        return pa.concat_tables([back, table.filter(table["body"].is_null()).select(back.column_names)])

    def score(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        waits = table.filter(table["open"].is_valid())["open"][0].as_py()
        kinds = [*_OPEN, *[np.int64, np.int64] * (order - 1)]
        ids, marks, sizes, known, tokens, base, p, *later = C.unsqueeze_places(waits, *kinds)
        parts = [
            C.unsqueeze_places(body, *[float] * (order - 1))
            for _, body in _by(table.filter(table["body"].is_valid()), "bucket")
        ]
        for m in range(order - 1):
            found = np.log10(np.concatenate([part[m] for part in parts]))
            p = p + np.bincount(np.cumsum(later[2 * m]), found[later[2 * m + 1]], len(p))
        return pa.table(
            {
                "doc_id": C.as_ids(ids),
                "train": pa.array(marks, pa.bool_()),
                "n_tokens": pa.array(sizes, pa.int64()),
                "n_known": pa.array(known, pa.int64()),
                "train_tokens": pa.array(np.repeat(tokens, len(ids)), pa.int64()),
                "base_score": pa.array(base, pa.float64()),
                "score": pa.array(p, pa.float64()),
            }
        )

    # the counts leave the exchange of all n-grams behind, whose files then go
    with _files_cleaned(docs.sparkSession):
        messages = dealt.each(ask, C.MESSAGE)
        replies = messages.groupBy("bucket").applyInArrow(count, C.REPLY).checkpoint()
    shares = dealt.each_with(replies, share, f"{C.MESSAGE}, open binary")
    answers = shares.groupBy("bucket").applyInArrow(weigh, f"{C.REPLY}, open binary")
    return answers.groupBy("chunk").applyInArrow(score, SCORES)


@contextmanager
def _files_cleaned(spark: SparkSession) -> Iterator[None]:
    """What is run within removes the files of its exchanges at its end."""
    shared_dir(spark)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
