"""Benchmark decontamination: BM25 search of test items for every passage.

The items form an inverted index with block maxima. Each document is cut into
overlapping passages; a passage is the query. A score counts as a share of the
score that the item itself would reach, so one threshold holds for all items.
Passages whose upper bounds (of a term over all items, then over blocks of
items) stay below the threshold are dropped at once, the others run WAND in the
blocks that are left, which returns every entry above the threshold. An item is
indexed as a whole and by its question and its answer, so that a passage that holds
one of these is found however long the other is. Their word sequences are then
compared.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.chunks import as_ids, ids_of, string_parts
from gazette.llm.hashing import PrefixHash, Words, blocks
from gazette.session import shared_dir

K1, B = 1.2, 0.75
#: Share of an item's own score that a passage must reach to be looked at.
RETRIEVED = 0.5
#: Share of an item's word sequences that a passage must hold.
OVERLAP = 0.6
#: Share of the sequences of a question or an answer, and words that it must have.
PART_OVERLAP, PART_WORDS = 0.8, 12
GRAM = 5
PASSAGE_WORDS = 128
#: Blocks of items, each with one maximum for a term, at most.
BLOCKS = 128
#: Bytes of items that one index holds; more are searched in turns.
INDEX_BYTES = 8 << 20
HITS = (
    "doc_id long, item_id long, score double, overlap double, "
    "question_overlap double, answer_overlap double"
)


def question_and_answer(text: str) -> tuple[str, str]:
    """Up to the last question mark and the rest; without one, the last sentence is the answer."""
    cut = text.rfind("?") + 1
    if not cut:
        ends = [m.end() for m in re.finditer(r"[.!]\s+(?=\S)", text)]
        cut = ends[-1] if ends else len(text)
    return text[:cut], text[cut:]


def _words(text: str) -> np.ndarray:
    body = np.frombuffer(text.encode(), np.uint8)
    return Words(body, np.array([0, len(body)]), lower=True, plain=True).hashes()


def _grams(words: np.ndarray, size: int) -> np.ndarray:
    return np.unique(PrefixHash(words).windows(size)) if len(words) >= size else words[:0]


@dataclass
class Posting:
    """The items of a term in order, their weights, and the maximum of each block of items."""

    items: list[int]
    weights: list[float]
    block_max: dict[int, float] = field(default_factory=dict)


@dataclass
class Statistics:
    """Of all items: how many, their mean and largest number of words, items per term."""

    items: int
    mean: float
    longest: int
    terms: np.ndarray
    frequency: np.ndarray

    def frequencies(self, terms: np.ndarray) -> np.ndarray:
        return self.frequency[np.searchsorted(self.terms, terms)]


def _statistics(words: list[np.ndarray]) -> Statistics:
    lengths = [len(w) for w in words]
    every = np.concatenate([np.unique(w) for w in words]) if words else np.zeros(0, np.uint64)
    mean = float(np.mean(lengths)) if words else 1.0
    return Statistics(len(words), mean, max(lengths, default=0), *np.unique(every, return_counts=True))


class Index:
    """Inverted index of items and their parts; weights are shares of what retrieval takes.

    `known` are the statistics of all items, where these are some of them.
    """

    def __init__(
        self,
        ids: list[int | None],
        texts: list[str | None],
        retrieved: float = RETRIEVED,
        known: Statistics | None = None,
    ):
        parts = [question_and_answer(t or "") for t in texts]
        words = [_words(t or "") for t in texts]
        kept = [i for i, w in enumerate(words) if len(w)]
        self.ids = np.array([0 if ids[i] is None else ids[i] for i in kept], np.int64)
        self.no_id = np.array([ids[i] is None for i in kept], bool)
        self.words = [words[i] for i in kept]
        self.parts = [tuple(_words(p) for p in parts[i]) for i in kept]
        known = known or _statistics(self.words)
        # entries of the index: the items, then the parts that are long enough
        entries = list(enumerate(self.words))
        for i, own in enumerate(self.parts):
            entries += [(i, p) for p in own if PART_WORDS <= len(p) < len(self.words[i])]
        self.owner = [i for i, _ in entries]
        n = self.size = len(entries)
        counts = [np.unique(w, return_counts=True) for _, w in entries]
        lengths, mean = [len(w) for _, w in entries], known.mean
        every = np.concatenate([c[0] for c in counts]) if n else np.zeros(0, np.uint64)
        self.terms = np.unique(every)
        frequency = known.frequencies(self.terms)
        rarity = np.log(1 + (known.items - frequency + 0.5) / (frequency + 0.5))
        rows = []
        for i, (terms, tf) in enumerate(counts):
            at = np.searchsorted(self.terms, terms)
            weight = rarity[at] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[i] / mean))
            rows.append((at, np.full(len(at), i), weight / (retrieved * weight.sum())))
        term, item, weight = (
            (np.concatenate(c) for c in zip(*rows, strict=True)) if rows else [np.zeros(0)] * 3
        )
        order = np.lexsort((item, term))
        self.term, self.item, self.weight = term[order].astype(int), item[order], weight[order]
        self.first = np.searchsorted(self.term, np.arange(len(self.terms) + 1))
        self.largest = np.zeros(len(self.terms))
        np.maximum.at(self.largest, self.term, self.weight)
        # block maxima as rows (term, block, maximum)
        self.block_items = max(1, -(-n // BLOCKS))
        block = (self.item // self.block_items).astype(np.int64)
        new = np.ones(len(block), bool)
        new[1:] = (self.term[1:] != self.term[:-1]) | (block[1:] != block[:-1])
        at = np.flatnonzero(new)
        self.block, self.block_count = block[at], -(-n // self.block_items)
        self.block_max = np.maximum.reduceat(self.weight, at) if len(at) else self.weight
        self.block_first = np.searchsorted(self.term[at], np.arange(len(self.terms) + 1))
        self.longest = known.longest
        self.postings: dict[int, Posting] = {}

    def posting(self, term: int) -> Posting:
        if term not in self.postings:
            own = slice(self.first[term], self.first[term + 1])
            blocks = slice(self.block_first[term], self.block_first[term + 1])
            self.postings[term] = Posting(
                self.item[own].tolist(),
                self.weight[own].tolist(),
                dict(zip(self.block[blocks].tolist(), self.block_max[blocks].tolist(), strict=True)),
            )
        return self.postings[term]


def block_max_wand(
    index: Index, terms: list[int], blocks: list[int] | None = None
) -> list[tuple[int, float]]:
    """All entries whose weights for the distinct terms add up to 1, with their sums.

    `blocks` may name the only blocks that can hold such items.
    """
    found: list[tuple[int, float]] = []
    if blocks is None:
        blocks = list(range(index.block_count))
    for block in blocks:
        lists = [(index.posting(t), float(index.largest[t])) for t in terms]
        lists = [x for x in lists if block in x[0].block_max]
        if sum(p.block_max[block] for p, _ in lists) >= 1 - 1e-9:
            begin = block * index.block_items
            _wand(lists, begin, min(begin + index.block_items, index.size), block, found)
    return found


def _wand(lists, begin: int, end: int, block: int, found: list) -> None:
    """Adds the items from begin to end that reach 1."""
    at = [bisect_left(p.items, begin) for p, _ in lists]
    while True:
        heads = sorted(
            (p.items[k], i)
            for i, ((p, _), k) in enumerate(zip(lists, at, strict=True))
            if k < len(p.items) and p.items[k] < end
        )
        bound, pivot = 0.0, -1
        for rank, (_, i) in enumerate(heads):
            bound += lists[i][0].block_max[block]
            if bound >= 1 - 1e-9:
                pivot = rank
                break
        if pivot < 0:
            return
        item = heads[pivot][0]
        if heads[0][0] < item:
            # no item before the pivot can reach 1
            for head, i in heads[:pivot]:
                if head < item:
                    at[i] = bisect_left(lists[i][0].items, item, at[i])
            continue
        total = 0.0
        for head, i in heads:
            if head == item:
                total += lists[i][0].weights[at[i]]
                at[i] += 1
        if total >= 1 - 1e-9:
            found.append((item, total))


def _promising(index: Index, key: np.ndarray, term: np.ndarray, passages: int):
    """Passages, their terms, and the blocks whose maxima could reach the threshold.

    key: half passages of the terms; passage i holds halves i and i + 1.
    """
    sums = np.bincount(key, index.largest[term], passages + 1)
    coarse = sums[:-1] + sums[1:] >= 1 - 1e-6
    lower = np.flatnonzero(coarse[np.maximum(key - 1, 0)] & (key > 0))
    upper = np.flatnonzero(coarse[np.minimum(key, passages - 1)])
    size = len(index.terms)
    pairs = np.unique(
        np.concatenate([(key[lower] - 1) * size + term[lower], key[upper] * size + term[upper]])
    )
    passage, term = np.divmod(pairs, size)
    number = np.cumsum(coarse) - 1
    start, stop = index.block_first[term], index.block_first[term + 1]
    sizes = stop - start
    at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes - start, sizes)
    cell = np.repeat(number[passage], sizes) * index.block_count + index.block[at]
    bounds = np.bincount(cell, index.block_max[at], int(coarse.sum()) * index.block_count)
    own, block = np.divmod(np.flatnonzero(bounds >= 1 - 1e-6), index.block_count)
    found = np.flatnonzero(coarse)[own]
    for p in np.unique(found):
        edge = np.searchsorted(passage, (p, p + 1))
        yield int(p), term[edge[0] : edge[1]].tolist(), block[found == p].tolist()


def _pieces(offsets: np.ndarray):
    for first, last in blocks(offsets):
        yield first, offsets[first : last + 1]


def search(index: Index, body: np.ndarray, offsets: np.ndarray, overlap: float = OVERLAP):
    """(text number, item number, score, overlaps) of every item held by a text."""
    if not len(index.ids):
        return
    stride = max(PASSAGE_WORDS // 2, index.longest)
    for first, borders in _pieces(offsets):
        words = Words(body, borders, lower=True, plain=True)
        hashes = words.hashes()
        counts = np.diff(words.borders)
        text = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(hashes)) - words.borders[:-1][text]
        # halves of passages; one more for each text, so that passages do not cross texts
        halves = -(-counts // stride) + 1
        base = np.cumsum(halves) - halves
        half = base[text] + place // stride
        at = np.searchsorted(index.terms, hashes)
        at[at == len(index.terms)] = 0
        known = np.flatnonzero(index.terms[at] == hashes)
        pairs = np.unique(half[known] * len(index.terms) + at[known])
        key, term = np.divmod(pairs, len(index.terms))
        total = int(halves.sum())
        best: dict[tuple[int, int], tuple] = {}
        owner = np.repeat(np.arange(len(counts)), halves)
        for passage, terms, some in _promising(index, key, term, total):
            number = int(owner[passage])
            begin = words.borders[number] + (passage - base[number]) * stride
            own = hashes[begin : min(begin + 2 * stride, words.borders[number + 1])]
            scores: dict[int, float] = {}
            for entry, score in block_max_wand(index, terms, some):
                item = index.owner[entry]
                scores[item] = max(score, scores.get(item, 0.0))
            for item, score in scores.items():
                shares = _overlaps(index, item, own)
                if held(index, item, shares, overlap):
                    hit = (*shares, score)
                    best[number, item] = max(best.get((number, item), hit), hit)
        for (number, item), (*shares, score) in best.items():
            yield first + number, item, score, shares


def held(index: Index, item: int, shares: list[float], overlap: float) -> bool:
    """Whether a passage holds enough of the item, or of a question or answer that tells it."""
    parts = zip(index.parts[item], shares[1:], strict=True)
    return shares[0] >= overlap or any(
        len(words) >= PART_WORDS and share >= max(overlap, PART_OVERLAP) for words, share in parts
    )


def _overlaps(index: Index, item: int, passage: np.ndarray) -> list[float]:
    """Shares of the word sequences of item, question and answer that a passage holds."""
    size = min(GRAM, len(index.words[item]))
    held = _grams(passage, size)

    def share(words: np.ndarray) -> float:
        own = _grams(words, size)
        return float(np.isin(own, held).mean()) if len(own) else 0.0

    return [share(index.words[item]), *(share(p) for p in index.parts[item])]


def _terms_of(items: DataFrame) -> DataFrame:
    """The distinct terms of each item that has words: slice, term; and its words once (term null)."""

    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns, terms, sizes = [], [], []
            for turn, text in zip(batch["turn"].to_pylist(), batch["text"].to_pylist(), strict=True):
                words = _words(text or "")
                if len(words):
                    own = np.unique(words).view(np.int64).tolist()
                    turns += [turn] * (len(own) + 1)
                    terms += [None, *own]
                    sizes += [len(words)] + [0] * len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(turns, pa.int32()), pa.array(terms, pa.int64()), pa.array(sizes, pa.int64())],
                ["turn", "term", "words"],
            )

    return items.mapInArrow(act, "turn int, term long, words long")


def indexes(
    items: DataFrame, retrieved: float = RETRIEVED, index_bytes: int = INDEX_BYTES
) -> Iterator[Index]:
    """Indexes of all items (item_id, text), each of about index_bytes at most.

    All of them weigh terms by the statistics of all items, counted in Spark if
    there are several, so results do not depend on how many there are.
    """
    items = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    turns = max(1, math.ceil(size / index_bytes))
    dealt = items.withColumn("turn", F.pmod(F.xxhash64("item_id", "text"), F.lit(turns)).cast("int"))
    if turns > 1:
        shared_dir(items.sparkSession)
        found = _terms_of(dealt).checkpoint()
        lengths = found.where("term is null")
        count, mean, longest = lengths.agg(F.count("*"), F.avg("words"), F.max("words")).first()
        counted = found.where("term is not null").groupBy("term").count().checkpoint()
    for turn in range(turns):
        own, known = dealt.where(F.col("turn") == turn), None
        if turns > 1:
            here = found.where((F.col("turn") == turn) & F.col("term").isNotNull()).select("term")
            table = counted.join(here.distinct(), "term").toArrow()
            terms = table["term"].to_numpy().view(np.uint64)
            order = np.argsort(terms)
            frequency = table["count"].to_numpy()[order]
            known = Statistics(count, mean or 1.0, longest or 0, terms[order], frequency)
        table = own.orderBy("item_id", "text").toArrow()
        yield Index(table["item_id"].to_pylist(), table["text"].to_pylist(), retrieved, known)


def hits(
    docs: DataFrame, items: DataFrame, overlap: float = OVERLAP, index_bytes: int = INDEX_BYTES
) -> DataFrame:
    """The items (item_id, text) that documents (doc_id, text) hold.

    Returns doc_id, item_id, score (BM25 of the item or the part that comes nearest, 1
    at the threshold of retrieval), overlap (share of the item's five-word sequences
    found in one passage), question_overlap and answer_overlap (of its parts). An item
    is held if overlap is at least `overlap`, or that of a question or an answer of
    PART_WORDS words at least PART_OVERLAP; a share that is equal counts. Words are
    letters and digits, A-Z in lower case; an item of fewer than five words is one
    sequence. Null or empty texts hold nothing, null or empty items are held by
    nothing. Repeated rows and items are reported each. Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = [docs.mapInArrow(_finder(index, overlap), HITS) for index in indexes(items, index_bytes=index_bytes)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _finder(index: Index, overlap: float):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = ids_of(batch.column(0))
            rows = list(search(index, *string_parts(batch.column(1)), overlap))
            item = np.array([r[1] for r in rows], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    as_ids(ids[np.array([r[0] for r in rows], np.int64)]),
                    pa.array(index.ids[item], pa.int64(), mask=index.no_id[item]),
                    pa.array([r[2] for r in rows], pa.float64()),
                    *(pa.array([r[3][i] for r in rows], pa.float64()) for i in range(3)),
                ],
                ["doc_id", "item_id", "score", "overlap", "question_overlap", "answer_overlap"],
            )

    return find


def without_items(docs: DataFrame, items: DataFrame, overlap: float = OVERLAP) -> DataFrame:
    """The rows of documents, all columns, that hold none of the items."""
    text = docs.columns.index("text")
    for index in indexes(items):

        def keep(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                parts = string_parts(batch.column(text).cast(pa.string()))
                clean = np.ones(len(batch), bool)
                for row, *_ in search(index, *parts, overlap):
                    clean[row] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
