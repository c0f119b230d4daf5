"""Substring dedup: removal of words in windows that occur more than once.

Every window of `width` words gets a Rabin-Karp hash; a chunk sums its own
windows and asks the buckets which hashes other chunks hold too. Windows that seem
to repeat are asked for once more by a second hash, of words hashed to another
base, and only those it confirms are removed. Repeated windows merge into maximal
intervals. All windows are counted, and they are
judged on the input: nothing depends on the order of removal.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gazette.llm import chunks as C
from gazette.llm.hashing import (
    SECOND_BASE, WORD_BASE, PrefixHash, Words, among, blocks, covered, distinct, inside,
    word_hashes,
)

SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
REPEATS = "doc_id long, n_words long, removed array<struct<start:long,end:long>>, kept string"


def windows(texts: C.Texts, width: int):
    """(first text, words, starts of the windows) of each block."""
    for first, last in blocks(texts.offsets):
        words = Words(texts.body, texts.offsets[first : last + 1])
        yield first, words, np.flatnonzero(inside(words.borders, width, len(words.starts)))


def window_hashes(words: Words, starts: np.ndarray, width: int, base: int) -> np.ndarray:
    return PrefixHash(words.hashes(base), base | 1).windows(width)[starts]


def some_window_hashes(words: Words, starts: np.ndarray, width: int, base: int) -> np.ndarray:
    """As window_hashes; words outside the windows are not hashed."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    used = covered(starts, width, len(words.starts))
    hashes = np.zeros(len(used), np.uint64)
    hashes[used] = word_hashes(words.body, words.starts[used], words.ends[used], base)
    return PrefixHash(hashes, base | 1).windows(width)[starts]


def joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *parts])


def spans_by_text(gone: np.ndarray, borders: np.ndarray) -> pa.Array:
    """The maximal runs of words that are gone, by number within each text."""
    opens = np.zeros(len(gone) + 1, bool)
    opens[borders] = True
    begins, ends = gone.copy(), gone.copy()
    begins[1:] &= ~gone[:-1] | opens[1:-1]
    ends[:-1] &= ~gone[1:] | opens[1:-1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    base = borders[np.searchsorted(borders, begin, side="right") - 1]
    places = [pa.array(begin - base, pa.int64()), pa.array(end - base, pa.int64())]
    return pa.ListArray.from_arrays(
        pa.array(np.searchsorted(begin, borders), pa.int32()),
        pa.StructArray.from_arrays(places, ["start", "end"]),
    )


def kept_words(words: Words, gone: np.ndarray) -> pa.Array:
    """The other words of each text, joined by one space."""
    kept = np.flatnonzero(~gone)
    ahead = np.searchsorted(kept, words.borders)
    spaced = np.ones(len(kept), np.int64)
    spaced[ahead[1:][ahead[1:] > ahead[:-1]] - 1] = 0  # nothing follows a text's last word
    starts, ends = words.starts[kept], words.ends[kept] + spaced
    steps = np.zeros(len(words.body) + 1, np.int8)
    steps[starts] += 1
    steps[ends] -= 1
    body = words.body[np.cumsum(steps[:-1], dtype=np.int8).view(bool)]
    places = np.concatenate(([0], np.cumsum(ends - starts)))
    body[places[1:][spaced > 0] - 1] = ord(" ")
    offsets = places[ahead].astype(np.int32)
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(body))


def _in_several(keys: np.ndarray, sender: np.ndarray) -> np.ndarray:
    order, first = C.grouped(keys)
    sizes = np.diff(np.append(first, len(keys)))
    out = np.zeros(len(keys), bool)
    out[order] = np.repeat(sizes > 1, sizes)
    return out


def _confirmed(keys: np.ndarray, sender: np.ndarray, whole: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The second hashes that several chunks hold, or one more than once; 0 for others."""
    return np.where(_in_several(whole, sender) | many, whole, 0).astype(np.uint64)


def repeated_windows(docs: DataFrame, width: int = 35, **options) -> DataFrame:
    """What stays of each document (doc_id, text) without words in repeated windows.

    Returns doc_id, n_words, removed (maximal runs of removed words, by number,
    end exclusive) and kept (the other words, joined by one space). A window
    repeats if its words start at any other place, also in the same document or
    in another row with the same doc_id. A null or empty text has no words and
    an empty kept; a text of fewer than `width` words stays whole. Other columns
    are not read. Between chunks 48 bits and the bucket of a first hash are compared,
    then 64 bits of a second, independent one. Of a text of any length a block is
    hashed at a time.
    """
    dealt = C.Chunks(docs, **options)
    n = dealt.n

    def first_hashes(texts):
        return joined([window_hashes(w, s, width, WORD_BASE) for _, w, s in windows(texts, width)])

    def ask(chunk, texts):
        return C.questions(chunk, distinct(first_hashes(texts)), n)

    def ask_again(chunk, texts, replies):
        hashes = first_hashes(texts)
        keys, counts = np.unique(hashes, return_counts=True)
        seem = among(hashes, keys[(counts > 1) | C.answers(replies, bool)])
        other, at = [], 0
        for _, words, starts in windows(texts, width):
            own = starts[seem[at : at + len(starts)]]
            other.append(some_window_hashes(words, own, width, SECOND_BASE))
            at += len(starts)
        keys, counts = np.unique(joined(other), return_counts=True)
        return C.questions(chunk, keys, n, keys, counts > 1)

    def remove(chunk, texts, replies):
        again = distinct(C.answers(replies, np.uint64))
        again = again[again > 0]
        parts = [table(texts.ids[:0], [], pa.array([], SPANS), pa.array([], pa.string()))]
        for first, words, starts in windows(texts, width):
            own = window_hashes(words, starts, width, SECOND_BASE)
            gone = covered(starts[among(own, again)], width, len(words.starts))
            counts = np.diff(words.borders)
            ids = texts.ids[first : first + len(counts)]
            parts.append(table(ids, counts, spans_by_text(gone, words.borders), kept_words(words, gone)))
        return pa.concat_tables(parts)

    def table(ids, counts, removed, kept):
        return pa.table(
            {
                "doc_id": C.as_ids(ids),
                "n_words": pa.array(counts, pa.int64()),
                "removed": removed,
                "kept": kept,
            }
        )

    replies = C.answer(dealt.each(ask, C.MESSAGE), _in_several)
    asked = dealt.each_with(replies, ask_again, C.MESSAGE)
    replies = C.answer(asked, _confirmed, np.uint64, bool)
    return dealt.each_with(replies, remove, REPEATS)
