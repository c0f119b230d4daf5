"""Suffix-array dedup: removal of bytes in strings that an earlier document holds.

Sampled suffixes: each window of `width` bytes is represented by the smallest
hashed gram in it, its anchor, and consecutive windows with one anchor form a
cell. Equal windows have equal anchors, so only cells whose anchor occurs again
can hold a repeat. Where all cells of an anchor are equal as wholes, the first
document keeps its cell and the others lose theirs. The other cells, those at
the edges of repeated passages, send their bytes to buckets, which sort the
suffixes by merging: prefix hashes and binary search give the common extension
of two suffixes, and neighbours that agree in `width` bytes are compared byte by
byte.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm import chunks as C
from gazette.llm.hashing import BASE, PrefixHash, blocks, covered, mix, runs

REMOVED = "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary"
#: Cells of one anchor that one task sorts; more are dealt by the hash of their windows.
SORTED_TOGETHER = 1024
_OTHER_BASE = 0xD6E8FEB86659FD93


# --- the suffix sort ---


class Suffixes:
    """Suffixes of a text, compared in their first `width` bytes."""

    def __init__(self, text: np.ndarray, starts: np.ndarray, width: int):
        self.text, self.starts, self.width = text, starts, width
        self.prefix = PrefixHash(text, _OTHER_BASE)
        self.whole = self.prefix.ranges(starts, starts + width)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of pairs of suffixes, `width` at most."""
        out = np.full(len(a), self.width)
        # most pairs agree as wholes; the others are halved
        some = np.flatnonzero(self.whole[a] != self.whole[b])
        p, q = self.starts[a[some]], self.starts[b[some]]
        low, high = np.zeros(len(p), np.int64), np.full(len(p), self.width - 1)
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.prefix.ranges(p, p + middle) == self.prefix.ranges(q, q + middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        out[some] = low
        return out

    def before(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        length = self.common(a, b)
        whole = length == self.width
        step = np.minimum(length, self.width - 1)
        less = self.text[self.starts[a] + step] < self.text[self.starts[b] + step]
        return np.where(whole, or_equal, less)

    def sort(self, group: np.ndarray) -> np.ndarray:
        """Merge sort within the groups (given in ascending runs); the sorted order."""
        n = len(group)
        order = np.arange(n)
        first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))[:n]
        sizes = np.diff(np.append(first, n))
        begin, end = np.repeat(first, sizes), np.repeat(first + sizes, sizes)
        length, largest = 1, int(sizes.max(initial=0))
        while length < largest:
            at = np.flatnonzero(end - begin > length)
            run = (at - begin[at]) // length
            own = begin[at] + run * length
            other = begin[at] + (run ^ 1) * length
            paired = other < end[at]
            at, run, own, other = at[paired], run[paired], own[paired], other[paired]
            limit = np.minimum(other + length, end[at])
            low, high = other.copy(), limit.copy()
            right = (run & 1).astype(bool)
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) // 2
                passed = self.before(order[middle], order[at[open_]], right[open_])
                low[open_] = np.where(passed, middle + 1, low[open_])
                high[open_] = np.where(passed, high[open_], middle)
            target = np.minimum(own, other) + (at - own) + (low - other)
            moved = order.copy()
            moved[target] = order[at]
            order = moved
            length *= 2
        return order

    def verified(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pairs of suffixes agree in all `width` bytes."""
        out = np.zeros(len(a), bool)
        step = np.arange(self.width)
        for i in range(0, len(a), 1 << 16):
            p, q = self.starts[a[i : i + (1 << 16)]], self.starts[b[i : i + (1 << 16)]]
            out[i : i + (1 << 16)] = (self.text[p[:, None] + step] == self.text[q[:, None] + step]).all(1)
        return out


def repeated_windows(group, rank, masks, anchor, sizes, text, width: int) -> np.ndarray:
    """For each context, the windows that a context of lower rank in its group has too.

    Contexts are byte strings of the given sizes, end to end in `text`; bit i of a
    mask stands for the window that begins at byte i. Equal windows have their
    anchor at the same place, so only those are sorted together.
    """
    out = np.zeros(len(group), np.uint32)
    if not len(group):
        return out
    begin = np.cumsum(sizes) - sizes
    places = [np.flatnonzero(masks >> np.uint32(i) & np.uint32(1)) for i in range(32)]
    owner = np.concatenate(places)
    shift = np.repeat(np.arange(32), [len(p) for p in places])
    place = anchor[owner].astype(np.int64) - shift
    # windows whose hash no context of another rank has cannot repeat and need no sorting
    some = _in_several(PrefixHash(text, _OTHER_BASE), begin[owner] + shift, rank[owner], width)
    owner, shift, place = owner[some], shift[some], place[some]
    if not len(owner):
        return out
    by_group = np.lexsort((place, group[owner]))
    owner, shift, place = owner[by_group], shift[by_group], place[by_group]
    new = np.ones(len(owner), bool)
    new[1:] = (group[owner[1:]] != group[owner[:-1]]) | (place[1:] != place[:-1])
    together = np.cumsum(new)
    suffixes = Suffixes(text, begin[owner] + shift, width)
    order = suffixes.sort(together)
    a, b = order[:-1], order[1:]
    same = together[a] == together[b]
    near = np.flatnonzero(same)
    same[near] = suffixes.common(a[near], b[near]) == width
    near = np.flatnonzero(same)
    same[near] = suffixes.verified(a[near], b[near])
    first = np.flatnonzero(np.concatenate(([True], ~same)))
    ranks = rank[owner[order]]
    least = np.repeat(np.minimum.reduceat(ranks, first), np.diff(np.append(first, len(order))))
    found = order[ranks > least]
    np.bitwise_or.at(out, owner[found], np.uint32(1) << shift[found].astype(np.uint32))
    return out


def _in_several(prefix: PrefixHash, starts: np.ndarray, rank: np.ndarray, width: int) -> np.ndarray:
    """The windows whose hash occurs with more than one rank."""
    whole = prefix.ranges(starts, starts + width)
    order = np.argsort(whole)
    ranked = whole[order]
    first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))[: len(order)]
    if not len(first):
        return order
    ranks = rank[order]
    apart = np.minimum.reduceat(ranks, first) < np.maximum.reduceat(ranks, first)
    return order[np.repeat(apart, np.diff(np.append(first, len(order))))]


# --- anchors and cells ---


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every `span` neighbours."""
    reach = 1
    while 2 * reach <= span:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = span - reach
    return np.minimum(values[:-rest], values[rest:]) if rest else values


class Cells:
    """The cells of a chunk: anchor hash, first and last window, text number."""

    def __init__(self, texts: C.Texts, width: int):
        gram = max(width // 2 + 1, width - 31)
        found = []
        for first, last in blocks(texts.offsets):
            borders = texts.offsets[first : last + 1]
            body = texts.body[borders[0] : borders[-1]]
            if len(body) < width:
                continue
            grams = PrefixHash(body).windows(gram)
            marked = (grams >> np.uint64(32) << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64)
            anchor = (_least(marked, width - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            sizes = np.diff(borders)
            ends = np.repeat(borders[1:] - borders[0], sizes)[: len(anchor)]
            windows = np.flatnonzero(np.arange(len(anchor)) + width <= ends)
            if not len(windows):
                continue
            anchor = anchor[windows]
            new = np.concatenate(([True], anchor[1:] != anchor[:-1]))
            at = np.flatnonzero(new)
            low = windows[at]
            high = windows[np.append(at[1:], len(windows)) - 1]
            number = np.searchsorted(borders, low + borders[0], side="right") - 1 + first
            place = (anchor[at] - low).astype(np.uint8)
            found.append((grams[anchor[at]], low + borders[0], high + borders[0], number, place))
        columns = zip(*found, strict=True) if found else [np.zeros(0, np.int64)] * 5
        key, self.low, self.high, self.number, self.anchor = (
            np.concatenate(c) if found else c for c in columns
        )
        self.key, self.width = key.astype(np.uint64), width
        self.keys, self.place = np.unique(self.key, return_inverse=True)

    def wholes(self, texts: C.Texts, which: np.ndarray) -> np.ndarray:
        """Hashes of all bytes of the cells, independent of the anchors' hashes."""
        out = np.zeros(len(which), np.uint64)
        low, high = self.low[which], self.high[which] + self.width
        for first, last in blocks(texts.offsets):
            begin, end = texts.offsets[first], texts.offsets[last]
            here = slice(*np.searchsorted(low, (begin, end)))
            if here.start == here.stop:
                continue
            prefix = PrefixHash(texts.body[begin:end], _OTHER_BASE)
            sizes = (high[here] - low[here]).astype(np.uint64)
            out[here] = mix(prefix.ranges(low[here] - begin, high[here] - begin) + sizes)
        return out

    def contexts(self, texts: C.Texts, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and joined bytes of cells."""
        sizes = self.high[which] + self.width - self.low[which]
        begin = np.cumsum(sizes) - sizes
        step = np.arange(int(sizes.sum())) - np.repeat(begin - self.low[which], sizes)
        return sizes, texts.body[step]

    def masks(self, which: np.ndarray) -> np.ndarray:
        count = (self.high[which] - self.low[which] + 1).astype(np.uint64)
        return ((np.uint64(1) << count) - np.uint64(1)).astype(np.uint32)


def _firsts(values: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row, the least value among the rows with its keys, and the group's number."""
    order = np.lexsort((values, *keys))
    change = np.zeros(len(order), bool)
    if len(order):
        change[0] = True
    for key in keys:
        change[1:] |= key[order][1:] != key[order][:-1]
    number = np.cumsum(change) - 1
    least, groups = np.empty(len(order), values.dtype), np.empty(len(order), np.int64)
    least[order] = values[order][np.flatnonzero(change)][number] if len(order) else values
    groups[order] = number
    return least, groups


# --- rules of the buckets ---


def _neighbours(keys: np.ndarray, sender: np.ndarray) -> np.ndarray:
    """1: an earlier chunk has the key, 2: a later one."""
    out = np.full(len(keys), 3, np.uint8)
    if len(keys):
        order, first = C.grouped(keys)
        out[order[first]] &= 2
        out[order[np.append(first[1:], len(keys)) - 1]] &= 1
    return out


def _differing(keys, sender, low, high, count) -> np.ndarray:
    """The number of different cells of a key if there are several, else 0."""
    order, first = C.grouped(keys)
    if not len(keys):
        return np.zeros(0, np.uint32)
    sizes = np.diff(np.append(first, len(keys)))
    least = np.minimum.reduceat(low[order], first)
    most = np.maximum.reduceat(high[order], first)
    total = np.add.reduceat(count[order].astype(np.uint64), first)
    value = np.where(least == most, 0, np.minimum(total, 2**32 - 1)).astype(np.uint32)
    out = np.empty(len(keys), np.uint32)
    out[order] = np.repeat(value, sizes)
    return out


def remove_repeats(docs: DataFrame, width: int = 50, **options) -> DataFrame:
    """What stays of each document (doc_id, text) without strings of smaller doc_ids.

    Removes each byte covered by a string of `width` bytes that also starts in a
    document with a smaller doc_id. Returns doc_id, n_bytes, removed (maximal runs
    of removed bytes, end exclusive) and kept (the other bytes; they may not be
    valid UTF-8). Rows with one doc_id take nothing from each other; a null doc_id
    counts as the smallest. A null or empty text has no bytes. Texts shorter than
    `width` stay whole. Other columns are not read. `width` is 16 at least.
    """
    dealt = C.Chunks(docs, ordered=True, **options)
    n = dealt.n

    def steps(replies: pa.Table, step: int) -> pa.Table:
        return replies.filter(pc.equal(replies["step"], step))

    def ask_anchors(chunk, texts):
        return C.questions(chunk, Cells(texts, width).keys, n)

    def shared(cells: Cells, replies: pa.Table) -> np.ndarray:
        """Cells whose anchor other chunks hold."""
        return np.flatnonzero(C.answers(steps(replies, 1), np.uint8)[cells.place])

    def ask_wholes(chunk, texts, replies):
        cells = Cells(texts, width)
        which = shared(cells, replies)
        keys, wholes = cells.key[which], cells.wholes(texts, which)
        order = np.lexsort((wholes, keys))
        keys, wholes = keys[order], wholes[order]
        fresh = np.ones(len(keys), bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (wholes[1:] != wholes[:-1])
        keys, wholes = keys[fresh], wholes[fresh]
        asked, first = np.unique(keys, return_index=True)
        count = np.diff(np.append(first, len(keys)))
        last = np.append(first[1:], len(keys))[: len(first)] - 1
        return C.questions(chunk, asked, n, wholes[first], wholes[last], count.astype(np.uint32))

    def edges(texts, cells: Cells, replies: pa.Table):
        """The cells of anchors with differing cells elsewhere, one of each kind, as sent."""
        which = shared(cells, replies)
        asked = np.unique(cells.key[which])
        found = C.answers(steps(replies, 2), np.uint32)
        number = np.searchsorted(asked, cells.key[which])
        differing = np.zeros(len(cells.key), np.uint32)
        differing[which] = found[number] if len(which) else 0
        which = np.flatnonzero(differing)
        kind = _firsts(which, cells.key[which], cells.wholes(texts, which))
        # the first cell of each kind stands for the others
        sent = np.unique(kind[0])
        parts = np.maximum(1, -(-differing[sent].astype(np.int64) // SORTED_TOGETHER))
        masks = cells.masks(sent)
        split = np.flatnonzero(parts > 1)
        whole = np.flatnonzero(parts == 1)
        rows = [(whole, np.zeros(len(whole), np.int64), masks[whole])]
        if len(split):
            rows.append(_dealt(texts, cells, sent, split, parts, width))
        row, part, mask = (np.concatenate(c) for c in zip(*rows, strict=True))
        group = mix(cells.key[sent[row]] + part.astype(np.uint64) * np.uint64(BASE))
        order = np.lexsort((part, row, group))
        return differing > 0, kind[0], which, sent[row[order]], group[order], mask[order]

    def ask_edges(chunk, texts, replies):
        cells = Cells(texts, width)
        *_, cell, group, mask = edges(texts, cells, replies)
        ends = np.searchsorted(C.spread(group, n), np.arange(n), side="right")
        bodies = []
        for a, b in zip(np.concatenate(([0], ends[:-1])), ends, strict=True):
            sizes, joined = cells.contexts(texts, cell[a:b])
            bodies.append(
                C.squeeze(group[a:b], mask[a:b], cells.anchor[cell[a:b]], sizes, joined)
            )
        return pa.table(
            {
                "bucket": pa.array(np.arange(n), pa.int32()),
                "chunk": pa.array(np.full(n, chunk), pa.int32()),
                "body": pa.array(bodies, pa.binary()),
            }
        )

    def sort_edges(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        chunks = table["chunk"].to_numpy()
        parts = [
            C.unsqueeze(b.as_py(), np.uint64, np.uint32, np.uint8, np.int64, np.uint8)
            for b in table["body"]
        ]
        group, mask, anchor, sizes, text = (np.concatenate(c) for c in zip(*parts, strict=True))
        counts = [len(p[0]) for p in parts]
        rank = np.repeat(chunks.astype(np.int64), counts)
        found = repeated_windows(group, rank, mask, anchor, sizes, text, width)
        ends = np.cumsum(counts)
        return pa.table(
            {
                "chunk": pa.array(chunks, pa.int32()),
                "bucket": pa.array(np.full(len(parts), key[0].as_py()), pa.int32()),
                "body": pa.array(
                    [C.squeeze(found[e - s : e]) for s, e in zip(counts, ends, strict=True)],
                    pa.binary(),
                ),
            }
        )

    def remove(chunk, texts, replies):
        cells = Cells(texts, width)
        earlier = (C.answers(steps(replies, 1), np.uint8) & 1)[cells.place].astype(bool)
        differs, kinds, which, cell, _, _ = edges(texts, cells, replies)
        found = np.zeros(len(cells.key), np.uint32)
        np.bitwise_or.at(found, cell, C.answers(steps(replies, 3), np.uint32))
        found[which] = found[kinds]
        every = cells.masks(np.arange(len(cells.key)))
        found[earlier & ~differs] = every[earlier & ~differs]
        found |= _within(texts, cells, width)
        starts = [cells.low[found >> np.uint32(i) & np.uint32(1) > 0] + i for i in range(32)]
        gone = covered(np.concatenate(starts), width, len(texts.body))
        removed, kept = [], []
        for a, b in zip(texts.offsets, texts.offsets[1:], strict=False):
            own = gone[a:b]
            begin, end = runs(own)
            removed.append([{"start": s, "end": e} for s, e in zip(begin, end, strict=True)])
            kept.append(texts.body[a:b][~own].tobytes())
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table(
            {
                "doc_id": C.as_ids(texts.ids),
                "n_bytes": pa.array(np.diff(texts.offsets), pa.int64()),
                "removed": pa.array(removed, span),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    def step(replies: DataFrame, number: int) -> DataFrame:
        return replies.withColumn("step", F.lit(number))

    one = step(C.answer(dealt.each(ask_anchors, C.MESSAGE), _neighbours), 1)
    wholes = dealt.each_with(one, ask_wholes, C.MESSAGE)
    two = one.unionByName(step(C.answer(wholes, _differing, np.uint64, np.uint64, np.uint32), 2))
    sent = dealt.each_with(two, ask_edges, C.MESSAGE)
    three = step(sent.groupBy("bucket").applyInArrow(sort_edges, C.REPLY), 3)
    return dealt.each_with(two.unionByName(three), remove, REMOVED)


def _dealt(texts, cells: Cells, sent, split, parts, width: int):
    """Rows (cell, part, windows) of cells whose windows are dealt by their hash."""
    which = sent[split]
    sizes, joined = cells.contexts(texts, which)
    begin = np.cumsum(sizes) - sizes
    count = sizes - width + 1
    row = np.repeat(np.arange(len(which)), count)
    shift = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    prefix = PrefixHash(joined)
    at = begin[row] + shift
    part = (mix(prefix.ranges(at, at + width)) % parts[split][row].astype(np.uint64)).astype(np.int64)
    order = np.lexsort((part, row))
    row, part, shift = row[order], part[order], shift[order]
    first = np.flatnonzero(
        np.concatenate(([True], (row[1:] != row[:-1]) | (part[1:] != part[:-1])))
    )
    mask = np.bitwise_or.reduceat(np.uint32(1) << shift.astype(np.uint32), first)
    return split[row[first]], part[first], mask


def _within(texts, cells: Cells, width: int) -> np.ndarray:
    """The windows of each cell that documents of the same chunk with smaller ids have."""
    out = np.zeros(len(cells.key), np.uint32)
    ids = texts.ids[cells.number]
    order = np.argsort(cells.place, kind="stable")
    first = np.flatnonzero(np.diff(cells.place[order], prepend=-1))
    if not len(first):
        return out
    least = np.minimum.reduceat(ids[order], first)
    most = np.maximum.reduceat(ids[order], first)
    which = np.flatnonzero((least < most)[cells.place])
    if not len(which):
        return out
    wholes = cells.wholes(texts, which)
    place = cells.place[which]
    _, kind = _firsts(ids[which], wholes, place)
    by_place = np.argsort(place, kind="stable")
    begin = np.flatnonzero(np.diff(place[by_place], prepend=-1))
    kinds = kind[by_place]
    several = np.zeros(len(which), bool)
    sizes = np.diff(np.append(begin, len(which)))
    differ = np.minimum.reduceat(kinds, begin) < np.maximum.reduceat(kinds, begin)
    several[by_place] = np.repeat(differ, sizes)
    earliest, _ = _firsts(ids[which], wholes, place)
    same = which[ids[which] > earliest]
    out[same] = cells.masks(same)
    # the first of each kind in groups of several kinds is sorted against the others
    stands = np.flatnonzero(several & (ids[which] == earliest))
    some = which[stands]
    sizes, joined = cells.contexts(texts, some)
    out[some] |= repeated_windows(
        cells.place[some], ids[some], cells.masks(some), cells.anchor[some], sizes, joined, width
    )
    return out
