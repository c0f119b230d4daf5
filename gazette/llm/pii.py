"""Personal data: fixed patterns, and a skip-chain conditional random field.

The patterns find the base spans. The field adds others: its nodes are the words
with a digit or an @, its labels the kinds of data or none; neighbouring nodes
are linked, and so are distant ones that repeat or resemble each other, so a
number that is clearly a phone number in one place carries its label to another
mention. Weights are learnt by pseudo-likelihood from texts into which the base
mentions are written again in forms that no pattern finds, beside strangers of
the same forms: there the links alone tell a mention from a stranger. Labels
follow from loopy message passing in which base spans are given.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone"]
FEATURES = 4096
#: Documents with candidates from which the weights are learnt, about.
SAMPLE_DOCUMENTS = 4000
#: Bytes of a text that is learnt from, at most; longer ones are only judged.
LEARNT_BYTES = 1 << 20
#: Times that a mention is written again in a text that is learnt from, and strangers beside.
AGAIN, STRANGERS = 4, 4
#: Characters of a mail's local part that may stand for it.
LOCAL_SIZE = 4
#: Penalties of squared weights: words beside a mention must not be learnt by heart.
WORD_PENALTY, LINK_PENALTY = 1e-3, 1e-5
#: Probability from which a node is added.
ADDED = 0.5
ROUNDS = 12
SPANS = "doc_id long, spans array<struct<kind:string,start:long,end:long,base:boolean>>"

_CANDIDATE = re.compile(r"[0-9@]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a match can only begin where a run of digits begins
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


# --- base spans ---


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield m.span()


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    doubled = [d * 2 - 9 * (d > 4) for d in values[1::2]]
    return (sum(values[::2]) + sum(doubled)) % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            yield m.span()


_FINDERS = [_emails, _ips, _cards, _phones]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind and start."""
    return [(k, a, b) for k, find in enumerate(_FINDERS) for a, b in find(text)]


# --- the graph of a text ---


@dataclass
class Graph:
    """Nodes with features, known labels (0: none) and links."""

    starts: list[int] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)
    labels: list[int] = field(default_factory=list)
    #: a label that the word's digits rule out, or -1
    barred: list[int] = field(default_factory=list)
    features: list[list[int]] = field(default_factory=list)
    chain: list[tuple[int, int]] = field(default_factory=list)
    skip: list[tuple[int, int]] = field(default_factory=list)


def _shape(word: str) -> str:
    out = []
    for c in word[:64]:
        kind = "9" if "0" <= c <= "9" else "a" if c.isalpha() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out[:16])


def _features(word: str, before: str, after: str) -> list[int]:
    digits = sum("0" <= c <= "9" for c in word)
    named = [
        "bias",
        f"shape {_shape(word)}",
        f"digits {min(digits, 20)}",
        f"size {min(len(word), 40)}",
        f"dots {min(word.count('.'), 5)}",
        f"first {word[0]}",
        f"last {word[-1]}",
        f"at {'@' in word} {word.count('-')}",
        f"before {before.lower()[:32]}",
        f"after {_shape(after)}",
        f"before shape {_shape(before)}",
    ]
    return [zlib.crc32(n.encode()) % FEATURES for n in named]


def _plain(word: str) -> str:
    return word.strip(".,;:!?()[]<>\"'").lower()


def _likeness(word: str) -> Iterator[tuple[str, str]]:
    """What a word shares with others that mean the same."""
    plain = _plain(word)
    if plain:
        yield "word", plain
    digits = _NOT_DIGIT.sub("", word)
    if len(digits) >= 6:
        yield "digits", digits
        yield "tail", digits[-6:]
    parts = [p for p in _NOT_DIGIT.split(word) if p]
    if len(parts) >= 3:
        yield "parts", ".".join(parts)
    local, at, _ = plain.partition("@")
    if at and local:
        yield "word", local


def _barred(word: str) -> int:
    """Numbers that look like a card or an address and fail its check are none."""
    digits = _NOT_DIGIT.sub("", word)
    if _IP.search(word) and not any(_ips(word)):
        return KINDS.index("ip") + 1
    if len(digits) >= 12 and not luhn(digits):
        return KINDS.index("card") + 1
    return -1


def graph_of(text: str, spans: list[tuple[int, int, int]]) -> Graph:
    graph, last = Graph(), {}
    words = [m.span() for m in _WORD.finditer(text)]
    mails = [text[a:b].partition("@")[0].lower() for k, a, b in spans if k == 0]
    locals_ = {m for m in mails if len(m) >= LOCAL_SIZE}
    given = sorted((a, b, k) for k, a, b in spans)
    at, previous = 0, -9
    for i, (start, end) in enumerate(words):
        word = text[start:end]
        if not _CANDIDATE.search(word) and not (locals_ and _plain(word) in locals_):
            continue
        while at < len(given) and given[at][1] <= start:
            at += 1
        node = len(graph.starts)
        inside = [k for a, b, k in given[at : at + 4] if a < end and b > start]
        before = text[slice(*words[i - 1])] if i else ""
        after = text[slice(*words[i + 1])] if i + 1 < len(words) else ""
        graph.starts.append(start)
        graph.ends.append(end)
        graph.labels.append(inside[0] + 1 if inside else 0)
        graph.barred.append(_barred(word))
        graph.features.append(_features(word, before, after))
        if node and i - previous <= 2:
            graph.chain.append((node - 1, node))
        previous = i
        linked = set()
        for key in _likeness(word):
            other = last.get(key)
            if other is not None and other not in linked:
                graph.skip.append((other, node))
                linked.add(other)
            last[key] = node
    return graph


def _other_forms(kind: int, mention: str) -> list[str]:
    """The mention as no pattern finds it."""
    if KINDS[kind] == "email":
        return [mention.partition("@")[0]]
    digits = _NOT_DIGIT.sub("", mention)
    if KINDS[kind] == "ip":
        parts = mention.split(".")
        return ["-".join(parts), "[.]".join(parts)]
    if KINDS[kind] == "card":
        fours = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return [".".join(fours), "/".join(fours)]
    dashed = re.sub(r"[\x20().-]+", "-", mention).strip("+-")
    national = re.sub(r"^\+[0-9]{1,3}[\x20().-]+", "", mention)
    short = dashed.partition("-")[2]
    forms = [mention.replace("+", ""), national, dashed, short, short.replace("-", ""), digits]
    # a form that has lost most digits would not be known again
    return [f for f in forms if sum(c.isdigit() for c in f) >= 7] or [digits]


def _stranger(rng: random.Random, mention: str) -> str:
    """Another mention of the same form."""
    mixed = [rng.choice("0123456789") if "0" <= c <= "9" else c for c in mention]
    if not any("0" <= c <= "9" for c in mention):
        rng.shuffle(mixed)
    return "".join(mixed)


def taught(text: str, base: list[tuple[int, int, int]]) -> tuple[Graph, list[bool]]:
    """A graph to learn from, and which of its labels are known.

    The base mentions are written again elsewhere, in other forms and with their
    label, beside strangers without one. What else resembles a mention is left
    open. The same text gives the same graph.
    """
    rng = random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    more = []
    for kind, a, b in base:
        forms = _other_forms(kind, text[a:b])
        more += [(rng.choice(forms), kind) for _ in range(AGAIN)]
        more += [(_stranger(rng, rng.choice(forms)), -1) for _ in range(STRANGERS)]
    rng.shuffle(more)
    gaps = [m.end() for m in _WORD.finditer(text)]
    places = [g for g in gaps if not any(a < g < b for _, a, b in base)] or [len(text)]
    new = sorted((rng.choice(places), i) for i in range(len(more)))
    pieces, done, size, spans, strangers = [], 0, 0, [], []
    shift = [(place, len(more[i][0]) + 1) for place, i in new]
    for place, i in new:
        mention, kind = more[i]
        pieces += [text[done:place], " ", mention]
        size += place - done + 1
        (spans if kind >= 0 else strangers).append((kind, size, size + len(mention)))
        size, done = size + len(mention), place
    pieces.append(text[done:])
    moved = [(k, *(x + sum(n for p, n in shift if p <= a) for x in (a, b))) for k, a, b in base]
    graph = graph_of("".join(pieces), moved + spans)
    known = [True] * len(graph.labels)
    apart = {a for _, a, _ in strangers}
    for one, other in graph.skip:
        for near, far in ((one, other), (other, one)):
            if graph.labels[far] and not graph.labels[near] and graph.starts[near] not in apart:
                known[near] = False
    return graph, known


# --- weights and inference ---


@dataclass
class Weights:
    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def _softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(1, keepdims=True))
    return scores / scores.sum(1, keepdims=True)


def learn(
    features: np.ndarray,
    labels: np.ndarray,
    chain: np.ndarray,
    skip: np.ndarray,
    known: np.ndarray | None = None,
) -> Weights:
    """Pseudo-likelihood: each known node given its features and its neighbours' labels."""
    k = len(KINDS) + 1
    weights = [np.zeros((FEATURES, k)), np.zeros((k, k)), np.zeros((k, k))]
    if len(labels):
        truth = np.eye(k)[labels]
        around = []
        for links in (chain, skip):
            near = np.zeros((len(labels), k))
            np.add.at(near, links[:, 0], truth[links[:, 1]])
            np.add.at(near, links[:, 1], truth[links[:, 0]])
            around.append(near)
        moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
        for step in range(1, 201):
            scores = weights[0][features].sum(1) + around[0] @ weights[1] + around[1] @ weights[2]
            error = (_softmax(scores) - truth) / len(labels)
            if known is not None:
                error[~known] = 0
            slope = np.zeros_like(weights[0])
            np.add.at(slope, features.ravel(), np.repeat(error, features.shape[1], 0))
            slopes = [slope, around[0].T @ error, around[1].T @ error]
            for i, g in enumerate(slopes):
                g = g + (LINK_PENALTY if i else WORD_PENALTY) * weights[i]
                if i:  # links have no direction
                    g = (g + g.T) / 2
                first, second = moments[i]
                first += 0.1 * (g - first)
                second += 0.01 * (g * g - second)
                rate = 0.1 / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
                weights[i] -= rate * first / (1 - 0.9**step)
    return Weights(*weights)


def marginals(weights: Weights, graph: Graph) -> np.ndarray:
    """Probabilities of the labels of each node by loopy message passing."""
    k = len(KINDS) + 1
    labels = np.array(graph.labels)
    own = weights.unary[np.array(graph.features)].sum(1)
    barred = np.array(graph.barred)
    own[barred > 0, barred[barred > 0]] = -50.0
    given = labels > 0
    own[given] = -50.0
    own[given, labels[given]] = 0.0
    links = np.array(graph.chain + graph.skip, np.int64).reshape(-1, 2)
    if not len(links):
        return _softmax(own)
    potential = np.where(
        (np.arange(len(links)) < len(graph.chain))[:, None, None],
        np.exp(np.clip(weights.chain, -20, 20)),
        np.exp(np.clip(weights.skip, -20, 20)),
    )
    source, target = links.T.ravel(), links[:, ::-1].T.ravel()
    potential = np.concatenate([potential, potential])
    back = np.roll(np.arange(len(source)), len(links))
    message = np.full((len(source), k), -np.log(k))
    for _ in range(ROUNDS):
        total = own.copy()
        np.add.at(total, target, message)
        sent = _softmax(total[source] - message[back])
        new = np.log(np.maximum(np.einsum("ei,eij->ej", sent, potential), 1e-30))
        new -= np.log(np.exp(new).sum(1, keepdims=True))
        message = (message + new) / 2
    np.add.at(own, target, message)
    return _softmax(own)


def added_spans(text: str, weights: Weights, base: list[tuple[int, int, int]]):
    """Spans of nodes that the field labels, outside the base spans."""
    graph = graph_of(text, base)
    # without a known mention or a doubtful node there is nothing to pass on
    if not any(graph.labels) or all(graph.labels):
        return []
    chances = marginals(weights, graph)
    found: list[list[int]] = []
    for i, known in enumerate(graph.labels):
        label = int(chances[i].argmax())
        if known or not label or chances[i, label] < ADDED:
            continue
        start, end = graph.starts[i], graph.ends[i]
        while start < end and not (text[start].isalnum() or text[start] in "+("):
            start += 1
        while end > start and not text[end - 1].isalnum():
            end -= 1
        if start == end:
            continue
        gap = text[found[-1][2] : start] if found else ""
        if found and found[-1][0] == label - 1 and not gap.strip(" \t\r\n().-"):
            found[-1][2] = end
        else:
            found.append([label - 1, start, end])
    return [tuple(f) for f in found]


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]


LEARNT = "at long, features array<int>, labels array<int>, known array<boolean>, chain array<int>, skip array<int>"


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The graphs of the texts as one row each, for learning."""
    ints = pa.list_(pa.int32())
    for batch in batches:
        both = [taught(t, base_spans(t)) for t in _texts(batch)]
        graphs = [g for g, _ in both]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(batch.schema.get_field_index("at")),
                pa.array([np.ravel(g.features).astype(int) for g in graphs], ints),
                pa.array([g.labels for g in graphs], ints),
                pa.array([known for _, known in both], pa.list_(pa.bool_())),
                pa.array([np.ravel(g.chain).astype(int) for g in graphs], ints),
                pa.array([np.ravel(g.skip).astype(int) for g in graphs], ints),
            ],
            ["at", "features", "labels", "known", "chain", "skip"],
        )


def fit(docs: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> Weights:
    """Weights from about `sample` documents (doc_id, text) with candidates, by a hash."""
    some = docs.where(F.col("text").rlike("[0-9@]") & (F.octet_length("text") <= LEARNT_BYTES))
    some = some.select("text", F.xxhash64("doc_id", "text").alias("at"))
    count = some.count()
    if count > sample:
        share = int(1_000_000 * sample / count)
        some = some.where(F.pmod("at", F.lit(1_000_000)) < share).limit(2 * sample)
    rows = some.mapInArrow(_nodes, LEARNT).toArrow().sort_by("at")
    sizes = [len(x) for x in rows["labels"]]
    before = np.concatenate(([0], np.cumsum(sizes)))[: len(sizes)]

    def flat(name: str) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.int64), *(np.array(x.as_py()) for x in rows[name])])

    def links(name: str) -> np.ndarray:
        counts = [len(x) for x in rows[name]]
        return (flat(name) + np.repeat(before, counts)).astype(np.int64).reshape(-1, 2)

    labels = flat("labels").astype(np.int64)
    names = len(_features("0", "", ""))
    features = flat("features").astype(np.int64).reshape(-1, names)
    return learn(features, labels, links("chain"), links("skip"), flat("known").astype(bool))


def personal_data(docs: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """The spans of personal data in each document (doc_id, text).

    Returns doc_id and spans: kind, start and end in code points (end exclusive)
    and base (found by a pattern, else added by the field), base spans by kind and
    start first. Texts over LEARNT_BYTES are judged but not learnt from. A null or empty text has no spans. Added spans do not overlap base
    ones; they stand only in texts with a base span. Repeated rows are treated alike. Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    weights = fit(docs, sample)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in _texts(batch):
                base = base_spans(text) if _CANDIDATE.search(text) else []
                more = added_spans(text, weights, base) if _CANDIDATE.search(text) else []
                rows.append(
                    [
                        {"kind": KINDS[k], "start": a, "end": b, "base": known}
                        for known, spans in ((True, base), (False, more))
                        for k, a, b in spans
                    ]
                )
            kind = pa.struct(
                [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.list_(kind))], ["doc_id", "spans"]
            )

    return docs.mapInArrow(find, SPANS)
