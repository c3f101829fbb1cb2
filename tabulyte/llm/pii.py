"""Personal data: fixed patterns, and a skip-chain conditional random field.

The field labels the tokens of a text that hold a digit or an @; all other tokens are
certain to be outside.  Neighbouring tokens share a potential, and so do distant tokens
of the same form (same digits, or same letters whatever their case and punctuation).
A form that occurs more than twice has a node of its own, a star to which all its tokens
are tied, so any two are two steps apart.  Loopy message passing over all edges, until the
messages of a document rest, makes labels of one entity agree across the document.  Weights are trained here, piecewise, on a bounded hash sample of
documents that the fixed patterns label."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabulyte.llm.decontaminate import merged

KINDS = ("email", "ip", "card", "phone")
#: Documents and tokens of each that the training sample holds at most.
SAMPLE_DOCS = 2_000
SAMPLE_TOKENS = 64
#: Messages rest when none changes by more; a document whose messages never do stops at `ROUNDS`.
AT_REST = 1e-8
ROUNDS = 1_000
CONFIDENT = 0.9

# The patterns, parted so that each runs in linear time.
_AT_RUN = re.compile(r"[A-Za-z0-9._%+@-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = ".,;:!?\"'[]{}<>|*#$%&"

Span = tuple[int, int, int]


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    for run in _AT_RUN.finditer(text):
        if "@" in run[0]:
            local = at = run.start()
            pieces = run[0].split("@")
            for i in range(1, len(pieces)):
                at += len(pieces[i - 1]) + 1  # first character after this @
                found = _DOMAIN.match(pieces[i])
                if found and at - 1 > local:
                    yield 0, local, at + found.end()
                    local = at + found.end()
                else:
                    local = at


def _at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """(kind number, start, end) of the fixed patterns, by kind, then start."""
    if not _TRIGGER.search(text):
        return []
    spans = list(_emails(text)) if "@" in text else []
    spans += [(1, *m.span()) for m in _IP.finditer(text) if all(_at_most_255(p) for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, *m.span()))
    spans += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return spans


_FEATURES = 40


def _features(token: str) -> list[int]:
    """Numbers of the features that a token has; 0 is always there."""
    core = token.strip(_EDGE)
    digits = _digits(core)
    n = len(digits)
    dots = core.count(".")
    on = [0, 1 + min(n, 20) // 2 if n else 12, 13 + min(dots, 4)]
    tests = (
        "@" in core, core.startswith("+"), "(" in core or ")" in core, "-" in core, ":" in core or "=" in core, "/" in core,
        n == len(core) > 0, any(c.isalpha() for c in core), 13 <= n <= 19 and luhn(digits), n >= 3 and dots == 3 and _IP.fullmatch(core) is not None,
        bool(core) and _AT_RUN.fullmatch(core) is not None and "@" in core and "." in core.rsplit("@", 1)[-1], len(core) > 24,
        n == 3, n == 4, n == 7, n == 10, 13 <= n <= 19,
    )
    return on + [18 + i for i, x in enumerate(tests) if x]


def _form(token: str) -> str:
    """Tokens with the same form are linked over any distance."""
    digits = _digits(token)
    return digits if len(digits) >= 4 and "@" not in token else token.strip(_EDGE).lower()


@dataclass
class _Nodes:
    """Tokens with a digit or an @ of one text, and edges between their numbers."""

    spans: list[tuple[int, int]]
    features: list[list[int]]
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]  # each repeat with the one before it, for training
    star: list[list[int]]  # all tokens of each form with more than two

    @staticmethod
    def of(text: str) -> _Nodes:
        spans, features, chain, skip = [], [], [], []
        before, last, forms = False, {}, {}
        for m in _TOKEN.finditer(text):
            if not _TRIGGER.search(m[0]):
                before = False
                continue
            i = len(spans)
            spans.append(m.span())
            features.append(_features(m[0]))
            if before:
                chain.append((i - 1, i))
            form = _form(m[0])
            if form in last and last[form] != i - 1 * before:
                skip.append((last[form], i))  # each to the one before: linear in the repeats
            last[form] = i
            forms.setdefault(form, []).append(i)
            before = True
        return _Nodes(spans, features, chain, skip, [f for f in forms.values() if len(f) > 2])

    def linked(self) -> tuple[int, list[tuple[int, int]]]:
        """Number of tokens and stars, and edges between repeats: stars come after the tokens."""
        n = len(self.spans)
        starred = {i for form in self.star for i in form}
        edges = [(a, b) for a, b in self.skip if a not in starred]
        return n + len(self.star), edges + [(n + k, i) for k, form in enumerate(self.star) for i in form]

    def labels(self, base: list[Span], most: int) -> list[int]:
        """1 + the kind of the base span that a token overlaps, 0 outside, for the first tokens."""
        out = []
        for a, b in self.spans[:most]:
            out.append(next((k + 1 for k, s, e in base if s < b and a < e), 0))
        return out


@dataclass(frozen=True)
class Field:
    """Weights of features by label, of label pairs for the two kinds of edges, and of the
    labels of a star (equal ones if none)."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray
    star: np.ndarray | None = None


def _matrix(features: list[list[int]]) -> np.ndarray:
    x = np.zeros((len(features), _FEATURES))
    for i, on in enumerate(features):
        x[i, on] = 1.0
    return x


def _fit_unary(x: np.ndarray, y: np.ndarray, steps: int = 400, rate: float = 0.5, ridge: float = 1e-3) -> np.ndarray:
    """Multinomial logistic weights by gradient ascent with momentum."""
    w = np.zeros((_FEATURES, len(KINDS) + 1))
    speed = np.zeros_like(w)
    goal = np.eye(w.shape[1])[y]
    for _ in range(steps):
        score = x @ w
        p = np.exp(score - score.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        speed = 0.9 * speed + rate * (x.T @ (goal - p) / max(len(x), 1) - ridge * w)
        w = w + speed
    return w


def _association(pairs: list[tuple[int, int]], prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Log of how much likelier two labels stand on an edge than by chance, and log of how
    often a label does; the prior counts favour equal labels."""
    n = len(KINDS) + 1
    counts = np.full((n, n), 0.5) + prior * np.eye(n)
    for a, b in pairs:
        counts[a, b] += 1
        counts[b, a] += 1
    share = counts / counts.sum()
    return np.log(share / np.outer(share.sum(1), share.sum(0))), np.log(share.sum(1))


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_tokens: int = SAMPLE_TOKENS) -> Field:
    """Fit the field on at most `sample_docs` different texts with a trigger, first in hash
    order, and the first `sample_tokens` tokens of each.  Only their features and labels
    reach the driver."""
    texts = docs.filter(F.col("text").rlike("[0-9@]")).select("text", F.xxhash64("text").alias("h"))
    last = texts.select("h").distinct().orderBy("h").limit(sample_docs).agg(F.max("h")).first()[0]
    some = texts.filter(F.col("h") <= F.lit(last))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                nodes, m = _Nodes.of(text), sample_tokens
                pairs = lambda edges: [list(e) for e in edges if max(e) < m]
                rows.append((nodes.features[:m], nodes.labels(base_spans(text), m), pairs(nodes.chain), pairs(nodes.skip)))
            ints = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("h"), *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.list_(ints), ints, pa.list_(ints), pa.list_(ints))))],
                ["h", "x", "y", "chain", "skip"])

    rows = some.mapInArrow(label, "h long, x array<array<long>>, y array<long>, chain array<array<long>>, skip array<array<long>>").dropDuplicates(["h"]).collect()
    rows.sort(key=lambda r: r.h)
    x = _matrix([f for r in rows for f in r.x])
    y = np.array([k for r in rows for k in r.y], np.int64)
    edges = lambda name: [(r.y[a], r.y[b]) for r in rows for a, b in r[name]]
    return Field(_fit_unary(x, y), _association(edges("chain"), 1.0)[0], *_association(edges("skip"), 5.0))


def beliefs(field: Field, features: list[list[int]], chain: np.ndarray, skip: np.ndarray, rounds: int = ROUNDS, owner: np.ndarray | None = None) -> np.ndarray:
    """Label probabilities after damped sum-product messages on all edges, until those of a
    document rest, at most `rounds` times.  `owner` numbers the document of each node, so
    that what one needs does not depend on others; a node without features is a star."""
    unary = _matrix(features) @ field.unary
    if field.star is not None:
        unary[[i for i, on in enumerate(features) if not on]] = field.star
    owner = np.zeros(len(unary), np.int64) if owner is None else owner
    edges = np.concatenate([chain.reshape(-1, 2), skip.reshape(-1, 2)])
    n = len(edges)
    both = np.concatenate([edges, edges[:, ::-1]])
    kind = np.concatenate([np.arange(n) >= len(chain.reshape(-1, 2))] * 2).astype(np.int64)
    kind[n:] += 2
    potential = np.stack([field.chain, field.skip, field.chain.T, field.skip.T])
    back = np.concatenate([np.arange(n) + n, np.arange(n)])
    sent = np.zeros((2 * n, unary.shape[1]))
    total = unary.copy()
    live = np.arange(2 * n)  # messages of documents not at rest; both directions of an edge go together
    for _ in range(rounds):
        if not len(live):
            break
        source, target = both[live, 0], both[live, 1]
        wide = (total[source] - sent[back[live]])[:, :, None] + potential[kind[live]]
        top = wide.max(1, keepdims=True)
        new = (top + np.log(np.exp(wide - top).sum(1, keepdims=True)))[:, 0]
        new -= new.max(1, keepdims=True)
        moved = np.abs(new - sent[live]).max(1) > AT_REST
        sent[live] = 0.5 * sent[live] + 0.5 * new
        total[target] = unary[target]
        np.add.at(total, target, sent[live])
        if not moved.all():
            live = live[np.isin(owner[source], owner[source[moved]])]
    p = np.exp(total - total.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


#: Digits of one entity of a kind whose parts blanks may divide.
_MOST_DIGITS = {2: 19, 3: 15}


def _added(text: str, nodes: _Nodes, label: np.ndarray, base: list[Span]) -> list[Span]:
    """Runs of neighbouring tokens of one kind that touch no base span, without the
    punctuation around them.  A run of more digits than one entity has, and tokens of
    kinds without blanks, are entities of their own."""
    out = []
    joined = {b for _, b in nodes.chain}
    taken = merged((s, e) for _, s, e in base)
    ends = [e for _, e in taken]
    i = 0
    while i < len(label):
        j = i + 1
        while j < len(label) and j in joined and label[j] == label[i]:
            j += 1
        kind = int(label[i]) - 1
        runs = []
        if kind >= 0:
            whole = len(_digits(text[nodes.spans[i][0] : nodes.spans[j - 1][1]])) <= _MOST_DIGITS.get(kind, 0)
            runs = [(i, j)] if whole else [(k, k + 1) for k in range(i, j)]
        for first, end in runs:
            a, b = nodes.spans[first][0], nodes.spans[end - 1][1]
            piece = text[a:b]
            a += len(piece) - len(piece.lstrip(_EDGE))
            b -= len(piece) - len(piece.rstrip(_EDGE))
            after = bisect_right(ends, a)  # the first base span that ends after a
            if a < b and (after == len(taken) or taken[after][0] >= b):
                out.append((kind, a, b))
        i = j
    return out


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_DDL = "array<struct<kind: string, start: long, end: long>>"


def _marked(field: Field, texts: list[str]) -> tuple[list[list[Span]], list[list[Span]]]:
    base = [base_spans(t) for t in texts]
    nodes = [_Nodes.of(t) if _TRIGGER.search(t) else _Nodes([], [], [], [], []) for t in texts]
    linked = [n.linked() for n in nodes]
    edges = np.cumsum([0] + [size for size, _ in linked])
    if not edges[-1]:
        return base, base
    shift = lambda pairs: np.array([(a + o, b + o) for found, o in zip(pairs, edges) for a, b in found], np.int64).reshape(-1, 2)
    features = [f for n in nodes for f in n.features + [[]] * len(n.star)]
    owner = np.repeat(np.arange(len(nodes)), np.diff(edges))
    p = beliefs(field, features, shift([n.chain for n in nodes]), shift([pairs for _, pairs in linked]), owner=owner)
    label = np.where(p.max(1) >= CONFIDENT, p.argmax(1), 0)
    every = [sorted(b + _added(t, n, label[o : o + len(n.spans)], b)) for t, n, b, o in zip(texts, nodes, base, edges)]
    return base, every


def pii_spans(docs: DataFrame, field: Field | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, base and spans, arrays of kind, start, end in code
    points ordered by kind as listed, then start.  spans holds base and what the field adds.

    The field is trained on these documents if none is given.  A null or empty text has no
    spans, and so has one without digits and @.  Each row is judged by itself, so repeated
    rows agree.  Without any labelled token the field adds nothing.  Columns other than the
    id and the text are ignored."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    trained = field or train(docs)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = lambda rows: pa.array([[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in r] for r in rows], _SPAN)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                base, every = _marked(trained, [t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), listed(base), listed(every)], ["doc_id", "base", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(mark, f"doc_id {kind}, base {_DDL}, spans {_DDL}")
