"""Personal data by patterns and a skip-chain conditional random field.

Patterns find the sure mentions (``base_spans``). Other candidates are strings that look like part
of one: numbers of seven digits and more, dotted numbers, words with ``@``, and words that are the
local part of an address of the same document. Candidates and base spans are the nodes of a
document's graph; a node's label is one of ``KINDS`` or none, and base spans are observed. Neighbours
in the text share a chain edge; nodes that are equal or similar (same letters and digits, same last
seven digits, one a part of the other) share skip edges however far apart they are, so a mention that
no pattern fits takes the label of the one that a pattern found. Loopy sum-product message passing
gives each candidate's probability; those of at least ``SURE`` become spans.

A group of n similar nodes has about 2 n edges (each to the next, and to the group's first base
span). The weights are trained by pseudo-likelihood on a bounded sample (``SAMPLE_DOCS`` documents
of at most ``SAMPLE_NODES`` nodes, the smallest hashes): base spans with their labels, damaged copies
of them put into their own document with the same label, and the same copies put into another
document without one; so it is the skip edges, not shapes, that tell them apart.

Texts are read once: nodes are written as a table, training and inference read that.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored
from .words import slices, text_bytes

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
LABELS = len(KINDS) + 1
SAMPLE_DOCS, SAMPLE_NODES = 2000, 100
SURE = 0.5
ROUNDS, DAMPING = 12, 0.5
# Cells of a skip potential: one entity on both ends, two entities, an entity and none, none on both.
TIED = np.full((LABELS, LABELS), 1)
np.fill_diagonal(TIED, 0)
TIED[NONE, :] = TIED[:, NONE] = 2
TIED[NONE, NONE] = 3
NEAR = 40  # characters between neighbours with a chain edge
CHAIN, SAME, TAIL, PART = range(4)  # kinds of edges

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# what these leave can't start inside a run of digits, so matching starts once a run
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMBER = re.compile(r"[+(]?[0-9][ ().0-9-]*[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_OUTER = ".,;:!?()[]{}<>\"'"
_DIGITS = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, ``@``, dotted domain; each character is looked at once or twice."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        free = found.end() if found else at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, by kind and start: leftmost matches of each kind's pattern
    that pass its test (address parts up to 255; 16 to 19 digits with a right check digit; 8 to 15
    digits)."""
    out = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(len, _DIGITS.findall(m.group()))) <= 15:
                out.append((3, *m.span()))
    return out


def nodes(text: str) -> list[tuple[int, int, int]]:
    """Base spans, then the candidates that overlap none, as (label, start, end)."""
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    found: list[tuple[int, int]] = []
    for m in _NUMBER.finditer(text):
        s = m.group()
        if 7 <= sum(c.isdigit() for c in s) <= 24 or len(s) <= 24 and re.fullmatch(r"[0-9]+(?:\.[0-9]+){2,}", s):
            found.append(m.span())
    if "@" in text:
        local = {text[a:b].split("@")[0].lower() for k, a, b in base if k == 0}
        local = {s for s in local if len(s) >= 6 or len(s) >= 4 and not s.isalpha()}
        for m in _WORD.finditer(text):
            s = m.group()
            core = s.strip(_OUTER)
            if "@" in core or core.lower() in local:
                a = m.start() + len(s) - len(s.lstrip(_OUTER))
                found.append((a, a + len(core)))
    found.sort()
    free, i, out = 0, 0, []
    for a, b in found:
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        # the first span that ends behind ``a`` decides: if it starts behind ``b``, so do all others
        if a >= free and not (i < len(taken) and taken[i][0] < b):
            out.append((NONE, a, b))
            free = b
    return base + out


def shape(s: str) -> list[float]:
    """What a node's string looks like, without what only the patterns know."""
    digits = sum(c.isdigit() for c in s)
    dots = s.count(".")
    steps = (0, 6, 9, 11, 15, 19)
    size = sum(digits > x for x in steps)
    out = [1.0] + [float(size == i) for i in range(len(steps) + 1)] + [float(min(dots, 4) == i) for i in range(5)]
    return out + [float(x) for x in ("@" in s, s[:1] == "+", "(" in s, "-" in s, " " in s, any(c.isalpha() for c in s))]


FEATURES = len(shape(""))


def skip_keys(s: str) -> list[tuple[int, str]]:
    """(kind of edge, key): nodes that share a key are similar."""
    low = s.lower()
    plain = "".join(c for c in low if c.isalnum())
    digits = "".join(c for c in low if "0" <= c <= "9")
    out = [(SAME, plain)] if plain else []
    if len(digits) >= 7 and "@" not in s:
        out.append((TAIL, digits[-7:]))
        if len(digits) >= 12:
            out.append((PART, digits[:12]))
    if "@" in s:
        out.append((PART, low.split("@")[0]))
    elif any(c.isalpha() for c in s):
        out.append((PART, low))
    parts = s.split(".")
    if len(parts) in (3, 4) and all(p.isdigit() for p in parts[:3]):
        out.append((PART, ".".join(parts[:3])))
    return out


def edges(label: list[int], start: list[int], end: list[int], said: list[str]) -> list[tuple[int, int, int]]:
    """(node, node, kind of edge) of one document."""
    out = []
    order = sorted(range(len(said)), key=lambda i: (start[i], i))
    for i, j in zip(order, order[1:]):
        if start[j] - end[i] <= NEAR:
            out.append((i, j, CHAIN))
    groups: dict[tuple[int, str], list[int]] = {}
    for i in order:
        for k in skip_keys(said[i]):
            groups.setdefault(k, []).append(i)
    seen = set()
    for (kind, _), members in groups.items():
        anchor = next((i for i in members if label[i] != NONE), None)
        pairs = list(zip(members, members[1:])) + [(anchor, i) for i in members if anchor not in (None, i)]
        for i, j in pairs:
            pair = (min(i, j), max(i, j))
            # two observed nodes tell each other nothing; one edge for each pair, of the closest kind
            if pair not in seen and (label[i] == NONE or label[j] == NONE):
                seen.add(pair)
                out.append((*pair, kind))
    return out


class Model:
    """Log potentials: ``unary`` (features x labels) and ``pair`` (kinds of edges x labels x labels)."""

    def __init__(self) -> None:
        self.unary = np.zeros((FEATURES, LABELS))
        self.pair = np.zeros((4, LABELS, LABELS))
        self.trained = False

    def train(self, x: np.ndarray, label: np.ndarray, e: np.ndarray, steps: int = 800, rate: float = 3.0,
              decay: float = 1e-4) -> "Model":
        """Maximum pseudo-likelihood: each node's label given its string and its neighbours' labels.
        Skip edges of a kind have one weight for each cell of ``TIED``, whatever the entity."""
        want = np.eye(LABELS)[label]
        i, j, kind = e.T if len(e) else np.zeros((3, 0), np.int64)
        share = np.ones(len(label))
        for y in range(LABELS):  # rare kinds count as much as frequent ones
            share[label == y] = 1 / max(1, (label == y).sum())
        share /= share.sum()
        for _ in range(steps):
            logit = x @ self.unary
            np.add.at(logit, j, self.pair[kind, label[i], :])
            np.add.at(logit, i, self.pair[kind, :, label[j]])
            p = np.exp(logit - logit.max(axis=1, keepdims=True))
            gap = (want - p / p.sum(axis=1, keepdims=True)) * share[:, None]
            self.unary += rate * (x.T @ gap - decay * self.unary)
            up = np.zeros_like(self.pair)
            np.add.at(up, kind, want[i][:, :, None] * gap[j][:, None, :] + gap[i][:, :, None] * want[j][:, None, :])
            for k in (SAME, TAIL, PART):
                up[k] = np.bincount(TIED.ravel(), up[k].ravel())[TIED]
            self.pair += rate * (up - decay * self.pair)
        self.trained = True
        return self

    def beliefs(self, x: np.ndarray, label: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Label probabilities of each node by loopy sum-product; graphs of many documents at once."""
        n = len(label)
        own = x @ self.unary
        seen = label != NONE
        own[seen] = np.where(np.arange(LABELS)[None, :] == label[seen, None], 0.0, -50.0)
        if len(e):
            i, j, kind = e.T
            src, dst = np.concatenate([i, j]), np.concatenate([j, i])
            pot = np.concatenate([self.pair[kind], self.pair[kind].transpose(0, 2, 1)])
            back = np.concatenate([np.arange(len(e)) + len(e), np.arange(len(e))])
            msg = np.zeros((2 * len(e), LABELS))

            def total() -> np.ndarray:
                return own + np.stack([np.bincount(dst, msg[:, y], n) for y in range(LABELS)], axis=1)

            for _ in range(ROUNDS):
                out = (total()[src] - msg[back])[:, :, None] + pot
                top = out.max(axis=1)
                new = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
                msg = DAMPING * msg + (1 - DAMPING) * (new - new.max(axis=1, keepdims=True))
            own = total()
        p = np.exp(own - own.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def damaged(kind: int, s: str) -> list[str]:
    """Copies of a base span that its pattern no longer fits."""
    if kind == 0:
        local, domain = s.split("@")[0], s.split("@")[-1].split(".")[0]
        return [f"{local}@{domain}", local]
    if kind == 1:
        return [".".join(s.split(".")[:3])]
    digits = "".join(c for c in s if c.isdigit())
    if kind == 2:
        return [digits[:-1], ".".join(digits[i:i + 4] for i in range(0, len(digits), 4))]
    return [digits, digits[-10:], f"{digits[-10:-7]}-{digits[-7:-4]}-{digits[-4:]}"]


def graph(docs: list[tuple[list[int], list[int], list[int], list[str]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, labels, edges) of the nodes of several documents, numbered through."""
    x, label, e = [], [], []
    for own, start, end, said in docs:
        e += [(i + len(label), j + len(label), k) for i, j, k in edges(own, start, end, said)]
        x += [shape(s) for s in said]
        label += own
    return np.array(x).reshape(-1, FEATURES), np.array(label, np.int64), np.array(e, np.int64).reshape(-1, 3)


def training_graph(docs: list[tuple[list[int], list[int], list[int], list[str]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sample's graph with damaged copies: at home under the original's label, and as nodes of
    documents of their own under none. Unlabelled candidates that resemble a base span are left out."""
    built, want = [], []
    for own, start, end, said in docs:
        known = {k for y, s in zip(own, said) if y != NONE for k in skip_keys(s)}
        keep = [i for i in range(len(own)) if own[i] != NONE or not known & set(skip_keys(said[i]))]
        copies = [(own[i], c) for i in keep if own[i] != NONE for c in damaged(own[i], said[i])[:3]]
        far = max(end, default=0)
        place = [far + (NEAR + 50) * (i + 1) for i in range(len(copies))]
        texts = [said[i] for i in keep] + [c for _, c in copies]
        ends = [end[i] for i in keep] + [p + 1 for p in place]
        starts = [start[i] for i in keep] + place
        built.append(([own[i] for i in keep] + [NONE] * len(copies), starts, ends, texts))
        want += [own[i] for i in keep] + [y for y, _ in copies]
        for _, c in copies:
            built.append(([NONE], [0], [1], [c]))
            want.append(NONE)
    x, _, e = graph(built)
    return x, np.array(want, np.int64), e


NODES = "doc_id long, label array<int>, start array<int>, end array<int>, said array<string>"
_NODES = pa.schema([("doc_id", pa.int64()), ("label", pa.list_(pa.int32())), ("start", pa.list_(pa.int32())),
                    ("end", pa.list_(pa.int32())), ("said", pa.list_(pa.string()))])


def find_nodes(docs: DataFrame) -> DataFrame:
    """The nodes of every row of ``docs`` (doc_id, text), as arrays."""
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text", 1 << 22):
                data, off = text_bytes(b.column("text"))
                # a document without a digit and without "@" has no node
                marks = np.concatenate([[0], np.cumsum(((data >= 48) & (data <= 57)) | (data == 64))])
                some = marks[off[1:]] > marks[off[:-1]]
                rows: list[list] = [[[], [], [], []] for _ in range(b.num_rows)]
                at = np.flatnonzero(some)
                for i, text in zip(at, b.column("text").take(pa.array(at)).to_pylist()):
                    for y, a, z in nodes(text):
                        for part, v in zip(rows[i], (y, a, z, text[a:z])):
                            part.append(v)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id")] + [pa.array([r[k] for r in rows], _NODES.field(k + 1).type) for k in range(4)], schema=_NODES)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, NODES)


def fit(found: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_nodes: int = SAMPLE_NODES) -> Model:
    """The model of a sample of ``found`` (the result of ``find_nodes``): the ``sample_docs`` rows with
    the smallest hashes of those with at most ``sample_nodes`` nodes, equal rows taken once. Without
    any base span it is untrained, and an untrained model adds no span."""
    rows = (found.filter((F.size("label") > 0) & (F.size("label") <= sample_nodes)).distinct()
            .orderBy(F.xxhash64("doc_id", "start", "said"), "doc_id", "label", "start", "end", "said").limit(sample_docs).collect())
    sample = [(list(r.label), list(r.start), list(r.end), list(r.said)) for r in rows]
    if not any(y != NONE for r in sample for y in r[0]):
        return Model()
    x, want, e = training_graph(sample)
    return Model().train(x, want, e)


def label_nodes(found: DataFrame, model: Model) -> DataFrame:
    """doc_id, base and spans: arrays of (kind, start, end) by kind and start, ``kind`` as a number
    of ``KINDS``; base spans alone, and with those that the model adds."""
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            docs = list(zip(*[b.column(c).to_pylist() for c in ("label", "start", "end", "said")]))
            open_ = [i for i, d in enumerate(docs) if model.trained and NONE in d[0]]
            added: dict[int, list[tuple[int, int, int]]] = {}
            if open_:
                x, label, e = graph([docs[i] for i in open_])
                belief = model.beliefs(x, label, e)
                best = belief.argmax(axis=1)
                take = (label == NONE) & (best != NONE) & (belief.max(axis=1) >= SURE)
                at = 0
                for i in open_:
                    own, start, end, _ = docs[i]
                    added[i] = [(int(best[at + k]), start[k], end[k]) for k in np.flatnonzero(take[at:at + len(own)])]
                    at += len(own)
            base = [sorted((y, a, z) for y, a, z in zip(d[0], d[1], d[2]) if y != NONE) for d in docs]
            every = [sorted(s + added.get(i, [])) for i, s in enumerate(base)]

            def column(rows: list) -> pa.Array:
                return pa.array([[dict(zip(("kind", "start", "end"), s)) for s in r] for r in rows], pa.list_(span))

            yield pa.RecordBatch.from_arrays([b.column("doc_id"), column(base), column(every)], ["doc_id", "base", "spans"])

    kind = "array<struct<kind:int,start:int,end:int>>"
    return found.mapInArrow(run, f"doc_id long, base {kind}, spans {kind}")


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, base, spans (see ``label_nodes``).

    A null or empty text has no span. Rows that repeat a doc_id, or have none, are documents of their
    own; equal texts get equal spans. Texts are searched whole, and time grows with their length. An
    empty table gives an empty result; other columns are ignored.
    """
    found = stored(find_nodes(docs), "nodes")
    return label_nodes(found, fit(found))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans as ``kind:start:end`` text."""
    name = F.array(*[F.lit(k) for k in KINDS])

    def text(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(k: int):
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")

    counts = [count(k).alias(f"n_{n}") for k, n in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))
