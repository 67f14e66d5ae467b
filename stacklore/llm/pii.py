"""Personal data by a skip-chain conditional random field over candidate tokens.

Base spans come from four patterns with their checks. The field's nodes are the base spans of
a text and all other tokens that hold a digit or an at sign; its labels are the four kinds and
none. Node potentials are log-linear in a token's shape (digits, signs, length, neighbours),
chain potentials join neighbouring nodes, and skip potentials join distant nodes that repeat
or resemble each other: the same letters and digits, or the same last digits. Loopy sum-product
messages run until they settle, so that a label that is sure in one place carries over to the
same thing written otherwise elsewhere in the text. Base spans are observed: they stay.

Weights are counts over all documents, learned from the base patterns: shape features per
label, and labels of neighbours. The table has at most FEATURES * labels rows. Skip edges link
each node to the previous one with its key, so their number is linear in the tokens.

Defined cases: null texts are empty; empty texts have no spans and the digest of the empty
string; very long texts are read whole, in linear time; repeated rows give equal rows; a null
doc_id stays null; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stacklore.session import materialise

KINDS = ("email", "ip", "card", "phone")
LABELS = (*KINDS, "none")
NONE = len(KINDS)
SKIP_PRIOR = 50  # agreeing skip edges taken for granted before any is counted
CHAIN_REACH = 40  # code points between neighbours that share a chain potential
SUFFIX_DIGITS = 7
CONFIDENCE = 0.7
SETTLED = 1e-4

# The patterns that define the base kinds. Possessive runs and the look-behind
# change no match, they keep long runs linear.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_HINT = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*[0-9@]\S*")
_EDGE_SIGNS = ".,;:!?\"'()[]{}<>|*#$%&="


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for at, c in enumerate(reversed(digits)):
        value = ord(c) - 48
        if at % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind index, start, end) by kind, then start."""
    if not _HINT.search(text):
        return []
    out = [(0, *s) for s in _emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = _digits(m[0]) if m.end() - m.start() >= 16 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{LABELS[k]}:{s}:{e}" for k, s, e in sorted(spans))


@dataclass(frozen=True)
class Node:
    start: int
    end: int
    label: int | None  # observed kind of a base span, None for a free token


def nodes_of(text: str, spans: list[tuple[int, int, int]]) -> list[Node]:
    """Base spans and the free tokens between them, by place."""
    taken = sorted({(s, e, k) for k, s, e in spans})
    nodes = [Node(s, e, k) for s, e, k in taken]
    at = 0
    for m in _TOKEN.finditer(text):
        start, end = m.start(), m.end()
        while start < end and text[start] in _EDGE_SIGNS:
            start += 1
        while end > start and text[end - 1] in _EDGE_SIGNS:
            end -= 1
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        near = taken[max(0, at - 1):at + 2]
        if end > start and not any(s < end and start < e for s, e, _ in near):
            nodes.append(Node(start, end, None))
    return sorted(nodes, key=lambda n: (n.start, n.end))


def _checks(content: str) -> str:
    """Whether a token that looks like a card or an address passes its check; the field weighs it like a shape."""
    digits = _digits(content)
    if 13 <= len(digits) <= 19:
        return f"luhn-{luhn(digits)}"
    parts = content.split(".")
    if len(parts) == 4 and all(p and p == _digits(p) for p in parts):
        return f"ip-{all(len(p) <= 3 and int(p) <= 255 for p in parts)}"
    return "none"


def features(text: str, node: Node) -> list[str]:
    """Shape of a token and of what stands beside it."""
    content = text[node.start:node.end]
    digits = sum("0" <= c <= "9" for c in content)
    letters = sum(c.isalpha() for c in content)
    before = text[max(0, node.start - 2):node.start].strip()[-1:]
    return [
        f"digits={min(digits, 24)}", f"letters={min(letters, 24) // 3}", f"dots={min(content.count('.'), 5)}",
        f"at={min(content.count('@'), 2)}", f"dashes={min(content.count('-'), 4)}",
        f"brackets={'(' in content}", f"equals={'=' in content}", f"before={'sign' if before and not before.isalnum() else 'word'}",
        f"length={min((node.end - node.start) // 4, 12)}", f"check={_checks(content)}",
    ]


FEATURES = 25 + 9 + 6 + 3 + 5 + 2 + 2 + 2 + 13 + 5


@dataclass
class Weights:
    node: dict[str, np.ndarray]
    prior: np.ndarray
    chain: np.ndarray
    skip: float

    @classmethod
    def from_counts(
        cls, counts: dict[tuple[str, int], int], pairs: dict[tuple[int, int], int], agree: int = 0, differ: int = 0
    ) -> Weights:
        """Smoothed log-odds of each feature per label, halved because features overlap.

        The log-potential of a skip edge is the log-odds that two observed spans it joins agree.
        """
        n = len(LABELS)
        seen = np.ones(n)
        for (name, label), c in counts.items():
            if name == "any":
                seen[label] += c
        node: dict[str, np.ndarray] = defaultdict(lambda: np.full(n, 0.5))
        for (name, label), c in counts.items():
            if name != "any":
                node[name][label] += c
        potentials = {}
        for name, c in node.items():
            share = c / (seen + 1)
            potentials[name] = 0.5 * (np.log(share) - math.log(c.sum() / (seen.sum() + 1)))
        together = np.full((n, n), 1.0)
        for (a, b), c in pairs.items():
            together[a, b] += c
        expected = together.sum(1, keepdims=True) * together.sum(0, keepdims=True) / together.sum()
        chain = np.clip(np.log(together / expected), -1.0, 1.0)
        return cls(potentials, np.log(seen / seen.sum()), chain, math.log((agree + SKIP_PRIOR) / (differ + 1)))


def skip_keys(content: str) -> list[str]:
    """What repeated or similar tokens have in common."""
    folded = "".join(c for c in content.lower() if c.isalnum())
    digits = _digits(content)
    keys = [f"same:{folded}"] if len(folded) >= 5 else []
    if len(digits) >= SUFFIX_DIGITS:
        keys.append(f"tail:{digits[-SUFFIX_DIGITS:]}")
    if "@" in content:
        keys.append(f"name:{content.lower().partition('@')[0]}")
    elif len(content) >= 5:
        keys.append(f"name:{content.lower()}")
    return keys


def skip_edges(text: str, nodes: list[Node]) -> list[tuple[int, int]]:
    last: dict[str, int] = {}
    edges = set()
    for i, node in enumerate(nodes):
        for key in skip_keys(text[node.start:node.end]):
            if key in last and last[key] != i:
                edges.add((last[key], i))
            last[key] = i
    return sorted(edges)


def infer(text: str, nodes: list[Node], weights: Weights) -> tuple[np.ndarray, int]:
    """Label marginals by loopy sum-product messages over chain and skip edges, and the rounds sent.

    Messages go on until they settle. Damped by half they do on trees after a round per edge of
    the longest path, and mostly much earlier; loops that swing longer are damped more and more.
    """
    n = len(LABELS)
    local = np.zeros((len(nodes), n))
    for i, node in enumerate(nodes):
        if node.label is not None:
            local[i] = -30.0
            local[i, node.label] = 0.0
            continue
        local[i] = weights.prior + sum((weights.node[f] for f in features(text, node) if f in weights.node), np.zeros(n))
    skip = weights.skip * np.eye(n)
    edges = [(a, b, skip) for a, b in skip_edges(text, nodes)]
    edges += [
        (i, i + 1, weights.chain) for i in range(len(nodes) - 1) if nodes[i + 1].start - nodes[i].end <= CHAIN_REACH
    ]
    if not edges:
        return _normalised(local), 0
    source = np.array([e[0] for e in edges] + [e[1] for e in edges])
    target = np.array([e[1] for e in edges] + [e[0] for e in edges])
    potential = np.exp(np.array([e[2] for e in edges] + [e[2].T for e in edges]))
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    messages = np.full((len(source), n), -math.log(n))
    step, rounds = 0.5, 0
    while True:
        rounds += 1
        belief = local.copy()
        np.add.at(belief, target, messages)
        incoming = belief[source] - messages[back]
        incoming -= incoming.max(axis=1, keepdims=True)
        fresh = np.log(np.maximum(np.einsum("ei,eij->ej", np.exp(incoming), potential), 1e-300))
        fresh -= fresh.max(axis=1, keepdims=True)
        moved = step * np.abs(fresh - messages).max()
        messages = step * fresh + (1 - step) * messages
        if moved < SETTLED:
            break
        if rounds > 30 + len(nodes):
            step *= 0.9
    belief = local.copy()
    np.add.at(belief, target, messages)
    return _normalised(belief), rounds


def _normalised(log_belief: np.ndarray) -> np.ndarray:
    p = np.exp(log_belief - log_belief.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def added_spans(
    text: str, spans: list[tuple[int, int, int]], weights: Weights
) -> tuple[list[tuple[int, int, int]], int]:
    """Free tokens whose marginal gives a kind with CONFIDENCE, as spans, and the rounds of messages sent."""
    nodes = nodes_of(text, spans)
    if all(node.label is not None for node in nodes):
        return [], 0
    marginals, rounds = infer(text, nodes, weights)
    best = marginals.argmax(axis=1)
    return [
        (int(best[i]), node.start, node.end) for i, node in enumerate(nodes)
        if node.label is None and best[i] != NONE and marginals[i, best[i]] >= CONFIDENCE
    ], rounds


def fit(docs: DataFrame, text: str = "text") -> Weights:
    """Counts over all documents: shape features per label, labels of neighbours, agreement of skip edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for content in batch.column(0).to_pylist():
                nodes = nodes_of(content, base_spans(content))
                labels = [NONE if node.label is None else node.label for node in nodes]
                for node, label in zip(nodes, labels, strict=True):
                    counts["any", label] += 1
                    counts.update((f, label) for f in features(content, node))
                for i in range(len(nodes) - 1):
                    if nodes[i + 1].start - nodes[i].end <= CHAIN_REACH:
                        counts[f"pair={labels[i]}", labels[i + 1]] += 1
                for a, b in skip_edges(content, nodes):
                    if nodes[a].label is not None and nodes[b].label is not None:
                        counts["skip", int(labels[a] == labels[b])] += 1
        rows = list(counts.items())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.int32()),
             pa.array([c for _, c in rows], pa.int64())],
            names=["name", "label", "n"],
        )

    hinted = docs.select(docs[text].alias("text")).filter(F.col("text").rlike("[0-9@]"))
    counted = hinted.mapInArrow(run, "name string, label int, n long").groupBy("name", "label").agg(F.sum("n").alias("n"))
    rows = materialise(counted, "field-counts").collect()
    pairs = {(int(r["name"][5:]), r["label"]): r["n"] for r in rows if r["name"].startswith("pair=")}
    skips = {r["label"]: r["n"] for r in rows if r["name"] == "skip"}
    counts = {(r["name"], r["label"]): r["n"] for r in rows if not r["name"].startswith("pair=") and r["name"] != "skip"}
    return Weights.from_counts(counts, pairs, skips.get(1, 0), skips.get(0, 0))


def find(docs: DataFrame, weights: Weights, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, n_rounds) per row of `docs`."""
    counts = [f"n_{kind}" for kind in KINDS]
    names = ["doc_id", *counts, "base_sha256", "spans", "n_added", "n_rounds"]
    kinds = [*[pa.int64()] * len(counts), pa.string(), pa.string(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for content in batch.column(1).to_pylist():
                content = content or ""
                base = base_spans(content)
                added, rounds = added_spans(content, base, weights) if _HINT.search(content) else ([], 0)
                per_kind = Counter(k for k, _, _ in base)
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append((*[per_kind[k] for k in range(len(KINDS))], digest, joined([*base, *added]), len(added), rounds))
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]], names=names
            )

    chosen = docs.select(docs[id_column].alias("doc_id"), docs[text].alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}", *[f"{c} long" for c in counts], "base_sha256 string, spans string, n_added long, n_rounds long"])
    return chosen.mapInArrow(run, schema)
