"""Personal data by patterns, extended by a skip-chain conditional random field.

Nodes are the tokens with a digit or an at sign; all others are outside by definition. Chain
potentials join tokens next to each other, skip potentials join the occurrences of a repeated
or similar token (same digits, or same lower-cased address) anywhere in the document: each that
no pattern matches with one that a pattern does, so that evidence reaches all of them however
many there are, and all others with the one before. Digit groups that together have the digits
of a match are one node. Pattern matches are evidence, loopy message passing over the whole
document, until the messages settle, gives every other node its label, and what it labels surely
is added to the spans.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlake.llm.sample import sample_texts
from churnlake.llm.tasks import lean

# Kinds in their order, and the base patterns.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

#: Documents with nodes that training reads, smallest hashes of the text first.
SAMPLE_ROWS = 2_000
#: Nodes of one sampled document that enter training; a bound on the sample, not on use.
SAMPLE_NODES = 200
#: Weight of all fixed repeats of values in training, in samples.
REPEATS_SHARE = 4
SURE = 0.9
#: Text whose graphs are solved together (or one longer text).
BLOCK_BYTES = 1 << 20
#: Messages have settled once none moves by more than this; damped messages that never settle
#: (loops can make them swing) are taken as they are after this many rounds.
SETTLED, ROUNDS = 1e-4, 2_000
_LABELS = len(KINDS) + 1  # 0 is outside


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: each starts with the run of name characters before its at sign."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the pattern matches that pass their tests, in order."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGITS.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255
               for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NOT_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    out.sort()
    return out


_TRIM = ".,;:!?\"'()[]{}<>|"
_SPACE = re.compile(r"\s")


def nodes(text: str) -> list[tuple[int, int]]:
    """Spans of the tokens with a digit or an at sign, without the marks around them."""
    out, done = [], 0
    for m in re.finditer(r"[0-9@]", text):
        at = m.start()
        if at < done:
            continue
        start = at
        while start > done and not text[start - 1].isspace():
            start -= 1
        found = _SPACE.search(text, at)
        done = found.start() if found else len(text)
        token = text[start:done]
        left = len(token) - len(token.lstrip(_TRIM))
        body = token.strip(_TRIM)
        if body:
            out.append((start + left, start + left + len(body)))
    return out


N_FEATURES = 18


def features(token: str) -> list[int]:
    """Binary shape features of one token."""
    digits = _NOT_DIGIT.sub("", token)
    n, parts = len(digits), token.split(".")
    dotted = len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts)
    letters = any(map(str.isalpha, token))
    return [1, "@" in token, "@" in token and "." in token.rpartition("@")[2],
            token[0] == "+", n == 0, 1 <= n <= 3, 4 <= n <= 8, 9 <= n <= 11, 12 <= n <= 15,
            16 <= n <= 19, n > 19, dotted,
            dotted and all(len(p) <= 3 and int(p) <= 255 for p in parts),
            12 <= n <= 19 and luhn(digits), letters, letters and n > 0, "-" in token,
            len(token) == n]


def similarity_key(token: str) -> str | None:
    """What repeated or similar tokens share: their digits, or the address in lower case."""
    if "@" in token:
        return token.lower()
    if any(map(str.isalpha, token)):
        return None
    digits = _NOT_DIGIT.sub("", token)
    return digits if len(digits) >= 7 else None


_BETWEEN = re.compile(r"[\x20\t().-]{1,3}")
_NUMBER = re.compile(r"[+(]?[0-9][0-9().-]*")


def matched_keys(text: str, base: list[tuple[int, int, int]]) -> dict[str, int]:
    """Keys of the pattern matches with their kinds; a +1 phone also without its country code."""
    out = {}
    for start, kind, end in base:
        key = similarity_key(re.sub(r"\s", "", text[start:end]))
        if key is not None:
            out.setdefault(key, kind)
            if kind == KINDS.index("phone") and len(key) == 11 and key[0] == "1":
                out.setdefault(key[1:], kind)
    return out


def joined(text: str, spans: list[tuple[int, int]], taken: list[int],
           keys: dict[str, int]) -> list[tuple[int, int]]:
    """The spans, with adjacent digit groups that together have a key's digits as one."""
    lengths = {len(k) for k in keys if k.isdigit()}
    if not lengths:
        return spans
    longest, out, i = max(lengths), [], 0
    while i < len(spans):
        digits, found = "", i
        for j in range(i, len(spans)):
            token = text[spans[j][0]:spans[j][1]]
            if taken[j] >= 0 or not _NUMBER.fullmatch(token) or (
                    j > i and not _BETWEEN.fullmatch(text[spans[j - 1][1]:spans[j][0]])):
                break
            digits += _NOT_DIGIT.sub("", token)
            if len(digits) > longest:
                break
            if len(digits) in lengths and digits in keys:
                found = j
        out.append((spans[i][0], spans[found][1]))
        i = found + 1
    return out


class Graph:
    """Nodes and edges of a document: spans, features, evidence (-1: none), chain and skips.

    ``linked`` is the label of a match elsewhere with the node's key, 0 without one.
    """

    def __init__(self, text: str, base: list[tuple[int, int, int]]):
        self.spans = nodes(text)
        keys = matched_keys(text, base)
        self.spans = joined(text, self.spans, self._evidence(base), keys)
        tokens = [text[a:b] for a, b in self.spans]
        self.features = [features(t) for t in tokens]
        self.evidence = self._evidence(base)
        self.chain = [(i, i + 1) for i in range(len(tokens) - 1)
                      if not text[self.spans[i][1]:self.spans[i + 1][0]].strip(_TRIM + " \t")]
        found = [similarity_key(token) for token in tokens]
        starts = [a for a, _ in self.spans]
        match: dict[str, int] = {}       # a node of the first match of each key
        for start, kind, end in base:
            i = bisect_right(starts, start) - 1
            i += i < 0 or self.spans[i][1] <= start
            if i < len(starts) and self.evidence[i] == kind + 1:
                for key in matched_keys(text, [(start, kind, end)]):
                    match.setdefault(key, i)
        self.skip, self.linked, last = [], [0] * len(tokens), {}
        for i, key in enumerate(found):
            if key is not None:
                if self.evidence[i] < 0 and key in match:
                    self.linked[i] = self.evidence[match[key]]
                    self.skip.append((match[key], i))
                    continue
                if key in last:
                    self.skip.append((last[key], i))
                last[key] = i

    def _evidence(self, base: list[tuple[int, int, int]]) -> list[int]:
        out, ends = [-1] * len(self.spans), [b for _, b in self.spans]
        for start, kind, end in base:
            for i in range(bisect_right(ends, start), len(ends)):
                if self.spans[i][0] >= end:
                    break
                if out[i] < 0:
                    out[i] = kind + 1
        return out


class Field:
    """Weights: unary (features by labels), chain and skip potentials (labels by labels)."""

    def __init__(self, unary: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.unary, self.chain, self.skip = unary, chain, skip

    def beliefs(self, graphs: list[Graph], rounds: int = ROUNDS) -> np.ndarray:
        """Marginals of all nodes of the graphs by sum-product message passing.

        Graphs whose messages have settled leave the rounds, the others go on.
        """
        first = np.cumsum([0] + [len(g.spans) for g in graphs])
        scores = np.array([f for g in graphs for f in g.features], float).reshape(
            -1, N_FEATURES) @ self.unary
        evidence = np.array([e for g in graphs for e in g.evidence], int)
        known = np.flatnonzero(evidence >= 0)
        scores[known] = -1e9            # whatever any number of neighbours say
        scores[known, evidence[known]] = 0.0
        edges = [(a + at, b + at, kind, n) for n, (g, at) in enumerate(zip(graphs, first))
                 for kind, pairs in ((0, g.chain), (1, g.skip)) for a, b in pairs]
        total = scores.copy()
        if edges:
            a, b, kind, graph = np.array(edges).T
            weights = np.stack([self.chain, self.skip])[kind]
            ends = np.concatenate([a, b])           # message i goes from ends[i] to goal[i]
            goal = np.concatenate([b, a])
            of = np.concatenate([graph, graph])
            weights = np.concatenate([weights, weights.transpose(0, 2, 1)])
            back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
            sent = np.zeros((len(ends), _LABELS))
            live = np.arange(len(ends))             # messages of graphs that have not settled
            for _ in range(rounds):
                total[goal[live]] = scores[goal[live]]
                np.add.at(total, goal[live], sent[live])
                out = (total[ends[live]] - sent[back[live]])[:, :, None] + weights[live]
                top = out.max(axis=1)
                out = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
                out -= out.max(axis=1, keepdims=True)
                moved = np.zeros(len(graphs))
                np.maximum.at(moved, of[live], np.abs(out - sent[live]).max(axis=1))
                sent[live] = 0.5 * sent[live] + 0.5 * out
                live = live[moved[of[live]] > SETTLED]
                if not len(live):
                    break
            total = scores.copy()
            np.add.at(total, goal, sent)
        total -= total.max(axis=1, keepdims=True)
        prob = np.exp(total)
        return prob / prob.sum(axis=1, keepdims=True)


# One value or two of each kind, whose repeats in other forms are in every training.
_REPEATED = (("phone", "14155552671"), ("phone", "442079460958"), ("card", "4111111111111111"),
             ("card", "378282246310005"), ("email", "a.b@example.org"), ("ip", "192.168.100.200"))


def repeats() -> list[tuple[str, int, int]]:
    """(token, label of the node that a skip edge leads to or -1, label) of forms of values.

    Joined to a match a repeat has its label; where no pattern matches the form, it is outside
    when alone or joined to one that is outside.
    """
    out = []
    for kind, value in _REPEATED:
        label = KINDS.index(kind) + 1
        forms = [value]
        if value.isdigit():
            forms += [value[1:]] if kind == "phone" else []
            forms += [mark.join(re.findall("[0-9]{1,4}", value)) for mark in (" ", "-", ".")]
            forms += [f"{value[1:4]}) {value[4:7]}-{value[7:]}"] if kind == "phone" else []
        for form in forms:
            out.append((form, label, label))
            if not base_spans(form):
                out += [(form, -1, 0), (form, 0, 0)]
    return out


def train(texts: list[str], steps: int = 300, rate: float = 0.5, decay: float = 1e-3) -> Field:
    """Fit by pseudo-likelihood, with the patterns' labels as the truth of the sample.

    Every node is predicted from its features and its neighbours' labels. A node that no pattern
    matches but one with its key elsewhere has that one's label. The fixed ``repeats`` weigh
    ``REPEATS_SHARE`` times the sample, so that what a match elsewhere says is learnt from any.
    Without texts all weights but a bias towards outside are zero.
    """
    rows, labels = [], []
    for text in texts:
        graph = Graph(text, base_spans(text))
        truth = [max(e, linked) for e, linked in zip(graph.evidence, graph.linked)]
        near = np.zeros((len(truth), 3 * _LABELS))
        for a, b in graph.chain:
            near[b, truth[a]] += 1
            near[a, _LABELS + truth[b]] += 1
        for a, b in graph.skip:
            near[a, 2 * _LABELS + truth[b]] += 1
            near[b, 2 * _LABELS + truth[a]] += 1
        for i in range(min(len(truth), SAMPLE_NODES)):
            rows.append(np.concatenate([graph.features[i], near[i]]))
            labels.append(truth[i])
    weights = [1.0] * len(rows)
    if rows:
        fixed = repeats()
        weights += [REPEATS_SHARE * len(rows) / len(fixed)] * len(fixed)
        for token, other, label in fixed:
            near = np.zeros(3 * _LABELS)
            if other >= 0:
                near[2 * _LABELS + other] = 1
            rows.append(np.concatenate([features(token), near]))
            labels.append(label)
    w = np.zeros((N_FEATURES + 3 * _LABELS, _LABELS))
    w[0, 0] = 4.0
    if rows:
        x, y = np.array(rows, float), np.array(labels)
        count = np.bincount(y, minlength=_LABELS)
        share = (1 / np.maximum(count, 1))[y] * len(y) / max(1, (count > 0).sum())
        share = np.sqrt(share / share.mean())  # rare kinds weigh more, not as much as all
        share *= np.array(weights) / np.mean(weights)
        moment = np.zeros_like(w)
        for _ in range(steps):
            score = x @ w
            score -= score.max(axis=1, keepdims=True)
            p = np.exp(score)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            moment = 0.9 * moment + x.T @ (p * share[:, None]) / len(y) + decay * w
            w -= rate * moment
    before, after, skip = (w[N_FEATURES + k * _LABELS:N_FEATURES + (k + 1) * _LABELS]
                           for k in range(3))
    return Field(w[:N_FEATURES], (before + after.T) / 2, (skip + skip.T) / 2)


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS, text_col: str = "text") -> Field:
    """Train on the ``rows`` distinct texts with a node whose hashes are smallest."""
    text = F.col(text_col)
    noded = docs.filter(text.rlike("[0-9@]")).select(F.lit("").alias("label"), text.alias("text"))
    return train(sorted(r["text"] for r in sample_texts(noded, rows).collect()))


def find(texts: list[str | None], field: Field) -> Iterator[tuple[list, list]]:
    """(base spans, all spans) of each text."""
    texts = [t or "" for t in texts]
    bases = [base_spans(t) for t in texts]
    graphs, of = [], []
    for i, text in enumerate(texts):
        if _DIGITS.search(text) or "@" in text:
            graph = Graph(text, bases[i])
            if -1 in graph.evidence:
                graphs.append(graph)
                of.append(i)
    extra: dict[int, list] = {}
    if graphs:
        prob = field.beliefs(graphs)
        at = 0
        for i, graph in zip(of, graphs):
            p = prob[at:at + len(graph.spans)]
            at += len(graph.spans)
            label = p.argmax(axis=1)
            for k in np.flatnonzero((label > 0) & (p.max(axis=1) >= SURE)):
                if graph.evidence[k] < 0:
                    a, b = graph.spans[k]
                    extra.setdefault(i, []).append((a, int(label[k]) - 1, b))
    for i, base in enumerate(bases):
        yield base, sorted(base + extra[i]) if i in extra else base


def as_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind; of overlapping ones the first counts."""
    out, done = [], 0
    for a, k, b in spans:
        if a >= done:
            out += [text[done:a], f"[{KINDS[k].upper()}]"]
            done = b
        elif b > done:
            done = b
    return "".join([*out, text[done:]])


_SPANS = "ARRAY<STRUCT<kind: STRING, start: BIGINT, end: BIGINT>>"


def detect(docs: DataFrame, field: Field | None = None, text_col: str = "text",
           with_masked: bool = False, out_col: str = "pii") -> DataFrame:
    """All columns with a struct ``out_col``: base and all spans, and the masked text if asked.

    Starts and ends are code points, ends exclusive; spans are in order of start, then kind. A
    null text counts as empty and has none (its masked text stays null). The field is fitted on
    the input by default. A column of that name in the input is replaced; repeated rows get equal
    results.
    """
    field = field or fit(docs, text_col=text_col)
    kept = [c for c in docs.columns if c != out_col]
    at = docs.columns.index(text_col)
    made = f"base {_SPANS}, spans {_SPANS}" + (", masked STRING" if with_masked else "")
    schema = T.StructType([*docs.select(*kept).schema,
                           T.StructField(out_col, T.StructType.fromDDL(made.replace(": ", ":")))])

    @lean
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()),
                                   ("end", pa.int64())]))

        def column(all_spans):
            return pa.array([[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans]
                             for spans in all_spans], span)

        for whole in batches:
            step = max(1, int(whole.num_rows * BLOCK_BYTES / max(1, whole.nbytes)))
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                texts = batch.column(at).to_pylist()
                found = list(find(texts, field))
                parts = [column(b for b, _ in found), column(s for _, s in found)]
                if with_masked:
                    parts.append(pa.array([None if t is None else masked(t, s)
                                           for t, (_, s) in zip(texts, found)], pa.string()))
                pii = pa.StructArray.from_arrays(parts, ["base", "spans", "masked"][:len(parts)])
                columns = [c for c, n in zip(batch.columns, batch.schema.names) if n != out_col]
                yield pa.RecordBatch.from_arrays([*columns, pii], names=[*kept, out_col])

    return docs.mapInArrow(rows, schema)
