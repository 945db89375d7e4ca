"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads every word's bytes in both directions, labels every byte position, and a
document's probabilities pool the labels of all its positions. It is trained in numpy by back
propagation through time on a bounded sample of labelled rows. Since the state starts anew at
each word, equal words have equal labels and are computed once per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlake.llm.sample import sample_texts
from churnlake.llm.tasks import lean
from churnlake.llm.words import word_spans

HIDDEN = 16
#: Labelled texts of each language that training reads, smallest hashes first.
SAMPLE_ROWS = 300
STEPS, BATCH, RATE = 500, 256, 0.01
#: Bytes that one run of the network reads; longer words are read in such pieces.
MAX_BYTES = 40
UNKNOWN = "und"
_NO_LETTER = bytes(b for b in range(128) if not 97 <= b <= 122)
_LETTERS = np.ones(256, bool)
_LETTERS[list(_NO_LETTER)] = False


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x = np.tanh(x * np.float32(0.5))
    x += 1
    x *= np.float32(0.5)
    return x


class Network:
    """Parameters of both directions and the label layer."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.languages, k = languages, len(languages)

        def normal(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)

        self.p = {"bias": np.zeros(k, np.float32), "out": normal(2 * hidden, k, scale=0.3)}
        for way in "fb":
            self.p[f"in_{way}"] = normal(256, 3 * hidden, scale=0.3)
            self.p[f"rec_{way}"] = normal(hidden, 3 * hidden, scale=hidden ** -0.5)
            self.p[f"add_{way}"] = np.zeros(3 * hidden, np.float32)

    def _run(self, way: str, x: np.ndarray):
        """States of one direction over equally long rows of bytes, and what backward needs."""
        table, rec = self.p[f"in_{way}"] + self.p[f"add_{way}"], self.p[f"rec_{way}"]
        n, length = x.shape
        h = len(rec)
        state = np.zeros((n, h), np.float32)
        states, kept = np.empty((length, n, h), np.float32), []
        for t in (range(length) if way == "f" else range(length - 1, -1, -1)):
            gates = table[x[:, t]]
            inner = state @ rec
            zr = _sigmoid(gates[:, :2 * h] + inner[:, :2 * h])
            z, r = zr[:, :h], zr[:, h:]
            new = np.tanh(gates[:, 2 * h:] + r * inner[:, 2 * h:])
            kept.append((t, state, z, r, new, inner[:, 2 * h:]))
            state = new + z * (state - new)
            states[t] = state
        return states, kept

    def labels(self, x: np.ndarray) -> np.ndarray:
        """Log probabilities of the languages at each position: (length, rows, languages)."""
        both = np.concatenate([self._run("f", x)[0], self._run("b", x)[0]], axis=2)
        scores = both @ self.p["out"] + self.p["bias"]
        scores -= scores.max(axis=2, keepdims=True)
        return scores - np.log(np.exp(scores).sum(axis=2, keepdims=True))

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over all positions, and its gradient through time."""
        n, length = x.shape
        f, kept_f = self._run("f", x)
        b, kept_b = self._run("b", x)
        both = np.concatenate([f, b], axis=2)
        scores = both @ self.p["out"] + self.p["bias"]
        scores -= scores.max(axis=2, keepdims=True)
        prob = np.exp(scores)
        prob /= prob.sum(axis=2, keepdims=True)
        rows = np.arange(n)
        loss = float(-np.log(prob[:, rows, y] + 1e-12).mean())
        prob[:, rows, y] -= 1
        prob /= n * length
        g = {"bias": prob.sum(axis=(0, 1)),
             "out": np.einsum("tnh,tnk->hk", both, prob, optimize=True)}
        back = prob @ self.p["out"].T
        h = f.shape[2]
        for way, kept, out in (("f", kept_f, back[:, :, :h]), ("b", kept_b, back[:, :, h:])):
            rec = self.p[f"rec_{way}"]
            g_in, g_rec = np.zeros_like(self.p[f"in_{way}"]), np.zeros_like(rec)
            g_add, down = np.zeros_like(self.p[f"add_{way}"]), np.zeros((n, h), np.float32)
            for t, before, z, r, new, inner in reversed(kept):
                d = down + out[t]
                d_new = d * (1 - z) * (1 - new * new)
                d_z = d * (before - new) * z * (1 - z)
                d_r = d_new * inner * r * (1 - r)
                gate = np.concatenate([d_z, d_r, d_new], axis=1)
                through = np.concatenate([d_z, d_r, d_new * r], axis=1)
                np.add.at(g_in, x[:, t], gate)
                g_add += gate.sum(axis=0)
                g_rec += before.T @ through
                down = d * z + through @ rec.T
            g[f"in_{way}"], g[f"rec_{way}"], g[f"add_{way}"] = g_in, g_rec, g_add
        return loss, g


def pieces(word: bytes) -> list[bytes]:
    """The word between blanks, in runs of at most ``MAX_BYTES`` bytes."""
    marked = b" " + word + b" "
    return [marked[i:i + MAX_BYTES] for i in range(0, len(marked), MAX_BYTES)]


def words_of(text: str) -> list[bytes]:
    """Words with a letter (or any byte beyond ASCII); ASCII letters lower-cased."""
    return [w for w in text.encode("utf-8", "replace").lower().split()
            if w.translate(None, _NO_LETTER)]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def train(samples: list[tuple[str, str]], steps: int = STEPS, batch: int = BATCH,
          seed: int = 1) -> Network | None:
    """Fit a network to (text, language) rows; none without a usable row.

    Each step draws one length and then words of that length, languages evenly.
    """
    by_language: dict[str, dict[int, list[bytes]]] = {}
    for text, language in samples:
        for word in words_of(text or ""):
            for part in pieces(word):
                by_language.setdefault(language, {}).setdefault(len(part), []).append(part)
    if not by_language:
        return None
    languages = sorted(by_language)
    net, rng = Network(languages, seed=seed), np.random.default_rng(seed)
    lengths = sorted({n for parts in by_language.values() for n in parts})
    weight = np.array([sum(len(p.get(n, ())) for p in by_language.values()) for n in lengths], float)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    for step in range(1, steps + 1):
        n = int(rng.choice(lengths, p=weight / weight.sum()))
        having = [k for k, language in enumerate(languages) if by_language[language].get(n)]
        y = np.array(having)[rng.integers(len(having), size=batch)]
        words = [by_language[languages[k]][n] for k in y]
        x = np.frombuffer(b"".join(w[int(rng.integers(len(w)))] for w in words),
                          np.uint8).reshape(batch, n)
        _, g = net.gradients(x, y)
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, v in net.p.items():
            one, two = moment[k]
            one += 0.1 * (g[k] - one)
            two += 0.01 * (g[k] * g[k] - two)
            v -= rate * (one / (1 - 0.9 ** step)) / (np.sqrt(two / (1 - 0.99 ** step)) + 1e-8)
    return net


class Scorer:
    """Sums of position labels by word, each word computed once while it is remembered.

    Words are known by their 64-bit hashes, sorted, next to their mean label row.
    """

    LIMIT = 1_000_000
    POSITIONS = 7

    def __init__(self, net: Network):
        self.net = net
        self._forget()

    def _forget(self) -> None:
        self.known = np.empty(0, np.uint64)
        self.means = np.empty((0, len(self.net.languages)), np.float32)

    def _means(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Mean position label of words given as spans; words without a letter get zeros."""
        k = len(self.net.languages)
        sums = np.zeros((len(starts), k), np.float32)
        padded = np.concatenate([[np.uint8(32)], data, [np.uint8(32)]])
        for first in range(0, int(lengths.max(initial=0)) + 2, MAX_BYTES):
            part = np.minimum(lengths + 2 - first, MAX_BYTES)  # the blanks around count
            for n in np.unique(part[part > 0]):
                rows = np.flatnonzero(part == n)
                for a in range(0, len(rows), 2048):
                    some = rows[a:a + 2048]
                    x = padded[(starts[some] + first)[:, None] + np.arange(n)]
                    # neighbours of a word are white space or the next text: read as blanks
                    if first == 0:
                        x[:, 0] = 32
                    x[first + n == lengths[some] + 2, -1] = 32
                    sums[some] += self.net.labels(x).sum(axis=0)
        lettered = np.add.reduceat(_LETTERS[data], starts, dtype=np.int64) if len(starts) else starts
        return np.where((lettered > 0)[:, None], sums / (lengths + 2)[:, None], 0)

    def _rows(self, hashes: np.ndarray, spans: tuple) -> np.ndarray:
        """Row in ``means`` of each word; unknown words are computed and merged in."""
        words, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, words)
        new = np.ones(len(words), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != words[inside]
        if new.any():
            data, starts, lengths = spans
            chosen = np.sort(first[new])  # spans must rise for the sums over letters
            means = self._means(data, starts[chosen], lengths[chosen])
            order = np.argsort(np.concatenate([self.known, hashes[chosen]]), kind="stable")
            self.known = np.concatenate([self.known, hashes[chosen]])[order]
            self.means = np.concatenate([self.means, means])[order]
            at = np.searchsorted(self.known, words)
        return at[back]

    def documents(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and probability of each text, read word by word.

        Every position counts alike: ``POSITIONS`` of them, a usual word and the blanks around
        it, weigh as one observation, so a long run without blanks weighs by its length.
        """
        k = len(self.net.languages)
        pooled = np.zeros((len(texts), k))
        for row, hashes, ends, spans in word_spans(texts):
            if len(self.known) > self.LIMIT:
                self._forget()
            at = self._rows(hashes, spans)
            of = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
            weight = (spans[2] + 2) / self.POSITIONS
            for j in range(k):
                pooled[row:row + len(ends), j] = np.bincount(
                    of, self.means[at, j] * weight, len(ends)) if len(at) else 0
        pooled -= pooled.max(axis=1, keepdims=True)
        prob = np.exp(pooled)
        prob /= prob.sum(axis=1, keepdims=True)
        top = prob.argmax(axis=1)
        lettered = np.array([has_letter(t.as_py()) for t in texts], bool)
        labels = [self.net.languages[t] if has else UNKNOWN for t, has in zip(top, lettered)]
        return labels, np.where(lettered, prob[np.arange(len(texts)), top], 0.0)


def fit(labelled: DataFrame, rows: int = SAMPLE_ROWS, steps: int = STEPS) -> Network | None:
    """Train on the ``rows`` distinct texts of each language with the smallest hashes.

    ``labelled`` has ``text`` and ``lang``; rows where either is null are left out.
    """
    known = labelled.filter("text IS NOT NULL AND lang IS NOT NULL")
    sample = sample_texts(known.select(F.col("lang").alias("label"), "text"), rows)
    return train(sorted((r["text"], r["label"]) for r in sample.collect()), steps)


def identify(docs: DataFrame, net: Network | None, text_col: str = "text",
             out_col: str = "language", batch_bytes: int = 2 << 20) -> DataFrame:
    """All columns of the input with a struct ``out_col`` of label and score.

    Null texts and texts without a letter get ``und`` and score 0, and so does everything
    without a network. A column of that name in the input is replaced. Whole texts are
    read, about ``batch_bytes`` of them at a time.
    """
    at = docs.columns.index(text_col)
    kept = [c for c in docs.columns if c != out_col]
    made_type = T.StructType.fromDDL("label STRING, score DOUBLE")
    schema = T.StructType([*docs.select(*kept).schema, T.StructField(out_col, made_type)])

    @lean
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net) if net is not None else None
        for whole in batches:
            step = max(1, int(whole.num_rows * batch_bytes / max(1, whole.nbytes)))
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                texts = batch.column(at)
                labels, score = (scorer.documents(texts) if scorer is not None and len(texts)
                                 else ([UNKNOWN] * len(texts), np.zeros(len(texts))))
                made = pa.StructArray.from_arrays(
                    [pa.array(labels, pa.string()), pa.array(score, pa.float64())],
                    ["label", "score"])
                columns = [c for c, n in zip(batch.columns, batch.schema.names) if n != out_col]
                yield pa.RecordBatch.from_arrays([*columns, made], names=[*kept, out_col])

    return docs.mapInArrow(label, schema)


def held_out(id_col: str, parts: int, which: int):
    """Whether crc32 of the id as text leaves this remainder; a null id counts as empty text."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(parts)) == which
