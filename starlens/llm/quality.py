"""Document quality by a linear-chain conditional random field over lines.

Each line is labelled good or bad.  Its features are shares of character
classes and of repeated words in the line itself and in its two neighbours;
the chain's transition weights let a line's label lean on the labels beside
it.  Forward-backward gives each line's marginal probability of being good,
and a document's score is the mean of these, weighted by line length.

The field is fitted here: labels are known for documents only, so every line
of a training document carries its document's label.  The fit uses a bounded
sample (``max_documents``, by the hash of the id, and of their sequences at
most ``max_lines`` lines, by the hash of the sequence) and gradient ascent on the
driver over line features alone; scoring reads every whole text on the
executors.  Labels, language, source and id are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_DOCUMENTS = 4000  # labelled documents in the fit
MAX_LINES = 1 << 18  # lines in the fit, 488 bytes of design matrix each
WINDOW = 64  # lines of a training sequence; longer documents give several
STEPS = 120
L2 = 1e-3
CUT = 0.3  # documents scored below are rejected
_LINES = 1 << 14  # lines scored at once, whole documents

# Character classes by byte; 0 is any other sign.
LOWER, UPPER, DIGIT, SPACE, STOP, LOUD, BAR, HIGH = range(1, 9)
_CLASS = np.zeros(256, np.int64)
_CLASS[ord("a") : ord("z") + 1] = LOWER
_CLASS[ord("A") : ord("Z") + 1] = UPPER
_CLASS[ord("0") : ord("9") + 1] = DIGIT
_CLASS[[9, 32]] = SPACE
_CLASS[[ord(c) for c in ".,;:'\"()-?"]] = STOP
_CLASS[ord("!")] = LOUD
_CLASS[ord("|")] = BAR
_CLASS[128:] = HIGH
BASE = 12  # numbers of line_features
WIDTH = 1 + 5 * BASE  # numbers of a line's design row


def lines_of(text: str | None) -> list[str]:
    return (text or "").split("\n")


def line_features(lines: list[str]) -> np.ndarray:
    """(line, BASE): shares of character classes, length, words and their repetition."""
    raw = [x.encode("utf-8", "surrogatepass") for x in lines]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    line = np.repeat(np.arange(len(raw)), size)
    counts = np.bincount(line * 9 + _CLASS[np.frombuffer(b"".join(raw), np.uint8)], minlength=9 * len(raw)).reshape(-1, 9)
    words = [x.split() for x in raw]
    n = np.fromiter(map(len, words), np.float64, len(raw))
    unique = np.fromiter((len(set(w)) for w in words), np.float64, len(raw))
    again = np.fromiter((sum(map(eq, w, w[1:])) for w in words), np.float64, len(raw))
    some, letters = np.maximum(size, 1.0), np.maximum(counts[:, [LOWER, UPPER, HIGH]].sum(1), 1.0)
    shares = [counts[:, c] / some for c in (0, DIGIT, SPACE, STOP, LOUD, BAR, HIGH)]
    return np.stack([
        *shares, counts[:, UPPER] / letters, np.log1p(size), size / np.maximum(n, 1.0),
        unique / np.maximum(n, 1.0), again / np.maximum(n, 1.0)], axis=1)


def design(base: np.ndarray, lengths: np.ndarray, centre: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """(line, WIDTH): a constant; each number of the line, its square and its
    size; the same number of the line before and of the line after."""
    z = np.clip((base - centre) / spread, -4, 4)
    before, after = np.zeros_like(z), np.zeros_like(z)
    before[1:], after[:-1] = z[:-1], z[1:]
    ends = np.cumsum(lengths)
    before[(ends - lengths)[lengths > 0]] = 0
    after[ends[lengths > 0] - 1] = 0
    return np.hstack([np.ones((len(z), 1)), z, z * z / 4, np.abs(z), before, after])


def forward_backward(emit: np.ndarray, lengths: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals P(good) of each line, expected transitions (2, 2) and log Z.

    ``emit`` holds the log-odds of good of the lines of all sequences, one
    after the other; ``turn`` the transition weights [from, to]."""
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = (np.cumsum(lengths) - lengths)[order], lengths[order]
    psi, longest = np.exp(turn), int(sizes[0]) if len(sizes) else 0
    p = 1 / (1 + np.exp(-np.clip(emit, -30, 30)))
    alive = [int(np.searchsorted(-sizes, -t, side="left")) for t in range(longest)]  # sequences longer than t
    alpha = np.zeros((len(emit), 2))
    log_z, prior = float(np.logaddexp(0, emit).sum()), None
    for t in range(longest):
        at = starts[: alive[t]] + t
        a = (prior[: alive[t]] @ psi if t else np.ones((alive[t], 2))) * np.stack([1 - p[at], p[at]], axis=1)
        total = a.sum(1, keepdims=True)
        log_z += float(np.log(total).sum())
        prior = a / total
        alpha[at] = prior
    good, pairs = np.empty(len(emit)), np.zeros((2, 2))
    beta = np.ones((len(sizes), 2))
    for t in reversed(range(longest)):
        at = starts[: alive[t]] + t
        b = beta[: alive[t]]
        joint = alpha[at] * b
        good[at] = joint[:, 1] / joint.sum(1)
        if t:
            seen = np.stack([1 - p[at], p[at]], axis=1) * b
            pair = alpha[at - 1][:, :, None] * psi * seen[:, None, :]
            pairs += (pair / pair.sum((1, 2), keepdims=True)).sum(0)
            back = seen @ psi.T
            beta[: alive[t]] = back / back.sum(1, keepdims=True)
    return good, pairs, log_z


class LineField:
    """A fitted field: weights of the design row, transitions, feature scales."""

    def __init__(self, weights: np.ndarray, turn: np.ndarray, centre: np.ndarray, spread: np.ndarray) -> None:
        self.weights, self.turn, self.centre, self.spread = weights, turn, centre, spread

    @staticmethod
    def fit(base: np.ndarray, lengths: np.ndarray, labels: np.ndarray, steps: int = STEPS, rate: float = 0.1) -> LineField:
        """Adam on the penalised mean log-likelihood of documents cut into
        sequences.  Without both labels in the sample every score is 0.5."""
        if len(np.unique(labels)) < 2:
            return LineField(np.zeros(WIDTH), np.zeros((2, 2)), np.zeros(BASE), np.ones(BASE))
        centre, spread = base.mean(0), np.maximum(base.std(0), 1e-3)
        x = design(base, lengths, centre, spread)
        cut = [(min(WINDOW, n - at), y) for n, y in zip(lengths, labels) for at in range(0, n, WINDOW)]
        sizes, y = np.array([c[0] for c in cut]), np.array([c[1] for c in cut])
        truth = np.repeat(y, sizes).astype(float)
        kept = np.array([[((sizes - 1) * (1 - y)).sum(), 0.0], [0.0, ((sizes - 1) * y).sum()]])
        theta = np.zeros(WIDTH + 4)
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, steps + 1):
            good, pairs, _ = forward_backward(x @ theta[:WIDTH], sizes, theta[WIDTH:].reshape(2, 2))
            up = np.concatenate([x.T @ (truth - good), (kept - pairs).ravel()]) / len(sizes) - L2 * theta
            m, v = 0.9 * m + 0.1 * up, 0.999 * v + 0.001 * up * up
            theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return LineField(theta[:WIDTH], theta[WIDTH:].reshape(2, 2), centre, spread)

    def scores(self, texts: Iterable[str | None]) -> list[float]:
        """Length-weighted mean marginal of each text."""
        out: list[float] = []
        held: list[list[str]] = []
        total = 0
        for lines in map(lines_of, texts):
            held.append(lines)
            total += len(lines)
            if total > _LINES:
                out += self._scores(held)
                held, total = [], 0
        return out + (self._scores(held) if held else [])

    def _scores(self, docs: list[list[str]]) -> list[float]:
        lengths = np.array([len(d) for d in docs])
        flat = [x for d in docs for x in d]
        emit = design(line_features(flat), lengths, self.centre, self.spread) @ self.weights
        good, _, _ = forward_backward(emit, lengths, self.turn)
        weight = np.maximum(np.fromiter(map(len, flat), np.float64, len(flat)), 1e-3)
        starts = np.cumsum(lengths) - lengths
        return (np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts)).tolist()


def held_out(id_: Column) -> Column:
    """Rows that no fit may learn from: a fifth, by the id's checksum."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_documents: int = MAX_DOCUMENTS, max_lines: int = MAX_LINES) -> LineField:
    """Fit on at most ``max_documents`` labelled documents that are not held
    out: the smallest hashes of their ids.  Null labels are ignored; of
    conflicting labels of an id the majority counts (ties: good).  Rows equal
    in id and text are learned once.  Of the documents' sequences of WINDOW
    lines those with the smallest hashes are learned, 4 * ``max_documents`` at
    most and as long as their lines are no more than ``max_lines``; those that
    follow each other in a text stay together."""
    known = (
        labels.select(F.col(id_col).alias("id"), F.col("quality").alias("y")).where("id IS NOT NULL AND y IN (0, 1)")
        .where(~held_out(F.col("id"))).groupBy("id").agg((F.avg("y") >= 0.5).cast("int").alias("y")))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(max_documents)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    rows = rows.join(F.broadcast(sample), "id").distinct().select("y", F.xxhash64("id", "t").alias("h"), "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for y, h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                lines = lines_of(t.as_py())
                for at in range(0, len(lines), _LINES):
                    found = line_features(lines[at : at + _LINES]).astype("<f4")
                    base = [found[k : k + WINDOW].tobytes() for k in range(0, len(found), WINDOW)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([y] * len(base), pa.int32()), pa.array([h] * len(base), pa.int64()),
                        pa.array(range(at // WINDOW, at // WINDOW + len(base)), pa.int64()), pa.array(base, pa.binary())],
                        ["y", "h", "k", "base"])

    pieces = rows.mapInArrow(run, "y int, h long, k long, base binary")
    # A task and the driver hold 4 * max_documents sequences at most.
    got = pieces.orderBy(F.xxhash64("h", "k"), "h", "k", "base").limit(4 * max_documents).collect()
    sizes = np.cumsum([len(r["base"]) // (4 * BASE) for r in got])
    got = sorted(got[: int(np.searchsorted(sizes, max_lines, "right"))], key=lambda r: (r["h"], r["k"], r["base"]))
    runs: list[tuple[list[bytes], int]] = []  # sequences that follow each other in a text, label
    for i, r in enumerate(got):
        if not i or (got[i - 1]["h"], got[i - 1]["k"] + 1) != (r["h"], r["k"]):
            runs.append(([], r["y"]))
        runs[-1][0].append(r["base"])
    if not runs:
        return LineField.fit(np.zeros((0, BASE)), np.zeros(0, int), np.zeros(0))
    raw = sorted((b"".join(parts), y) for parts, y in runs)  # the fit does not hang on the order of tasks
    base = [np.frombuffer(x, "<f4").reshape(-1, BASE) for x, _ in raw]
    return LineField.fit(np.concatenate(base).astype(float), np.array([len(x) for x in base]), np.array([y for _, y in raw]))


def score_quality(docs: DataFrame, field: LineField, keep: list[str], text_col: str = "text") -> DataFrame:
    """(kept, score): one row per input row, ``kept`` being a struct of its
    columns ``keep``.  A null text scores as an empty one, which is a single
    empty line; a very long text is scored whole, line by line; an empty table
    gives no rows."""
    rows = docs.select(F.struct(*keep).alias("kept"), *([] if text_col in keep else [F.col(text_col).cast("string").alias("t")]))
    kind = rows.schema["kept"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(0).field(keep.index(text_col)) if text_col in keep else b.column(1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(field.scores(t.as_py() for t in texts), pa.float64())], ["kept", "score"])

    return rows.mapInArrow(run, f"kept {kind}, score double")


def op4_quality(spark, sf_dir: str) -> DataFrame:
    from starlens.llm.common import table

    docs = table(spark, sf_dir, "documents")
    field = fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = score_quality(docs, field, ["doc_id"])
    return scored.select("kept.doc_id", held_out(F.col("kept.doc_id")).alias("held_out"), "score",
                         (F.col("score") >= CUT).cast("int").alias("predicted"))
