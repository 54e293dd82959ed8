"""Quality rules: base counts, and a calibrated classifier over hashed word and character n-grams.

Features are the relative frequencies of words, word pairs and runs of 3 and 4 characters, each hashed to one of 2**18 weights, so
a score is four mean weights and a bias. The weights are fitted by AdaGrad on a sample of labelled rows, bounded in rows and bytes;
a quarter of the sample is held back to fit the sigmoid that makes scores probabilities. Thresholds are fixed.

Edge cases: a null text is an empty one: no words, all counts 0, base_failed. Without labels of both kinds there is no
classifier: every probability is 1 and the base rules alone decide. Repeated rows are judged alike, each by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.llm import textarrays as ta
from terravane.llm.jobs import give_back, read_table, with_columns_of
from terravane.llm.labelled import bounded, labelled_sample

BITS = 18
#: Rows of the sample that the classifier is fitted on, and bytes of their texts: these come to the driver.
SAMPLE_ROWS = 2500
SAMPLE_BYTES = 24 << 20
#: A document goes if its probability of good quality is below this.
KEEP_AT = 0.2
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
GRAM_PLACES = ta.seeds(4, 23) | np.uint64(1)
TO_BIN = np.uint64(64 - BITS)
ODD = np.uint64(ta.BASE)


def _between(totals: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return totals[b] - totals[a]


def _running(values: np.ndarray, kind=np.int64) -> np.ndarray:
    return np.concatenate([np.zeros(1, kind), np.cumsum(values, dtype=kind)])


class Grams:
    """Bins of the four kinds of features of texts, with the bounds of each text."""

    def __init__(self, words: ta.Words):
        with np.errstate(over="ignore"):
            hashes, data = words.hashes, words.data
            self.kinds = [((hashes * ODD) >> TO_BIN, words.bounds[:-1], words.bounds[1:])]
            pairs = ta.mix(hashes[:-1] * np.uint64(3) + hashes[1:]) >> TO_BIN
            self.kinds.append((pairs, words.bounds[:-1], np.maximum(words.bounds[1:] - 1, words.bounds[:-1])))
            heads = np.flatnonzero((data & 0xC0) != 0x80)  # of characters; the zero bytes between texts are some
            points = ta.span_hashes(data, heads, np.append(heads[1:], len(data)))
            starts, ends = np.searchsorted(heads, words.text_at[:-1]), np.searchsorted(heads, words.text_at[1:] - 1)
            rolled = sum((points[k : len(points) - 2 + k] * GRAM_PLACES[k] for k in range(3)), np.zeros(max(0, len(points) - 2), np.uint64))
            self.kinds.append((ta.mix(rolled) >> TO_BIN, starts, np.maximum(ends - 2, starts)))
            longer = rolled[:-1] + points[3:] * GRAM_PLACES[3] if len(points) > 3 else np.zeros(0, np.uint64)
            self.kinds.append((ta.mix(longer) >> TO_BIN, starts, np.maximum(ends - 3, starts)))

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """The sum over kinds of the mean weight of a text's features."""
        out = 0.0
        for bins, a, b in self.kinds:
            totals = _running(weights[bins.astype(np.int64)], np.float64)
            last = len(totals) - 1
            a, b = np.minimum(a, last), np.minimum(b, last)
            out = out + _between(totals, a, b) / np.maximum(b - a, 1)
        return out

    def rows(self, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Distinct bins and values of each text."""
        out = []
        for i in range(n):
            bins = [k[a[i] : max(a[i], min(b[i], len(k)))] for k, a, b in self.kinds]
            values = np.concatenate([np.full(len(x), 1 / max(1, len(x))) for x in bins])
            distinct, at = np.unique(np.concatenate(bins).astype(np.int64), return_inverse=True)
            out.append((distinct.astype(np.int32), np.bincount(at, values, len(distinct))))
        return out


Row = tuple[np.ndarray, np.ndarray]


def rows_of(parts: list[bytes]) -> list[Row]:
    return Grams(ta.Words(parts, lower=False, is_word=ta.NOT_SPACE)).rows(len(parts))


def fit(rows: list[Row], labels: np.ndarray, epochs: int = 12, rate: float = 2.0, ridge: float = 1e-6) -> tuple[np.ndarray, float, float]:
    """(weights, a, b): the probability of label 1 is sigmoid(a * score + b). rows: distinct bins and values of each text."""
    held = np.arange(len(rows)) % 4 == 3
    train = np.flatnonzero(~held)
    weights, squares, bias, bias_squares = np.zeros(1 << BITS), np.full(1 << BITS, 1e-6), 0.0, 1e-6
    rng = np.random.default_rng(5)
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(train), max(1, len(train) // 32)):
            bins, values = np.concatenate([rows[i][0] for i in part]), np.concatenate([rows[i][1] for i in part])
            of = np.repeat(np.arange(len(part)), [len(rows[i][0]) for i in part])
            slope = 1 / (1 + np.exp(-np.clip(np.bincount(of, weights[bins] * values, len(part)) + bias, -30, 30))) - labels[part]
            steps = np.bincount(bins, values * slope[of], 1 << BITS) / len(part)
            at = np.flatnonzero(steps)
            steps = steps[at] + ridge * weights[at]
            squares[at] += steps**2
            weights[at] -= rate * 0.1 * steps / np.sqrt(squares[at])
            step = slope.mean()
            bias_squares += step**2
            bias -= rate * 0.1 * step / np.sqrt(bias_squares)
    back = np.flatnonzero(held)
    scores = np.array([weights[rows[i][0]] @ rows[i][1] for i in back]) + bias
    a, b = platt(scores, labels[back])
    return weights.astype(np.float32), a, a * bias + b


def platt(scores: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of the sigmoid of best likelihood, with smoothed targets, by Newton steps."""
    good = labels.sum()
    targets = np.where(labels == 1, (good + 1) / (good + 2), 1 / (len(labels) - good + 2))
    x = np.stack([scores, np.ones_like(scores)], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - targets) + 1e-3 * (w - np.array([1.0, 0.0])))
        w = w - np.clip(step, -1, 1)
    return float(w[0]), float(w[1])


def counts(words: ta.Words) -> dict[str, np.ndarray]:
    """The base counts of each text; words are split at ASCII white space."""
    n, data, texts = words.counts(), words.data, len(words.bounds) - 1
    starts, ends = words.text_at[:-1], words.text_at[1:] - 1
    head = (data & 0xC0) != 0x80
    out = {"n_words": n, "word_chars": _between(_running(head & ta.NOT_SPACE[data]), starts, ends), "n_symbols": _between(_running(SYMBOLS[data]), starts, ends)}
    salt = ta.seeds(texts, 31)
    with np.errstate(over="ignore"):
        # lines: what separators and line feeds leave, all but those without a word
        breaks = np.flatnonzero(data == 0x0A)
        cuts = np.union1d(breaks, words.text_at - 1)
        a, b = cuts[:-1] + 1, cuts[1:]
        full = np.searchsorted(words.starts, b) > np.searchsorted(words.starts, a)
        a, b = a[full], b[full]
        of = np.searchsorted(words.text_at, a, side="right") - 1
        first = np.unique(words.hash_spans(a, b) + salt[of], return_index=True)[1]
        out["n_dup_lines"] = np.bincount(of, minlength=texts) - np.bincount(of[first], minlength=texts)
        h = words.hashes
        covered = np.zeros(len(h) + 2, bool)
        if len(h) >= 3:
            of = np.repeat(np.arange(texts), n)
            windows = np.flatnonzero(of[2:] == of[:-2])
            keys = ta.mix(h[windows] * np.uint64(5) + h[windows + 1]) * np.uint64(3) + h[windows + 2] + salt[of[windows]]
            _, at, times = np.unique(keys, return_inverse=True, return_counts=True)
            twice = windows[times[at] > 1]
            covered[twice] = covered[twice + 1] = covered[twice + 2] = True
        out["n_repeat_words"] = _between(_running(covered), words.bounds[:-1], words.bounds[1:])
    return out


Model = tuple[np.ndarray, float, float]


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model | None:
    """The classifier, from at most `rows` labelled documents; None without labels of both kinds."""
    sample = bounded(labelled_sample(docs, labels, "quality", rows), SAMPLE_BYTES).toArrow().sort_by("doc_id")
    y = sample.column("label").to_numpy()
    if len(y) < 8 or min((y == 0).sum(), (y == 1).sum()) < 2:
        return None
    parts = ta.pieces(sample.column("text"))
    model = fit([row for i in range(0, len(parts), 64) for row in rows_of(parts[i : i + 64])], y)
    del sample, parts
    give_back()
    return model


def judge(docs: DataFrame, model: Model | None, text: str = "text", keep_at: float = KEEP_AT) -> DataFrame:
    """Counts, base_failed, probability and kept for each document, next to doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ta.slices(batches):
            found, p = verdicts(ta.pieces(batch.column(1)), model)
            failed = (found["n_words"] < MIN_WORDS) | (100 * found["n_repeat_words"] > MAX_REPEAT_PERCENT * found["n_words"])
            yield pa.record_batch([batch.column(0), *[pa.array(x.astype(np.int64)) for x in found.values()], pa.array(failed), pa.array(~failed & (p >= keep_at)), pa.array(p)], names=["doc_id", *found, "base_failed", "kept", "probability"])

    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, probability double"
    return docs.select(F.col("doc_id").cast("long"), F.col(text).alias("text")).mapInArrow(run, schema)


def verdicts(parts: list[bytes], model: Model | None) -> tuple[dict[str, np.ndarray], np.ndarray]:
    words = ta.Words(parts, lower=False, is_word=ta.NOT_SPACE)
    if model is None:
        return counts(words), np.ones(len(parts))
    weights, a, b = model
    return counts(words), 1 / (1 + np.exp(-np.clip(a * Grams(words).scores(weights) + b, -30, 30)))


def keep_good(docs: DataFrame, model: Model | None, keep_at: float = KEEP_AT) -> DataFrame:
    """The rows of docs, all columns as they are, that the rules keep."""
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ta.slices(batches):
            found, p = verdicts(ta.pieces(batch.column(at)), model)
            failed = (found["n_words"] < MIN_WORDS) | (100 * found["n_repeat_words"] > MAX_REPEAT_PERCENT * found["n_words"])
            yield batch.filter(pa.array(~failed & (p >= keep_at)))

    return with_columns_of(docs.mapInArrow(run, docs.schema), docs)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict for every document."""
    docs = read_table(spark, sf_dir, "documents")
    return judge(docs, train(docs, read_table(spark, sf_dir, "labels")))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rules keep; labels come from the table beside documents."""
    return keep_good(docs, train(docs, read_table(spark, sf_dir, "labels")))
