"""Toxicity: boosted trees over dense features, with isotonic calibration.

Features of a text: how often it holds words of a lexicon (as written, and after letters disguised by digits, symbols, gaps
within the word or repeats are restored), how near these stand to words of the second person, and its rates of capitals,
punctuation, digits and disguise. The lexicon is learnt from the labelled sample: words, and stems at the start of words, that
stand in toxic documents far more often than chance allows.

Fitting uses a bounded sample of labelled rows outside the held-out third. Trees are grown on histograms; scores of each half of the
sample, by a lexicon and trees of the other half, calibrate by isotonic regression. Labels, lang, source and doc_id are never features.

Edge cases: a null text is an empty one and is scored like any text. Without both labels in each half every score is 0. Repeated rows
have equal scores. Of repeated labels of one id the greatest counts; labels of null ids don't.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.llm import textarrays as ta
from terravane.llm.jobs import read_table
from terravane.llm.labelled import in_held_out_third, labelled_sample

#: Rows of the sample that the model is fitted on.
SAMPLE_ROWS = 6000
#: A word or stem is in the lexicon if the toxic documents among those that hold it are this many standard deviations more
#: than the rate of the sample gives, and this share of all toxic ones.
DEVIATIONS, SUPPORT = 6, 0.01
#: Lengths of stems in characters.
STEMS = range(4, 9)
TOXIC_AT = 0.7
NEAR = 6

#: Words of the second person in the languages of the corpus.
SECOND_PERSON = ["you", "your", "yours", "yourself", "u", "ur", "youre", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "tú", "ti", "tus", "usted", "ustedes", "vosotros"]
#: Letters that digits and symbols stand for in disguised words.
DISGUISES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

PLAIN = np.zeros(256, np.uint8)
for _b in range(256):
    PLAIN[_b] = _b if ta.IS_WORD[_b] and not 0x30 <= _b < 0x3A else 0
for _a, _b in DISGUISES.items():
    PLAIN[ord(_a)] = ord(_b)
DISGUISE_BYTES = np.zeros(256, bool)
DISGUISE_BYTES[[ord(c) for c in [*DISGUISES, "*", ".", "-", "_"]]] = True
UPPER = np.zeros(256, bool)
UPPER[0x41:0x5B] = True
ALPHA = np.zeros(256, bool)
ALPHA[0x41:0x5B] = ALPHA[0x61:0x7B] = ALPHA[0x80:] = True
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.sort(ta.Words(words).hashes) if words else np.zeros(0, np.uint64)


def _squeezed(word: bytes) -> bytes:
    """A word as the restoring view has it: disguises replaced, other bytes dropped, repeats merged."""
    out = bytearray()
    for b in word:
        c = PLAIN[ta.LOWER[b]]
        if c and (not out or out[-1] != c):
            out.append(int(c))
    return bytes(out)


def _member(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(hashes), bool)
    return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes


@dataclass
class Lexicon:
    """words; stems, each with its share of toxic documents."""

    words: list[bytes]
    stems: dict[bytes, float]

    def __post_init__(self):
        self.plain = _hashes(self.words)
        self.restored = _hashes([s for s in map(_squeezed, self.words) if len(s) >= 3])
        self.second = _hashes([w.encode() for w in SECOND_PERSON])
        self.lengths = sorted({len(s) for s in self.stems})
        if self.stems:
            # spans and whole words of the same bytes hash alike
            hashes = ta.Words(list(self.stems)).hashes
            order = np.argsort(hashes)
            self.stem_hashes, self.stem_shares = hashes[order], np.array(list(self.stems.values()))[order]
            self.heads = _hashes([s[: self.lengths[0]] for s in self.stems])

    def stem_share(self, words: ta.Words) -> np.ndarray:
        """For each word the largest share among the stems that it starts with, 0 without any."""
        out = np.zeros(len(words.starts))
        if not self.stems:
            return out
        size = words.ends - words.starts
        some = np.flatnonzero(size >= self.lengths[0])
        some = some[_member(words.hash_spans(words.starts[some], words.starts[some] + self.lengths[0]), self.heads)]
        for n in self.lengths:
            some = some[size[some] >= n]
            h = words.hash_spans(words.starts[some], words.starts[some] + n)
            at = np.minimum(np.searchsorted(self.stem_hashes, h), len(self.stem_hashes) - 1)
            out[some] = np.maximum(out[some], np.where(self.stem_hashes[at] == h, self.stem_shares[at], 0))
        return out


FEATURES = ["hits", "hit_rate", "kinds", "restored_hits", "restored_rate", "hits_near_you", "you_rate", "capital_rate", "shouted_rate", "exclaim_rate", "question_rate", "punctuation_rate", "digit_rate", "disguise_rate", "stretched_rate", "stem_share", "stem_rate", "stem_kinds"]


def features(parts: list[bytes], lexicon: Lexicon) -> np.ndarray:
    """(texts, FEATURES) of whole texts."""
    raw = ta.Words(parts, lower=False, is_word=ta.NOT_SPACE, hashed=False)
    words = ta.Words(parts)
    data, n = raw.data, len(parts)
    a, b = raw.text_at[:-1], raw.text_at[1:] - 1
    size = np.maximum(b - a, 1)

    def rate(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return (total[b] - total[a]) / size

    def per_text(flags: np.ndarray, view: ta.Words) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[view.bounds[1:]] - total[view.bounds[:-1]]

    n_words = np.maximum(words.counts(), 1)
    hit, second = _member(words.hashes, lexicon.plain), _member(words.hashes, lexicon.second)
    hits = per_text(hit, words)
    of = np.repeat(np.arange(n), words.counts())
    kinds = np.zeros(n)
    at = np.flatnonzero(hit)
    if len(at):
        seen = np.unique(of[at].astype(np.uint64) * np.uint64(1 << 32) + np.searchsorted(lexicon.plain, words.hashes[at]).astype(np.uint64))
        kinds = np.bincount((seen >> np.uint64(32)).astype(np.int64), minlength=n)
    # hits with a word of the second person within NEAR words of the same text
    near = np.zeros(len(hit), bool)
    you = np.flatnonzero(second)
    if len(you) and len(at):
        i = np.searchsorted(you, at)
        for j in (np.maximum(i - 1, 0), np.minimum(i, len(you) - 1)):
            near[at] |= (np.abs(you[j] - at) <= NEAR) & (of[you[j]] == of[at])
    share = lexicon.stem_share(words)
    total = np.concatenate([[0.0], np.cumsum(share)])
    stem_share = total[words.bounds[1:]] - total[words.bounds[:-1]]
    stemmed = np.flatnonzero(share)
    order = np.lexsort((words.hashes[stemmed], of[stemmed]))
    stemmed = stemmed[order]
    fresh = np.ones(len(stemmed), bool)
    fresh[1:] = (of[stemmed[1:]] != of[stemmed[:-1]]) | (words.hashes[stemmed[1:]] != words.hashes[stemmed[:-1]])
    stem_kinds = np.bincount(of[stemmed[fresh]], minlength=n)
    # the restoring view: white-space tokens with disguises replaced and repeats merged
    plain = PLAIN[ta.LOWER[data]]
    keep = plain != 0
    kept = plain[keep]
    origin = np.flatnonzero(keep)
    token = np.searchsorted(raw.starts, origin, side="right")
    fresh = np.ones(len(kept), bool)
    fresh[1:] = (kept[1:] != kept[:-1]) | (token[1:] != token[:-1])
    kept, token = kept[fresh], token[fresh]
    edges = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.zeros(0, np.int64)
    view = ta.Words([kept.tobytes()], lower=False, hashed=False)
    ends = np.concatenate([edges[1:], [len(kept)]]) if len(edges) else edges
    restored = _member(view.hash_spans(edges + 1, ends + 1), lexicon.restored)
    flags = np.zeros(len(raw.starts), bool)
    if len(edges):
        flags[token[edges] - 1] = restored
    restored_hits = np.maximum(per_text(flags, raw) - hits, 0)
    same = np.zeros(len(data), bool)
    same[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & ALPHA[data[2:]] & (data[2:] < 0x80)
    inside = np.zeros(len(data), bool)
    inside[1:-1] = DISGUISE_BYTES[data[1:-1]] & ALPHA[data[:-2]] & ALPHA[data[2:]]
    caps = np.concatenate([[0], np.cumsum(UPPER[data])])
    shouted = (raw.ends - raw.starts >= 3) & ((caps[raw.ends] - caps[raw.starts]) * 10 >= (raw.ends - raw.starts) * 7)
    letters = rate(ALPHA[data])
    return np.stack(
        [
            np.minimum(hits, 20), hits / n_words, np.minimum(kinds, 20), np.minimum(restored_hits, 20), restored_hits / n_words, np.minimum(per_text(near, words), 20), per_text(second, words) / n_words,
            rate(UPPER[data]) / np.maximum(letters, 1e-9), per_text(shouted, raw) / np.maximum(raw.counts(), 1), rate(data == 0x21), rate(data == 0x3F), rate(PUNCTUATION[data]), rate((data >= 0x30) & (data < 0x3A)), rate(inside), rate(same),
            np.minimum(stem_share, 20), stem_share / n_words, np.minimum(stem_kinds, 20),
        ],
        axis=1,
    ).astype(np.float64)


class Trees:
    """Gradient-boosted regression trees for logistic loss, on quantile histograms."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 32, least: int = 10, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.least, self.ridge = rounds, depth, rate, bins, least, ridge

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(self.cuts)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        quantiles = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.cuts = [np.unique(np.concatenate([np.quantile(c, quantiles), np.quantile(c[c > 0], quantiles[::4]) if (c > 0).any() else c[:0]])) for c in x.T]
        z = self._binned(x)
        self.base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        f = np.full(len(y), self.base)
        self.trees = []
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-f))
            tree = self._grow(z, y - p, p * (1 - p))
            self.trees.append(tree)
            f += self._walk(tree, z)
        return self

    def _grow(self, z: np.ndarray, g: np.ndarray, h: np.ndarray) -> list[tuple]:
        """Nodes in heap order: (feature, cut) or (value,)."""
        tree: list = [None] * (2 ** (self.depth + 1) - 1)
        rows = {0: np.arange(len(g))}
        for node in range(len(tree)):
            own = rows.pop(node, None)
            if own is None:
                continue
            best = (1e-9, None)
            if node < 2**self.depth - 1 and len(own) >= 2 * self.least:
                whole = g[own].sum() ** 2 / (h[own].sum() + self.ridge)
                for j, cuts in enumerate(self.cuts):
                    m = len(cuts) + 1
                    sums = [np.cumsum(np.bincount(z[own, j], w, m))[:-1] for w in (g[own], h[own], None)]
                    gl, hl, nl = sums
                    gr, hr, nr = g[own].sum() - gl, h[own].sum() - hl, len(own) - nl
                    gain = np.where((nl >= self.least) & (nr >= self.least), gl**2 / (hl + self.ridge) + gr**2 / (hr + self.ridge) - whole, -1)
                    if len(gain) and gain.max() > best[0]:
                        best = (float(gain.max()), (j, int(gain.argmax())))
            if best[1] is None:
                tree[node] = (self.rate * float(g[own].sum() / (h[own].sum() + self.ridge)),)
            else:
                j, cut = tree[node] = best[1]
                left = z[own, j] <= cut
                rows[2 * node + 1], rows[2 * node + 2] = own[left], own[~left]
        return tree

    def _walk(self, tree: list, z: np.ndarray) -> np.ndarray:
        at = np.zeros(len(z), np.int64)
        out = np.zeros(len(z))
        for node, item in enumerate(tree):
            if item is None:
                continue
            here = at == node
            if len(item) == 1:
                out[here] = item[0]
            else:
                at[here] = 2 * node + 1 + (z[here, item[0]] > item[1])
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = self._binned(x)
        return self.base + sum((self._walk(t, z) for t in self.trees), np.zeros(len(x)))


def isotonic(scores: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing step fit of labels to scores, by pooling adjacent violators."""
    x, at = np.unique(scores, return_inverse=True)
    weight, total = np.bincount(at).astype(float), np.bincount(at, labels)
    blocks: list[list[float]] = []
    for i in range(len(x)):
        blocks.append([x[i], x[i], total[i], weight[i]])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            last = blocks.pop()
            blocks[-1][1:] = [last[1], blocks[-1][2] + last[2], blocks[-1][3] + last[3]]
    knots = [(edge, t / w) for low, high, t, w in blocks for edge in ((low, high) if high > low else (low,))]
    return np.array([k for k, _ in knots]), np.array([v for _, v in knots])


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees
    knots: tuple[np.ndarray, np.ndarray]

    def scores(self, parts: list[bytes]) -> np.ndarray:
        return np.clip(np.interp(self.trees.scores(features(parts, self.lexicon)), *self.knots), 0, 1)


def fit(x: list[np.ndarray], y: np.ndarray, fold: np.ndarray, lexicons: list[Lexicon]) -> Model:
    """x: features of all rows by the lexicon of all, of the rows of fold 0, and of those of fold 1."""
    out = np.zeros(len(y))
    for other in (0, 1):
        learnt, rest = fold == other, fold != other
        out[rest] = Trees().fit(x[1 + other][learnt], y[learnt]).scores(x[1 + other][rest])
    return Model(lexicons[0], Trees().fit(x[0], y), isotonic(out, y))


def _fold(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(2)).cast("int")


def learn_lexicons(sample: DataFrame) -> list[Lexicon]:
    """Words and stems by their share of toxic documents; every distinct one counts once for a document.

    The lexicon of the whole sample, and those of its rows in fold 0 and in fold 1. What is collected was in SUPPORT of the toxic rows.
    """
    parts = [F.lit(True), F.col("fold") == 0, F.col("fold") == 1]
    sums = [f for k, part in enumerate(parts) for f in (F.sum(F.when(part, F.col("label")).otherwise(0)).alias(f"toxic_{k}"), F.sum(part.cast("long")).alias(f"n_{k}"))]
    whole = sample.select("label", _fold().alias("fold")).agg(*sums).first()
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = sample.select("doc_id", "label", _fold().alias("fold"), F.explode(F.array_distinct(F.regexp_extract_all(lowered, F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0)))).alias("word"))
    cut = F.filter(F.array(*[F.when(F.length("word") >= k, F.substring("word", 1, k)) for k in STEMS]), lambda s: s.isNotNull())
    own = ("doc_id", "label", "fold")
    terms = words.select(*own, F.lit(False).alias("stem"), F.col("word").alias("term")).union(words.select(*own, F.lit(True), F.explode(cut)).distinct())
    counted = terms.where(F.length("term") >= 3).groupBy("stem", "term").agg(*sums)
    chosen = []
    for k in range(len(parts)):
        n, toxic = whole[f"n_{k}"] or 0, whole[f"toxic_{k}"] or 0
        rate = toxic / max(n, 1)
        spread = F.sqrt(F.col(f"n_{k}") * rate * (1 - rate))
        chosen.append((F.col(f"toxic_{k}") >= max(3, SUPPORT * toxic)) & (F.col(f"toxic_{k}") - F.col(f"n_{k}") * rate >= DEVIATIONS * spread) if 0 < toxic < n else F.lit(False))
    rows = counted.select("*", *[c.alias(f"in_{k}") for k, c in enumerate(chosen)]).where(chosen[0] | chosen[1] | chosen[2]).orderBy("term").collect()
    out = []
    for k in range(len(parts)):
        found = [r for r in rows if r[f"in_{k}"]]
        out.append(Lexicon([r.term.encode() for r in found if not r.stem], {r.term.encode(): r[f"toxic_{k}"] / r[f"n_{k}"] for r in found if r.stem}))
    return out


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model | None:
    """The model, from at most `rows` labelled documents outside the held-out third; None without both labels in each half."""
    sample = labelled_sample(docs, labels, "toxic", rows, ~in_held_out_third())
    lexicons = learn_lexicons(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ta.slices(batches):
            parts = ta.pieces(batch.column(1))
            x = [pa.array(list(features(parts, lexicon)), pa.list_(pa.float64())) for lexicon in lexicons]
            yield pa.record_batch([batch.column(0), batch.column(2), batch.column(3), *x], names=["doc_id", "label", "fold", "x_0", "x_1", "x_2"])

    schema = "doc_id long, label int, fold int, x_0 array<double>, x_1 array<double>, x_2 array<double>"
    table = sample.select("doc_id", "text", "label", _fold().alias("fold")).mapInArrow(run, schema).toArrow().sort_by("doc_id")
    y, fold = table.column("label").to_numpy().astype(float), table.column("fold").to_numpy()
    if min([((y == label) & (fold == half)).sum() for label in (0, 1) for half in (0, 1)]) < 2:
        return None
    return fit([np.array(table.column(f"x_{k}").to_pylist()) for k in range(3)], y, fold, lexicons)


def score(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ta.slices(batches):
            s = np.zeros(batch.num_rows) if model is None else model.scores(ta.pieces(batch.column(1)))
            yield pa.record_batch([batch.column(0), pa.array(s), pa.array((s >= TOXIC_AT).astype(np.int32))], names=["doc_id", "score", "predicted"])

    scored = docs.select(F.col("doc_id").cast("long"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", in_held_out_third().alias("held_out"), "score", "predicted")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    docs = read_table(spark, sf_dir, "documents")
    return score(docs, train(docs, read_table(spark, sf_dir, "labels")))
