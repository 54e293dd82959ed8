import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from terravane.llm import dartminhash, neardup
from terravane.llm import textarrays as ta
from terravane.llm.components import components

from .conftest import ODD


def shingles(text):
    """The shingles of a text, each with the number of its occurrence."""
    w = [x for x in "".join(c if c.isalnum() else " " for c in text.lower()).split()]
    found = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])
    return {(s, k) for s, n in found.items() for k in range(n)}


def classes_by_brute_force(texts):
    up = list(range(len(texts)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    sets = [shingles(t or "") for t in texts]
    for i, j in combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            a, b = top(i), top(j)
            up[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(texts))]


@pytest.fixture
def corpus(words):
    """Texts, copies, and near copies at many distances, chains of them too."""
    rng, texts = random.Random(4), []
    for k in range(12):
        base = words(120, k)
        texts.append(" ".join(base))
        for _ in range(12):
            own = list(base)
            for at in rng.sample(range(len(own)), rng.randint(0, 6)):
                own[at] = f"x{rng.randint(0, 999)}"
            texts.append(" ".join(own))
            if rng.random() < 0.3:
                base = own
    rng.shuffle(texts)
    looped = words(30, 77)
    texts += [" ".join(looped * 6), " ".join(looped * 6 + looped[:9]), " ".join(looped), " ".join(looped * 6)]
    return texts + ["one two", "One, two!", "one two three"]


def test_classes_equal_brute_force(docs_of, corpus):
    found = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs_of(corpus)).collect()}
    assert [found[i] for i in range(len(corpus))] == classes_by_brute_force(corpus)


def test_odd_rows(docs_of):
    found = {r.doc_id: r for r in neardup.near_duplicates(docs_of(ODD).withColumn("class_id", F.lit("clash"))).collect()}
    assert [found[i].class_id for i in range(len(ODD))] == [0, 1, 2, 3, 4, 5, 5, 7, 8, 9, 10]
    assert found[6].n_copies == 2
    assert neardup.near_duplicates(docs_of([])).count() == 0


def test_one_stays(docs_of):
    docs = docs_of(["a b c d e f", "A b c d e f.", None, "", "g h i j k"]).withColumn("node", F.lit(1)).withColumn("kept_id", F.lit("clash")).withColumn("row_at", F.lit(7))
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3, 4]
    assert neardup.keep_one(docs_of([])).count() == 0


def test_one_of_each_class_with_repeated_and_null_ids(docs_of, spark):
    """Against brute force over the classes of the texts."""
    a, b, c = "alpha beta gamma delta epsilon zeta eta", "one two three four five six", "red green blue cyan pink"
    rows = [(1, a), (1, a), (1, b), (0, b), (None, b), (5, c), (None, c), (None, "lone"), (None, "lone"), (None, None), (None, None), (0, a + "!"), (0, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], docs_of([]).schema)
    best = {}
    for i, t in rows:
        key = tuple(sorted(shingles(t or ""))) or None
        if key:
            best[key] = min(best.get(key, (True, 0)), (i is None, i or 0))
    kept = sorted(((r.doc_id is None, r.doc_id or 0), (r.text or "").rstrip("!")) for r in neardup.keep_one(docs).collect())
    assert len(kept) == len(best) + 3
    assert sorted(k for k, t in kept if t) == sorted(best.values())


@pytest.mark.parametrize("rows", [1, 5])
def test_keep_one_equals_classes(docs_of, corpus, rows):
    """One row of each class of brute force, the least id, when every row stands `rows` times."""
    kept = [r.doc_id for r in neardup.keep_one(docs_of(corpus * rows, ids=list(range(len(corpus))) * rows)).collect()]
    assert sorted(kept) == sorted(set(classes_by_brute_force(corpus)))


def test_recall_on_documents(spark):
    """Of all pairs of documents of a similarity of 0.8 or more, by weighted and by plain sets, those found in one class."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, shingles(r.text or "")) for r in docs.select("doc_id", "text").collect()]
    rows = [(i, x, {s for s, _ in x}) for i, x in rows if x]
    found = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
    alike = lambda x, y: 0.8 * len(x) <= len(y) <= 1.25 * len(x) and len(x & y) >= 0.8 * len(x | y)
    links = [[(a[0], b[0]) for a, b in combinations(rows, 2) if alike(a[k], b[k])] for k in (1, 2)]
    recall = [sum(found[i] == found[j] for i, j in own) / len(own) for own in links]
    print("pairs and recall, weighted and plain:", [len(own) for own in links], recall)
    assert recall[0] == 1 and recall[1] > 0.9


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(0)
    shared, own = ta.seeds(60, 1), [ta.seeds(40, 2), ta.seeds(40, 3)]
    weights = rng.integers(1, 6, 60).astype(float)
    agree = []
    for trial in range(40):
        turn = ta.seeds(1, 100 + trial)[0]
        hashes = np.concatenate([ta.mix(shared ^ turn), ta.mix(own[0] ^ turn), ta.mix(shared ^ turn), ta.mix(own[1] ^ turn)])
        w = np.concatenate([weights, np.ones(40), weights, np.ones(40)])
        a, b = dartminhash.signatures(hashes, np.array([0, 100, 200]), 128, w)
        agree.append((a == b).mean())
    assert abs(np.mean(agree) - weights.sum() / (weights.sum() + 80)) < 0.02


def test_signatures_ignore_order_and_how_far_was_thrown():
    h = ta.seeds(50, 9)
    both = np.concatenate([h, h[::-1], h[:1]])
    sig = dartminhash.signatures(both, np.array([0, 50, 100, 101, 101]), 64)
    assert (sig[0] == sig[1]).all() and (sig[:3] > 0).all() and (sig[3] == 0).all()


def test_components(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 200), (None, 3)]
    cycle = [(300 + i, 300 + (i + 1) % 9) for i in range(9)]
    found = {r.node: r.label for r in components(spark.createDataFrame(path + cycle, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 200: 200, **dict.fromkeys(range(300, 309), 300)}


def test_tiles_lose_no_link(spark, words):
    """A large bucket whose members are chained: the tiles join what brute force joins."""
    base = words(100, 3)
    texts = [" ".join([*base[: i // 4], *(f"z{j}" for j in range(i // 4)), *base[i // 4 :]]) for i in range(60)]
    sets = []
    for t in texts:
        hashes, _, counts, _ = neardup.shingle_sets([t.encode()])
        sets.append(neardup.expanded(hashes, counts))
    hits = neardup.set_hits(sets, sets)
    want = np.array([[len(shingles(a) & shingles(b)) >= 0.8 * len(shingles(a) | shingles(b)) for b in texts] for a in texts])
    assert (hits == want).all()
