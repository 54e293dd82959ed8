import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terravane.llm import toxicity as tox
from terravane.llm.labelled import labelled_sample

from .conftest import ODD


def test_held_out(spark):
    path = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    rows = tox.op1_toxicity(spark, path)
    assert rows.count() == docs.count()
    held = rows.join(labels, "doc_id").where("held_out").toPandas()
    toxic, clean = held[held.toxic == 1], held[held.toxic == 0]
    assert (toxic.predicted == 1).mean() > 0.85 and (clean.predicted == 1).mean() < 0.01
    assert held.score.between(0, 1).all() and ((held.score >= 0.7) == (held.predicted == 1)).all()


LEXICON = tox.Lexicon([b"idiot", b"stupid"], {"réeux".encode(): 0.5})


def test_features_see_disguises():
    texts = ["you are an idiot", "you are an 1d10t", "s.t.u.p.i.d stuuupid", "all fine here", "", "réeuxon réeuxan mot", "IDIOT!!"]
    x = tox.features([t.encode() for t in texts], LEXICON)
    f = {n: x[:, i] for i, n in enumerate(tox.FEATURES)}
    assert f["hits"].tolist() == [1, 0, 0, 0, 0, 0, 1]
    assert f["restored_hits"].tolist() == [0, 1, 2, 0, 0, 0, 0]
    assert f["hits_near_you"].tolist() == [1, 0, 0, 0, 0, 0, 0]
    assert f["stem_kinds"].tolist() == [0, 0, 0, 0, 0, 2, 0] and f["shouted_rate"][6] == 1


def test_trees_and_isotonic():
    rng = np.random.default_rng(2)
    x = rng.random((600, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    trees = tox.Trees().fit(x[:400], y[:400])
    assert ((trees.scores(x[400:]) > 0) == y[400:]).mean() > 0.9
    knots, values = tox.isotonic(np.array([1.0, 2, 3, 4, 5]), np.array([0.0, 1, 0, 1, 1]))
    assert (np.diff(values) >= 0).all() and values[0] == 0 and values[-1] == 1


def test_odd_rows(docs_of, spark):
    rows = tox.score(docs_of(ODD).withColumn("score", F.lit("clash")), None).collect()
    assert len(rows) == len(ODD) and all(r.score == 0 and r.predicted == 0 for r in rows)
    tox.features([(t or "").encode() for t in ODD], LEXICON)
    assert tox.train(docs_of(["a"]), spark.createDataFrame([], "doc_id long, toxic int")) is None
    assert tox.score(docs_of([]), None).count() == 0


def plain_features(text, lexicon):
    """The features of one text, character by character and word by word."""
    data = text.encode()
    low = bytes(b + 32 if 65 <= b < 91 else b for b in data)
    words = re.findall(rb"[0-9a-z\x80-\xff]+", low)
    tokens = re.findall(rb"[^\x20\x09-\x0d]+", data)
    size, n = max(len(data), 1), max(len(words), 1)
    hits = [w in lexicon.words for w in words]
    second = [w.decode(errors="ignore") in tox.SECOND_PERSON for w in words]
    known = {tox._squeezed(w) for w in lexicon.words} - {s for s in map(tox._squeezed, lexicon.words) if len(s) < 3}
    restored = max(sum(tox._squeezed(t) in known for t in tokens) - sum(hits), 0)
    near = sum(h and any(second[max(0, i - tox.NEAR) : i + tox.NEAR + 1]) for i, h in enumerate(hits))
    share = [max([s for stem, s in lexicon.stems.items() if w.startswith(stem)], default=0) for w in words]
    letters = sum(65 <= b < 91 or 97 <= b < 123 or b >= 128 for b in data) / size
    upper = lambda t: sum(65 <= b < 91 for b in t)
    alpha = lambda b: 65 <= b < 91 or 97 <= b < 123 or b >= 128
    inside = sum(bool(tox.DISGUISE_BYTES[data[i]]) and alpha(data[i - 1]) and alpha(data[i + 1]) for i in range(1, len(data) - 1))
    same = sum(data[i] == data[i - 1] == data[i - 2] and alpha(data[i]) and data[i] < 128 for i in range(2, len(data)))
    cap = lambda x: min(x, 20)
    return [
        cap(sum(hits)), sum(hits) / n, cap(len({w for w, h in zip(words, hits) if h})), cap(restored), restored / n, cap(near), sum(second) / n,
        upper(data) / size / max(letters, 1e-9), sum(len(t) >= 3 and upper(t) * 10 >= len(t) * 7 for t in tokens) / max(len(tokens), 1), data.count(b"!") / size, data.count(b"?") / size,
        sum(bool(tox.PUNCTUATION[b]) for b in data) / size, sum(48 <= b < 58 for b in data) / size, inside / size, same / size, cap(sum(share)), sum(share) / n, cap(len({w for w, s in zip(words, share) if s})),
    ]


@given(st.lists(st.text("idot1stup. !A?you réeuxn-\n0@", max_size=40), min_size=1, max_size=4))
@settings(max_examples=200, deadline=None)
def test_features_equal_brute_force(texts):
    texts = [*texts, "you IDIOT, id10t réeuxn", ""]
    found = tox.features([t.encode() for t in texts], LEXICON)
    assert np.allclose(found, [plain_features(t, LEXICON) for t in texts])


def test_repeated_labels_and_null_ids(docs_of, spark):
    docs = docs_of(["a b", "a b", "c", None], ids=[1, 1, None, 2])
    labels = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (2, None)], "doc_id long, toxic int")
    sample = labelled_sample(docs, labels, "toxic", 10)
    assert [(r.doc_id, r.label) for r in sample.collect()] == [(1, 1)]
    assert tox.score(docs, tox.train(docs, labels)).count() == 4
