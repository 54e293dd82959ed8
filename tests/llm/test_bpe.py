import base64
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terravane.llm import bpe

from .conftest import ODD


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


ALPHABET = " '  \n\tsrtvelmdab.!?-1²é日\x1c\x85\u00a0🙂_"


@given(st.lists(st.text(ALPHABET, max_size=40), min_size=1, max_size=8))
@settings(max_examples=150, deadline=None)
def test_ids_are_the_librarys(library, texts):
    for text, ids in zip(texts, bpe.merger().encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert bpe.merger().decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["it's", "!'s", " 'll've", "''re", "x\n\n y", "a  ", "'", "'r", "z" * 3000, "ab" * 700 + "!" * 500])
def test_edges_of_the_pattern(library, text):
    assert np.frombuffer(bpe.merger().encode([text.encode()])[0], "<u4").tolist() == library.encode_ordinary(text)


def test_scan_is_the_same_in_blocks_and_in_order():
    automaton, _ = bpe._tables()
    items = np.random.default_rng(1).choice(automaton.generator, 5000)
    assert (automaton.scan(items, 16) == automaton.scan(items, 10_000)).all()


def test_round_trip_of_odd_rows(docs_of, library):
    docs = docs_of(ODD).withColumn("n_tokens", F.lit("clash"))
    rows = {r.doc_id: r for r in bpe.round_trip(docs).collect()}
    assert len(rows) == len(ODD)
    for i, text in enumerate(ODD):
        ids = np.array(library.encode_ordinary(text or ""), "<u4")
        assert (rows[i].n_tokens, rows[i].ids_sha256, rows[i].decoded_sha256) == (len(ids), sha256(ids.tobytes()).hexdigest(), sha256((text or "").encode()).hexdigest())


def test_encode_and_decode_documents(docs_of):
    texts = ["it's a test", "", "été"]
    encoded = bpe.encode_documents(docs_of(texts))
    assert [r.text for r in bpe.decode_documents(encoded).orderBy("doc_id").collect()] == texts
    first = encoded.where("doc_id = 0").first()
    assert first.offsets[0] == 0 and len(first.offsets) == len(first.ids)
    assert bpe.round_trip(docs_of([]).limit(0)).count() == 0


@pytest.mark.parametrize("size", [1, 7, 64, 10_000])
def test_long_texts_by_windows(size):
    m = bpe.merger()
    for text in ("it's a test,  of\nwindows 12 é 日本 — 'll\t \n\n end " * 40, "日本語" * 300, "a" * 500, " " * 400, "x " * 300):
        data = text.encode()
        parts = list(bpe.windows(data, size))
        assert b"".join(parts) == data and all(parts)
        assert m.encode_all([data], size)[0].tolist() == m.encode_all([data], len(data))[0].tolist()
    assert len(list(bpe.windows(b"x " * 300, 64))) > 5
