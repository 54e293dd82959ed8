import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from terravane.llm import tokenfiles as tf
from terravane.llm.jobs import new_path

from .conftest import ODD

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
LIBRARY.encode_special_tokens = True


def ids_of(texts):
    return [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


@given(st.lists(st.text(" '  \n\tsrtvelab.!1é\x1c\x85\u00a0<|endoftext|>", max_size=40), min_size=1, max_size=6))
@settings(max_examples=150, deadline=None)
def test_pieces_encode_as_the_whole(texts):
    enc = tf.encoder(tf.VOCABULARY)
    ids, at = enc.encode([t.encode() for t in texts])
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == ids_of(texts)


def test_files_round_trip(spark, docs_of):
    texts = [*ODD, "last <|endoftext|> one"]
    docs = docs_of(texts, ids=[5 * i for i in range(len(texts))][::-1])
    uri = new_path(spark, "t")
    manifest = tf.write_tokens(docs, uri)
    rows = tf.read_tokens(manifest, uri).orderBy("start").collect()
    ids = [[*x, 0] for x in ids_of([t or "" for t in texts[::-1]])]
    assert [r.doc_id for r in rows] == [5 * i for i in range(len(texts))]
    assert [r.start for r in rows] == np.cumsum([0, *map(len, ids)])[:-1].tolist()
    assert [r.n_tokens for r in rows] == list(map(len, ids))
    assert [r.ids_crc32 for r in rows] == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids]
    part = manifest.orderBy("part").first()
    stored, offsets, doc_ids = tf.open_tokens(uri, part.name, part.width)
    assert isinstance(stored, np.memmap) and stored.dtype == np.uint16 and len(offsets) == len(doc_ids) + 1


def test_empty_null_and_repeated_ids(spark, docs_of):
    uri = new_path(spark, "t")
    assert tf.read_tokens(tf.write_tokens(docs_of([]), uri), uri).count() == 0
    uri = new_path(spark, "t")
    rows = tf.read_tokens(tf.write_tokens(docs_of(["a", "b", "c"], ids=[None, 3, 3]), uri), uri).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 3, 3]
