"""Token-id files: flat unsigned integers, with 64-bit document offsets beside them, to be memory-mapped.

Documents are range-partitioned and sorted by doc_id. Each task writes three raw little-endian files: NAME.ids (unsigned 16-bit
integers if the vocabulary allows, else 32-bit), NAME.offsets (64-bit, one more than documents, counted in ids from the start
of the file) and NAME.docs (64-bit doc_ids). A manifest table names the files of the tasks that were committed, with their
counts; a file left by a lost task is in no manifest. Prefix sums over the manifest give each file's base in the whole.

A text is encoded by the library in pieces: no pre-token spans the step from a character that isn't white space to a space or line
feed, or from an ASCII letter to an ASCII character that is none, so pieces cut there encode alone as they do in place, and repeated
pieces come from a bounded cache. New pieces are encoded many to a string, for the same reason; the lengths of the tokens tell
where each ends. A text with other white space is encoded in one piece.

Edge cases: a null text is an empty one and has the end id alone. A null doc_id sorts first. Repeated doc_ids are documents of their
own, in the order of a hash of their text, so a hot id is dealt to many tasks; rows that are equal in both are dealt by chance, and as
they have the same ids, the files are the same whatever their order.
"""

from __future__ import annotations

import functools
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terravane.llm import textarrays as ta
from terravane.llm.jobs import new_path, read_table, stored
from terravane.llm.slicecache import LONGEST, SliceCache

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0
#: Stands for a null doc_id in NAME.docs.
NULL_ID = -(1 << 63)
OTHER_SPACE = re.compile(r"[^\S \n]|[\x1c-\x1f\x85]")
#: Bytes of other ASCII white space, and first bytes of all other characters that are white space.
SUSPECT = np.zeros(256, bool)
SUSPECT[[*range(0x09, 0x0E), *range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3]] = True
SUSPECT[0x0A] = False
SPACE, LETTER, VISIBLE, SIGN = (np.zeros(256, bool) for _ in range(4))
SPACE[[0x20, 0x0A]] = True
LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = True
VISIBLE[0x21:0x7F] = VISIBLE[0x80:] = True
SIGN[0x21:0x7F] = ~LETTER[0x21:0x7F]
#: Distinct pieces that a process keeps with their ids.
PIECES = 1 << 20


class Encoder:
    def __init__(self, path: str, cached: int = PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        vocabulary = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.sizes[i] = len(token)  # a character of a token stands for a byte
        self.cache = SliceCache(self._pieces, self.dtype, cached)

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, pieces: list[bytes], group: int = 2048) -> list[bytes]:
        """Ids of pieces; those that begin with white space and end with another character are joined to long strings first."""
        out = [b""] * len(pieces)
        inner = [i for i, p in enumerate(pieces) if p[0] in b" \n" and p[-1] not in b" \n" and len(p) <= LONGEST]
        rest = sorted(set(range(len(pieces))).difference(inner))
        for i, ids in zip(rest, self._library([pieces[i].decode() for i in rest])):
            out[i] = ids
        groups = [inner[i : i + group] for i in range(0, len(inner), group)]
        for own, found in zip(groups, self.tokenizer.encode_batch_fast([b"".join([pieces[i] for i in g]).decode() for g in groups], add_special_tokens=False)):
            ids = np.array(found.ids, self.dtype)
            ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(pieces[i]) for i in own]), side="right").tolist()
            data, width = ids.tobytes(), self.dtype.itemsize
            for i, a, b in zip(own, [0, *ends], ends):
                out[i] = data[a * width : b * width]
        return out

    def encode(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the bounds of each text's."""
        bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))])
        odd = self._has_other_space(parts, bounds)
        if odd.any():
            return self._mixed(parts, odd)
        data = b"".join(parts)
        raw = np.frombuffer(data, np.uint8)
        left, right = raw[:-1], raw[1:]
        begins = np.zeros(len(raw) + 1, bool)
        begins[1:-1] = (SPACE[right] & VISIBLE[left]) | (SIGN[right] & LETTER[left])
        begins[bounds] = True
        starts = np.flatnonzero(begins)
        ids, counts = self.cache.look_up(data, starts)
        return ids, np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, bounds)]

    def _mixed(self, parts: list[bytes], odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        plain = np.flatnonzero(~odd)
        ids, bounds = self.encode([parts[i] for i in plain])
        out: list[np.ndarray] = [np.zeros(0, self.dtype)] * len(parts)
        for i, a, b in zip(plain.tolist(), bounds.tolist(), bounds[1:].tolist()):
            out[i] = ids[a:b]
        rest = np.flatnonzero(odd).tolist()
        for i, found in zip(rest, self._library([parts[i].decode() for i in rest])):
            out[i] = np.frombuffer(found, self.dtype)
        return np.concatenate(out), np.concatenate([[0], np.cumsum(list(map(len, out)))])

    @staticmethod
    def _has_other_space(parts: list[bytes], bounds: np.ndarray) -> np.ndarray:
        """Which texts hold white space other than spaces and line feeds; only those with a byte that could be one are searched."""
        odd = np.zeros(len(parts), bool)
        suspects = np.flatnonzero(SUSPECT[np.frombuffer(b"".join(parts), np.uint8)])
        for i in np.unique(np.searchsorted(bounds, suspects, side="right") - 1).tolist():
            odd[i] = OTHER_SPACE.search(parts[i].decode()) is not None
        return odd


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _files(uri: str) -> tuple[pafs.FileSystem, str]:
    if urlparse(uri).scheme in ("", "file"):
        return pafs.LocalFileSystem(), urlparse(uri).path
    return pafs.FileSystem.from_uri(uri)


def write_tokens(docs: DataFrame, uri: str, path: str = VOCABULARY, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write token files under uri and return their manifest: (part, name, n_docs, n_ids, width, base), base by prefix sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        part = TaskContext.get().partitionId()
        name = f"{part:06d}-{uuid.uuid4().hex}"
        fs, root = _files(uri)
        fs.create_dir(root, recursive=True)
        n_docs = at = 0
        ids_out = offsets_out = docs_out = None
        for batch in ta.slices(batches, max_bytes=1 << 20):
            if ids_out is None:
                ids_out, offsets_out, docs_out = (fs.open_output_stream(f"{root}/{name}.{x}") for x in ("ids", "offsets", "docs"))
                offsets_out.write(np.zeros(1, "<i8").tobytes())
            ids, bounds = enc.encode(ta.pieces(batch.column(1)))
            ends = at + bounds[1:] + np.arange(1, len(bounds))
            at, n_docs = int(ends[-1]), n_docs + batch.num_rows
            ids_out.write(np.insert(ids, bounds[1:], end_id).tobytes())
            offsets_out.write(ends.astype("<i8").tobytes())
            docs_out.write(np.array(batch.column(0).fill_null(NULL_ID)).astype("<i8").tobytes())
        if n_docs:
            for out in (ids_out, offsets_out, docs_out):
                out.close()
            values = ([part], [name], [n_docs], [at], [enc.dtype.itemsize])
            yield pa.record_batch([pa.array(v, t) for v, t in zip(values, (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32()))], names=["part", "name", "n_docs", "n_ids", "width"])

    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    dealt = rows.withColumn("draw", F.xxhash64("text")).withColumn("chance", F.rand(0)).repartitionByRange(parts, "doc_id", "draw", "chance").sortWithinPartitions("doc_id", "draw").select("doc_id", "text")
    manifest = stored(dealt.mapInArrow(run, "part int, name string, n_docs long, n_ids long, width int"), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")))


def open_tokens(uri: str, name: str, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, offsets, doc_ids) of one file: memory-mapped where the files are local."""
    fs, root = _files(uri)
    found = []
    for x, kind in (("ids", f"<u{width}"), ("offsets", "<i8"), ("docs", "<i8")):
        if isinstance(fs, pafs.LocalFileSystem):
            found.append(np.memmap(f"{root}/{name}.{x}", kind, "r"))
        else:
            with fs.open_input_file(f"{root}/{name}.{x}") as file:
                found.append(np.frombuffer(file.read_buffer(), kind))
    return found[0], found[1], found[2]


def read_tokens(manifest: DataFrame, uri: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files; the crc is over unsigned 32-bit ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, offsets, doc_ids = open_tokens(uri, row["name"], row["width"])
                for a in range(0, len(doc_ids), 4096):
                    own, at = doc_ids[a : a + 4096], np.array(offsets[a : a + 4097])
                    crc = [zlib.crc32(ids[x:y].astype("<u4").tobytes()) for x, y in zip(at.tolist(), at[1:].tolist())]
                    columns = [pa.array(own, mask=np.asarray(own == NULL_ID)), pa.array(at[:-1] + row["base"]), pa.array(np.diff(at)), pa.array(crc, pa.int64())]
                    yield pa.record_batch(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    parts = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return manifest.repartition(parts, "part").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, as the token files have them."""
    uri = new_path(spark, "tokens")
    return read_tokens(write_tokens(read_table(spark, sf_dir, "documents"), uri), uri)
