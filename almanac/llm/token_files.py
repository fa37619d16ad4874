"""Token ids in fixed-width bit-packed files.

A file holds the ids of a run of documents, each id in as many bits as the
vocabulary needs, in blocks of ``BLOCK`` ids that begin on a byte.  Layout, little-endian:

    magic | blocks | doc ids (int64) | null flags (uint8) | first id of each document and the end (uint64)
    | byte offset of each block and the end (uint64) | trailer: bits, ids per block, documents, ids, offset of the doc ids (uint64)

The index stands at the end, so a file is written in one pass.  From the offsets any
block can be read and unpacked by itself; eight ids take exactly ``bits`` bytes,
so packing and unpacking are a few array operations.

Documents are range-partitioned and sorted by ``doc_id``; each task writes one
file under a name of its own and reports it, and only reported files are read, so a
task that is lost or run twice leaves no trace in the result.

With ``by_words`` the pieces of words are encoded once per worker and kept (see :class:`WordEncoder`).

Nulls and odd rows: a null text counts as empty and has the end id only.  Null ids come first; rows equal in
``doc_id`` are ordered by a hash of the text, then the text.  An empty table gives an empty result.
Other columns of the input are not stored.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from almanac.staging import new_folder, stage

# Fixed value: appended to each document.
END_ID = 2

MAGIC = b"PACKIDS1"
BLOCK = 4096

# Blocks packed, written, read and unpacked at once.
BLOCKS_AT_ONCE = 64

# Pieces in each of the two generations that a worker keeps: some 80 MB each.
MOST_PIECES = 400_000

# Documents taken from a batch at once.
ROWS_AT_ONCE = 512

# 1 for ASCII letters, 2 for other ASCII characters but the apostrophe, 0 for the rest.
_KINDS = np.array(
    [0 if b >= 0x80 or b == 0x27 else 1 if bytes([b]).isalpha() else 2 for b in range(256)], dtype=np.uint8
)

# What a byte-level tokenizer shows its model for a byte: printable bytes as they are, the others from U+0100 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARACTERS = {b: 0x100 + i for i, b in enumerate(b for b in range(0x100) if b not in _PRINTABLE)}

_encoders: dict[tuple[str, bool], WordEncoder | TextEncoder] = {}


def width(vocabulary: int) -> int:
    """Bits that the largest id needs."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids one after the other, lowest bit first, padded with zeros to a byte."""
    groups = np.zeros((-(-len(ids) // 8), 8), dtype=np.uint64)
    groups.reshape(-1)[: len(ids)] = ids
    out = np.zeros((len(groups), bits), dtype=np.uint8)
    for byte in range(bits):
        for j in range(8 * byte // bits, min(8, -(-8 * (byte + 1) // bits))):
            shift = 8 * byte - j * bits
            out[:, byte] |= (groups[:, j] >> np.uint64(shift) if shift >= 0 else groups[:, j] << np.uint64(-shift)).astype(np.uint8)
    return out.tobytes()[: -(-len(ids) * bits // 8)]


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids as uint32."""
    n_groups = -(-n // 8)
    raw = np.zeros(n_groups * bits, dtype=np.uint8)
    given = np.frombuffer(data, dtype=np.uint8)[: len(raw)]
    raw[: len(given)] = given
    raw = raw.reshape(n_groups, bits)
    out = np.zeros((n_groups, 8), dtype=np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for j in range(8):
        value = np.zeros(n_groups, dtype=np.uint64)
        for byte in range(j * bits // 8, -(-(j + 1) * bits // 8)):
            shift = 8 * byte - j * bits
            part = raw[:, byte].astype(np.uint64)
            value |= part << np.uint64(shift) if shift >= 0 else part >> np.uint64(-shift)
        out[:, j] = value & mask
    return out.reshape(-1)[:n]


class WordEncoder:
    """Encodes piece by piece and keeps what it has encoded.

    Only for tokenizers that drop white space, ignore case and never join a letter with an ASCII
    character that is neither letter nor apostrophe: blanks put between such characters change no id, and a text's
    ids are those of its pieces between white space, in turn.  Composed letters are left to the
    tokenizer, and so are texts that may hold a special token.

    Pieces are kept in two generations: when the young one is full it becomes the old one, and what is met
    again moves back.
    """

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer, self.young, self.old = tokenizer, {}, {}

    def __call__(self, text: bytes) -> bytes:
        if b"<|" not in text:
            text = with_seams(text.lower() if text.isascii() else text)
        pieces = text.split()
        missing = set(pieces).difference(self.young)
        if len(self.young) + len(missing) > MOST_PIECES:
            self.old, self.young = self.young, {}
            missing = set(pieces)
        if missing:
            self._learn(missing)
        return b"".join(map(self.young.__getitem__, pieces))

    def _learn(self, pieces: set[bytes]) -> None:
        young, old, other = self.young, self.old, []
        for p in pieces:
            if p in old:
                young[p] = old[p]
            elif (word := plain_word(p)) is not None:
                young[p] = _as_bytes([t.id for t in self.tokenizer.model.tokenize(word)])
            else:
                other.append(p)
        found = self.tokenizer.encode_batch_fast([p.decode() for p in other], add_special_tokens=False)
        young.update((p, _as_bytes(e.ids)) for p, e in zip(other, found, strict=True))


def plain_word(piece: bytes) -> str | None:
    """The piece as the tokenizer's model sees it, if it is letters below U+0180 only; else null.

    Such letters are composed already, and all but one have a single lower-case letter.  The model sees a character for each byte.
    """
    if piece.isalpha():
        return piece.lower().decode()
    text = piece.decode()
    if text.isalpha() and max(text) < "\u0180" and "\u0130" not in text:
        return text.lower().encode().decode("latin-1").translate(_BYTE_CHARACTERS)
    return None


def with_seams(text: bytes) -> bytes:
    """``text`` with blanks between ASCII letters and ASCII characters that are neither letter nor apostrophe."""
    raw = np.frombuffer(text, dtype=np.uint8)
    kinds = _KINDS[raw]
    seams = np.flatnonzero(kinds[:-1] + kinds[1:] == 3)
    return np.insert(raw, seams + 1, ord(" ")).tobytes() if len(seams) else text


class TextEncoder:
    """Encodes whole texts, for any tokenizer."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer

    def __call__(self, text: bytes) -> bytes:
        return _as_bytes(self.tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids)


def _as_bytes(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def encoder_at(path: str, by_words: bool) -> WordEncoder | TextEncoder:
    """Loaded once per worker, with the pieces it has encoded."""
    if (path, by_words) not in _encoders:
        _encoders[path, by_words] = (WordEncoder if by_words else TextEncoder)(Tokenizer.from_file(path))
    return _encoders[path, by_words]


def _uri(path: str) -> str:
    return re.sub(r"^file:/+", "file:///", path)


class Writer:
    """One file, written front to back."""

    def __init__(self, out, bits: int):
        self.out, self.bits = out, bits
        self.out.write(MAGIC)
        self.place, self.pending, self.n_ids = len(MAGIC), [], 0
        self.pending_bytes = 0
        self.doc_ids, self.nulls, self.starts, self.offsets = [], [], [], []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.starts.append(self.n_ids)
        self.n_ids += len(ids) // 4
        self.pending.append(ids)
        self.pending_bytes += len(ids)
        if self.pending_bytes >= 4 * BLOCK * BLOCKS_AT_ONCE:
            self._flush(whole=True)

    def _flush(self, whole: bool) -> None:
        ids = np.frombuffer(b"".join(self.pending), dtype="<u4")
        end = len(ids) // BLOCK * BLOCK if whole else len(ids)
        data = pack(ids[:end], self.bits)
        self.offsets += range(self.place, self.place + len(data), BLOCK * self.bits // 8)
        self.out.write(data)
        self.place += len(data)
        rest = ids[end:].tobytes()
        self.pending, self.pending_bytes = [rest], len(rest)

    def close(self) -> None:
        self._flush(whole=False)
        index = self.place
        for values, kind in (
            (self.doc_ids, "<i8"), (self.nulls, "u1"), ([*self.starts, self.n_ids], "<u8"), ([*self.offsets, index], "<u8"),
            ([self.bits, BLOCK, len(self.doc_ids), self.n_ids, index], "<u8"),
        ):
            self.out.write(np.array(values, dtype=kind).tobytes())


class Reader:
    """Random access to one file."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        self.bits, self.block, self.n_docs, self.n_ids, index = np.frombuffer(file.read_at(40, size - 40), "<u8").tolist()
        n_blocks = -(-self.n_ids // self.block)
        raw = file.read_at(size - 40 - index, index)
        at = 0
        self.doc_ids = np.frombuffer(raw, "<i8", self.n_docs, at)
        at += 8 * self.n_docs
        self.nulls = np.frombuffer(raw, "u1", self.n_docs, at).astype(bool)
        at += self.n_docs
        self.starts = np.frombuffer(raw, "<u8", self.n_docs + 1, at).astype(np.int64)
        at += 8 * (self.n_docs + 1)
        self.offsets = np.frombuffer(raw, "<u8", n_blocks + 1, at).astype(np.int64)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` of the file, from the blocks that hold them."""
        if start >= end:
            return np.empty(0, dtype=np.uint32)
        first, last = start // self.block, -(-end // self.block)
        data = self.file.read_at(int(self.offsets[last] - self.offsets[first]), int(self.offsets[first]))
        known = unpack(data, self.bits, min(last * self.block, self.n_ids) - first * self.block)
        return known[start - first * self.block : end - first * self.block]


def write(docs: DataFrame, tokenizer_path: str, by_words: bool = False, folder: str | None = None) -> DataFrame:
    """(shard, file, n_docs, n_ids): the written files, in order of ``doc_id``."""
    spark = docs.sparkSession
    folder = _uri(folder or new_folder(spark, "token-files"))
    bits = width(Tokenizer.from_file(tokenizer_path).get_vocab_size())

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path)
        encode = encoder_at(tokenizer_path, by_words)
        end, name = _as_bytes([END_ID]), f"ids-{uuid.uuid4().hex}.bin"
        with store.open_output_stream(f"{path}/{name}") as out:
            writer = Writer(out, bits)
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                    part = batch.slice(at, ROWS_AT_ONCE)
                    texts = part.column(1).cast(pa.binary()).to_pylist()
                    for doc_id, text in zip(part.column(0).to_pylist(), texts, strict=True):
                        writer.add(doc_id, encode(text or b"") + end)
            writer.close()
        yield pa.RecordBatch.from_pydict(
            {"shard": [TaskContext.get().partitionId()], "file": [f"{folder}/{name}"],
             "n_docs": [len(writer.doc_ids)], "n_ids": [writer.n_ids]}
        )

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    ordered = docs.select("doc_id", "text").repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    written = stage(
        ordered.mapInArrow(of_partition, "shard bigint, file string, n_docs bigint, n_ids bigint"), "token-manifest"
    )
    return written.where("n_docs > 0")


def read_documents(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""

    def of_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = fs.FileSystem.from_uri(row["file"])
                with store.open_input_file(path) as file:
                    yield _digests(Reader(file), row["first_id"])

    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = stage(manifest.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0))), "token-manifest")
    return (
        placed.select("file", "first_id").repartition(max(1, placed.count()))
        .mapInArrow(of_files, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    )


def _digests(reader: Reader, first_id: int) -> pa.RecordBatch:
    """Checksums of a file's documents; ids are unpacked a run of blocks at a time."""
    crcs = [0] * reader.n_docs
    step, starts = BLOCK * BLOCKS_AT_ONCE, reader.starts
    for at in range(0, reader.n_ids, step):
        end = min(at + step, reader.n_ids)
        data = memoryview(reader.ids(at, end).astype("<u4").tobytes())
        doc = int(np.searchsorted(starts, at, side="right")) - 1
        while doc < reader.n_docs and starts[doc] < end:
            part = data[4 * (max(int(starts[doc]), at) - at) : 4 * (min(int(starts[doc + 1]), end) - at)]
            crcs[doc] = zlib.crc32(part, crcs[doc])
            doc += 1
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array(reader.doc_ids, mask=reader.nulls),
            "start": pa.array(starts[:-1] + first_id),
            "n_tokens": pa.array(np.diff(starts)),
            "ids_crc32": pa.array(crcs, pa.int64()),
        }
    )
