"""Token ids of a corpus in seekable files.

A file holds the documents of one doc_id range in ascending order. Its layout, all little-endian:

* one skippable frame with the document index: a zstandard frame of two int64 rows, doc_id and the
  place of the document's first id in the file, each followed by the file's number of ids;
* zstandard frames of at most ``frame_tokens`` uint32 ids each, every one independent and with a
  content checksum; a document may begin and end inside a frame;
* a skippable frame with the seek table: compressed size, decompressed size and xxHash64 (low 32
  bits) of every frame, the number of frames, a descriptor byte and the closing magic number.

A reader takes the seek table from the end and decompresses only the frames it needs.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from cofferline.llm.common import stored, worker_memory

# fixed values of the public seekable format
_INDEX_MAGIC = 0x184D2A51
_SEEK_MAGIC = 0x184D2A5E
_SEEK_END = 0x8F92EAB1
_WITH_CHECKSUMS = 0x80

_NO_ID = -(2**63)  # a null doc_id in the index
_MEMO_LIMIT = 400_000
_CHUNK_WORDS = 200_000
#: Lead bytes of the marks that compose with an ASCII letter. Composing comes before lowering, so a
#: capital before one of them is left as it is.
_MARKS = (b"\xcc", b"\xcd")
_MARKED = re.compile(rb"[A-Z][\xcc\xcd]")
_STRETCH = re.compile(rb"\S+")
#: Latin letters and then ASCII marks but the apostrophe: two pre-tokens, or one without marks.
_SIMPLE = re.compile(r"([a-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
#: What stands for each byte in a byte-level vocabulary: itself where it can be printed, else the next free one.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LEVEL = {b: 256 + n for n, b in enumerate(sorted(set(range(256)) - set(_PRINTED)))}
_OUT_TOKENS = 4_000_000  # ids gathered before a reader hands on a batch

MANIFEST = "path string, first_id bigint, n_docs bigint, n_tokens bigint"
ROWS = "doc_id bigint, start bigint, n_tokens bigint, tokens binary"


# -- files ------------------------------------------------------------------------------------


class FrameWriter:
    """Writes one file; ids are compressed as soon as a frame is full."""

    def __init__(self, sink, frame_tokens: int):
        self.sink, self.frame_tokens = sink, frame_tokens
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.waiting, self.table = bytearray(), []
        self.ids, self.starts, self.written = [], [], 0

    def add(self, doc_id: int | None, tokens: bytes) -> None:
        """``tokens``: little-endian uint32."""
        self.ids.append(_NO_ID if doc_id is None else doc_id)
        self.starts.append(self.written + len(self.waiting) // 4)
        self.waiting += tokens
        size, full = 4 * self.frame_tokens, 0
        while len(self.waiting) - full >= size:
            self._frame(bytes(self.waiting[full : full + size]))
            full += size
        del self.waiting[:full]

    def _frame(self, data: bytes) -> None:
        frame = self.compressor.compress(data)
        self.sink.write(frame)
        self.table.append((len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.written += len(data) // 4

    def close(self) -> int:
        """Finish the file; returns its number of ids."""
        if self.waiting:
            self._frame(bytes(self.waiting))
        index = np.array([[*self.ids, self.written], [*self.starts, self.written]], "<i8").tobytes()
        packed = self.compressor.compress(index)
        self.sink.write(struct.pack("<II", _INDEX_MAGIC, len(packed)) + packed)
        self.table.append((len(packed) + 8, 0, xxhash.xxh64_intdigest(index) & 0xFFFFFFFF))
        entries = b"".join(struct.pack("<III", *entry) for entry in self.table)
        end = struct.pack("<IBI", len(self.table), _WITH_CHECKSUMS, _SEEK_END)
        self.sink.write(struct.pack("<II", _SEEK_MAGIC, len(entries) + len(end)) + entries + end)
        return self.written


class FrameReader:
    """Random access to one file."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        frames, descriptor, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != _SEEK_END or descriptor != _WITH_CHECKSUMS:
            raise ValueError("not a seekable token file")
        raw = self._at(size - 9 - 12 * frames, 12 * frames)
        table = np.frombuffer(raw, "<u4").reshape(frames, 3).astype(np.int64)
        self.sizes, self.checks = table[:, :2], table[:, 2]
        self.places = np.concatenate(([0], np.cumsum(table[:, 0])))
        self.firsts = np.concatenate(([0], np.cumsum(table[:, 1]))) // 4
        self.decompressor = zstandard.ZstdDecompressor()
        last = frames - 1
        packed = self._at(self.places[last] + 8, self.sizes[last, 0] - 8)
        index = self._checked(last, self.decompressor.decompress(packed))
        self.ids, self.starts = np.frombuffer(index, "<i8").reshape(2, -1)
        self.opened, self.frame = -1, b""

    def _at(self, place: int, size: int) -> bytes:
        self.source.seek(int(place))
        return self.source.read(int(size))

    def _checked(self, frame: int, data: bytes) -> bytes:
        if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.checks[frame]:
            raise ValueError(f"checksum of frame {frame} differs")
        return data

    def _open(self, frame: int) -> bytes:
        if frame != self.opened:
            packed = self._at(self.places[frame], self.sizes[frame, 0])
            self.frame, self.opened = self._checked(frame, self.decompressor.decompress(packed)), frame
        return self.frame

    def tokens(self, row: int) -> bytes:
        """Ids of the document in this row of the index, as little-endian uint32."""
        start, end, parts = int(self.starts[row]), int(self.starts[row + 1]), []
        while start < end:
            frame = int(np.searchsorted(self.firsts, start, "right")) - 1
            first, stop = int(self.firsts[frame]), min(end, int(self.firsts[frame + 1]))
            parts.append(self._open(frame)[4 * (start - first) : 4 * (stop - first)])
            start = stop
        return b"".join(parts)


# -- tokens -----------------------------------------------------------------------------------


def _lowered(stretch: re.Match) -> bytes:
    return stretch[0] if _MARKED.search(stretch[0]) else stretch[0].lower()


def _stretches(text: str | None) -> list[bytes]:
    """Parts of a text that the tokenizer treats alone, in few forms: it never joins across ASCII white
    space, and lowers the case."""
    data = text.encode() if text else b""
    if b"<|" in data:  # names of special tokens keep their case
        return data.split()
    if any(mark in data for mark in _MARKS) and _MARKED.search(data):
        return _STRETCH.sub(_lowered, data).split()
    return data.lower().split()


class WordMemory(dict):
    """Packed ids by stretch; the ids of a text are those of its stretches in order."""

    def __init__(self, tokenizer_json: str):
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.model, self.parts = self.tokenizer.model, {"": b""}

    def _part(self, part: str) -> bytes:
        """Ids of one pre-token, already lowered."""
        if part not in self.parts:
            if len(self.parts) > _MEMO_LIMIT:
                self.parts.clear()
            letters = part if part.isascii() else part.encode().decode("latin-1").translate(_BYTE_LEVEL)
            self.parts[part] = b"".join([token.id.to_bytes(4, "little") for token in self.model.tokenize(letters)])
        return self.parts[part]

    def learn(self, words: set[bytes]) -> None:
        """Encode the unknown ones of a chunk: simple ones by the model, which spares normalising and
        splitting them, the others by the whole tokenizer in one call."""
        if len(self) > _MEMO_LIMIT:
            self.clear()
        others = []
        for word in words:
            if word not in self:
                text = word.decode()
                simple = _SIMPLE.fullmatch(text)
                if simple:
                    self[word] = self._part(simple[1].lower()) + self._part(simple[2])
                else:
                    others.append(text)
        found = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
        for text, encoding in zip(others, found, strict=True):
            self[text.encode()] = np.array(encoding.ids, "<u4").tobytes()

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of every text as little-endian uint32, chunk by chunk."""
        waiting, held = [], 0
        for text in texts:
            waiting.append(_stretches(text))
            held += len(waiting[-1])
            if held > _CHUNK_WORDS:
                yield from self._chunk(waiting)
                waiting, held = [], 0
        yield from self._chunk(waiting)

    def _chunk(self, waiting: list[list[bytes]]) -> Iterator[bytes]:
        self.learn(set(chain.from_iterable(waiting)))
        for words in waiting:
            yield b"".join(map(self.__getitem__, words))


def _writer(folder: str, tokenizer, end_id: int, frame_tokens: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        key = f"words_{xxhash.xxh3_64_hexdigest(tokenizer.value)}"
        memory, out, first, path = worker_memory(key, lambda: WordMemory(tokenizer.value)), None, None, None
        end = np.array([end_id], "<u4").tobytes()
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for doc_id, tokens in zip(batch.column(0).to_pylist(), memory.encode(batch.column(1).to_pylist()), strict=True):
                if out is None:
                    store.create_dir(root, recursive=True)
                    path = f"{root}/{uuid.uuid4().hex}.tokens"
                    sink = store.open_output_stream(path)
                    out, first = FrameWriter(sink, frame_tokens), doc_id
                out.add(doc_id, tokens + end)
        if out is not None:
            count = out.close()
            sink.close()
            name = f"{folder}/{path.rpartition('/')[2]}"
            yield pa.RecordBatch.from_pydict(
                {"path": [name], "first_id": pa.array([first], pa.int64()), "n_docs": [len(out.ids)], "n_tokens": [count]}
            )

    return write


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int = 1,
    frame_tokens: int = 1 << 16,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Write the ids of all documents in ascending doc_id order; returns the stored list of files.

    ``folder`` must be reachable from every executor. Each range of doc_ids becomes one file under a
    name of its own, so a repeated or speculative task never touches the file of another attempt;
    only files in the returned list count. Every document ends with ``end_id``. Null and empty texts
    hold that id alone; null doc_ids come first; rows that share a doc_id are ordered by text. An
    empty table gives an empty list.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stored(ordered.mapInArrow(_writer(folder, shared, end_id, frame_tokens), MANIFEST), "manifest")


def _row_reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file in batch.to_pylist():
            store, path = fs.FileSystem.from_uri(file["path"])
            with store.open_input_file(path) as source:
                reader = FrameReader(source)
                wanted = file.get("wanted")
                count = len(reader.ids) - 1
                if wanted is None:
                    rows = range(count)
                else:
                    rows = np.flatnonzero(np.isin(reader.ids[:count], np.array(wanted, np.int64))).tolist()
                yield from _batches(reader, rows, file["base"])


def _batches(reader: FrameReader, rows, base: int) -> Iterator[pa.RecordBatch]:
    ids, starts, counts, data, size = [], [], [], [], 0

    def batch():
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "start": pa.array(starts, pa.int64()),
                "n_tokens": pa.array(counts, pa.int64()),
                "tokens": pa.array(data, pa.binary()),
            }
        )

    for row in rows:
        doc_id, tokens = int(reader.ids[row]), reader.tokens(row)
        ids.append(None if doc_id == _NO_ID else doc_id)
        starts.append(base + int(reader.starts[row]))
        counts.append(len(tokens) // 4)
        data.append(tokens)
        size += len(tokens) // 4
        if size >= _OUT_TOKENS:
            yield batch()
            ids, starts, counts, data, size = [], [], [], [], 0
    if ids:
        yield batch()


def with_bases(files: DataFrame) -> DataFrame:
    """Add ``base``, the number of ids in all files before each one. There is one row per file."""
    before = Window.orderBy(F.col("first_id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_token_files(files: DataFrame, wanted: DataFrame | None = None, doc_id: str = "doc_id") -> DataFrame:
    """Documents of the listed files: doc_id, ``start`` (ids of all documents before it), ``n_tokens``
    and ``tokens`` (uint32, little-endian). With ``wanted``, a table of doc_ids, only those are
    decompressed, and files that hold none of them are not opened. Missing doc_ids give no row."""
    based = with_bases(files)
    if wanted is not None:
        upper = F.lead("first_id").over(Window.orderBy(F.col("first_id").asc_nulls_first()))
        ids = wanted.select(F.col(doc_id).cast("bigint").alias("w")).filter("w is not null").distinct()
        spans = based.withColumn("upper", upper)
        based = (
            spans.join(ids, (F.coalesce("first_id", F.lit(_NO_ID)) <= F.col("w")) & (F.col("upper").isNull() | (F.col("w") < F.col("upper"))))
            .groupBy("path", "base")
            .agg(F.collect_set("w").alias("wanted"))
        )
    else:
        based = based.select("path", "base")
    # one partition a file; a number given is not coalesced, so files are read side by side
    return based.repartition(max(1, files.count()), "path").mapInArrow(_row_reader, ROWS)
