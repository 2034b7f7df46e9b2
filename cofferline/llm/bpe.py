"""Byte-level BPE through a sentencepiece model that is written from the rank file, never trained.

Every byte of a vocabulary entry becomes one letter, the entry's score is its negative rank and
nothing is normalised, so the library's best-scored merges are the lowest-rank merges. Texts are cut
by the tokenizer's pattern first and each distinct pre-token is encoded once per batch memory.
"""

from __future__ import annotations

import base64
import struct
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, tee

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cofferline.llm.common import values_of

_FIRST_LETTER = 0x100  # byte b is written as the letter U+0100 + b
_LETTERS = {b: _FIRST_LETTER + b for b in range(256)}
_MEMO_LIMIT = 150_000  # pre-tokens kept; beyond it the memory starts anew, results are the same
_CHUNK_PIECES = 200_000


def read_ranks(path: str) -> list[bytes]:
    """Vocabulary entries of a rank file by rank; ranks must run from 0 without gaps."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [ranks[rank] for rank in range(len(ranks))]


def letters(token: bytes) -> str:
    return token.decode("latin-1").translate(_LETTERS)


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """The vocabulary as a serialised sentencepiece BPE model whose ids are the ranks."""
    from sentencepiece import sentencepiece_model_pb2 as schema

    model = schema.ModelProto()
    for rank, token in enumerate(tokens):
        model.pieces.add(piece=letters(token), score=-float(rank))
    model.pieces.add(piece="<unk>", score=0.0, type=schema.ModelProto.SentencePiece.UNKNOWN)
    trainer = model.trainer_spec
    trainer.model_type = schema.TrainerSpec.BPE
    trainer.vocab_size = len(tokens) + 1
    trainer.unk_id, trainer.bos_id, trainer.eos_id, trainer.pad_id = len(tokens), -1, -1, -1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    return model.SerializeToString()


class PieceMemory(dict):
    """Ids by pre-token, packed as int32. ``learn`` encodes the unknown ones of a chunk in one call."""

    def __init__(self, model: bytes, tokens: list[bytes]):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.whole = {token: rank for rank, token in enumerate(tokens)}

    def learn(self, pieces: set[str]) -> None:
        if len(self) > _MEMO_LIMIT:
            self.clear()
        new = [piece for piece in pieces if piece not in self]
        long = []
        for piece in new:
            rank = self.whole.get(piece.encode())
            if rank is None:
                long.append(piece)
            else:
                self[piece] = struct.pack("i", rank)
        mapped = [letters(piece.encode()) for piece in long]
        for piece, ids in zip(long, self.processor.encode(mapped, num_threads=1), strict=True):
            self[piece] = array("i", ids).tobytes()


def encode_texts(texts: Iterable[str | None], find, memory: PieceMemory) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in one row, and where each text's ids start and end."""
    packed, ends, waiting, pieces = bytearray(), [0], [], 0

    def flush():
        memory.learn(set(chain.from_iterable(waiting)))  # before the first look-up of the chunk
        for found in waiting:
            packed.extend(b"".join(map(memory.__getitem__, found)))
            ends.append(len(packed) // 4)
        waiting.clear()

    for text in texts:
        found = find(text) if text else []
        waiting.append(found)
        pieces += len(found)
        if pieces >= _CHUNK_PIECES:
            flush()
            pieces = 0
    flush()
    return np.frombuffer(packed, np.int32), np.array(ends, np.int32)


def _encoder(shared, pattern: str):
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens, model = shared.value
        memory, find = PieceMemory(model, tokens), regex.compile(pattern).findall
        for texts in batches:
            flat, ends = encode_texts(values_of(texts, 100), find, memory)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))

    return encode


def _decoder(shared):
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token = dict(enumerate(shared.value[0])).get
        for rows in batches:
            # one document's ids at a time become Python numbers
            ids, ends, missing = rows.values.fill_null(-1).to_numpy(), rows.offsets.to_numpy(), rows.is_null().to_pylist()
            yield pa.array(
                [
                    None if null else b"".join([token(i, b"") for i in ids[start:end].tolist()])
                    for start, end, null in zip(ends[:-1], ends[1:], missing, strict=True)
                ],
                pa.binary(),
            )

    return decode


def _round_trip(shared, pattern: str):
    encode, decode = _encoder(shared, pattern), _decoder(shared)

    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids, same_ids = tee(encode(batches))  # read in turn, so that one batch is held
        for own, decoded in zip(ids, decode(same_ids), strict=True):
            yield pa.StructArray.from_arrays([own, decoded], ["ids", "decoded"])

    return both


def _shared(df: DataFrame, ranks_path: str):
    """Vocabulary and model as a broadcast; both are as large as the rank file, whatever the data."""
    tokens = read_ranks(ranks_path)
    return df.sparkSession.sparkContext.broadcast((tokens, sentencepiece_model(tokens)))


def byte_bpe_encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids``, an int array: the tokens of ``text``, without special tokens.

    Null and empty texts give an empty array. A column that is called ``ids`` already is replaced; all
    other columns pass through untouched. Texts are processed whole, row by row, without a shuffle.
    """
    encode = F.arrow_udf(_encoder(_shared(df, ranks_path), pattern), "array<int>")
    return df.withColumn(ids, encode(F.col(text)))


def byte_bpe_decode(df: DataFrame, ranks_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add ``decoded``, the bytes that the ids stand for. A null array gives null; a null id, or one
    outside the vocabulary, gives no bytes. A column that is called ``decoded`` already is replaced."""
    decode = F.arrow_udf(_decoder(_shared(df, ranks_path)), "binary")
    return df.withColumn(decoded, decode(F.col(ids)))


def byte_bpe_round_trip(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", coded: str = "coded") -> DataFrame:
    """Add ``coded``: ``ids`` as ``byte_bpe_encode`` gives them, and ``decoded`` as ``byte_bpe_decode``
    makes from these. Both steps share one Python worker, so a task needs the memory of one only. A
    column of that name is replaced."""
    both = F.arrow_udf(_round_trip(_shared(df, ranks_path), pattern), "struct<ids:array<int>,decoded:binary>")
    return df.withColumn(coded, both(F.col(text)))
