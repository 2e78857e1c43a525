"""SentencePiece encoding and decoding on the tokenizers library
(operator 2).

The model file (a protobuf) is parsed here, field by field, and rebuilt as a
tokenizers model: the normaliser (character map, white space rules, metaspace
marker), a BPE with merges ranked by piece score or a unigram model with the
scores as they are, and byte fallback.  Texts are cut into units at the
marker; a unit's ids do not depend on its neighbours if no piece holds a
marker after other characters, so new units go to the library's multithreaded
``encode_batch`` once and repeat from a table.  Other models encode whole
texts.  ``sentencepiece`` itself encodes the same texts for the parity
column.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.llm.arrow_text import text_chunks
from quillstream.llm.piece_cache import UnitTable, kept_in_worker

MARK = "▁"
#: Fixed values of the model file: piece kinds, model kinds, field numbers.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2
PIECES, TRAINER, NORMALIZER = 1, 2, 3
MODEL_TYPE, WHITESPACE_SUFFIX, BYTE_FALLBACK, UNK_ID = 3, 24, 35, 40
CHARSMAP, DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE = 2, 3, 4, 5


def _varint(raw: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = raw[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def message_fields(raw: bytes):
    """(field number, value) pairs of a protobuf message: integers, or bytes
    for the fixed-width and length-delimited kinds."""
    at = 0
    while at < len(raw):
        key, at = _varint(raw, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(raw, at)
        else:
            size, at = _varint(raw, at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = raw[at : at + size], at + size
        yield key >> 3, value


@dataclass
class PieceModel:
    """What a model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra: bool = True
    escape: bool = True

    @classmethod
    def parse(cls, raw: bytes) -> PieceModel:
        model = cls()
        for number, value in message_fields(raw):
            if number == PIECES:
                own = dict(message_fields(value))
                score = struct.unpack("<f", own[2])[0] if 2 in own else 0.0
                model.pieces.append((own.get(1, b"").decode("utf-8"), score, own.get(3, NORMAL)))
            elif number == TRAINER:
                own = dict(message_fields(value))
                model.kind = own.get(MODEL_TYPE, UNIGRAM)
                model.byte_fallback = bool(own.get(BYTE_FALLBACK, 0))
                model.unk_id = own.get(UNK_ID, 0)
                if own.get(WHITESPACE_SUFFIX):
                    raise ValueError("models with the marker as a suffix are not supported")
            elif number == NORMALIZER:
                own = dict(message_fields(value))
                model.charsmap = own.get(CHARSMAP, b"")
                model.dummy_prefix = bool(own.get(DUMMY_PREFIX, 1))
                model.remove_extra = bool(own.get(REMOVE_EXTRA, 1))
                model.escape = bool(own.get(ESCAPE, 1))
        if model.kind not in (UNIGRAM, BPE) or any(kind == UNUSED for *_, kind in model.pieces):
            raise ValueError("only unigram and BPE models without unused pieces are supported")
        return model

    def merges(self) -> list[tuple[str, str]]:
        """Pairs of pieces in the order in which they may merge: by the score
        of the result; among equal scores longer results first, so that runs
        of one character grow from the left as in the original."""
        usable = {p for p, _, kind in self.pieces if kind in (NORMAL, USER_DEFINED)}
        ranked = []
        for number, (piece, score, kind) in enumerate(self.pieces):
            if kind == NORMAL:
                for i in range(1, len(piece)):
                    if piece[:i] in usable and piece[i:] in usable:
                        ranked.append((-score, -len(piece), number, len(piece) - i, piece[:i], piece[i:]))
        ranked.sort()
        return [(a, b) for *_, a, b in ranked]

    def normalizer(self):
        """The library's normaliser; None if texts stay as they are."""
        from tokenizers import Regex, normalizers

        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.remove_extra:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(MARK if self.escape else " "))
        if self.escape:
            steps.append(normalizers.Replace(" ", MARK))
        return normalizers.Sequence(steps) if steps else None

    def core(self):
        """A tokenizers Tokenizer without normaliser or pre-tokeniser."""
        from tokenizers import AddedToken, Tokenizer, models

        if self.kind == BPE:
            vocab = {p: i for i, (p, _, _) in enumerate(self.pieces)}
            model = models.BPE(vocab, self.merges(), unk_token=self.pieces[self.unk_id][0], fuse_unk=True, byte_fallback=self.byte_fallback)
        else:
            scored = [(p, s) for p, s, _ in self.pieces]
            model = models.Unigram(scored, unk_id=self.unk_id, byte_fallback=self.byte_fallback)
        core = Tokenizer(model)
        own = [p for p, _, kind in self.pieces if kind == USER_DEFINED]
        if own:
            core.add_tokens([AddedToken(p, normalized=False) for p in own])
        return core

    def splits_at_marks(self) -> bool:
        """Whether units between markers encode on their own."""
        plain = all(MARK not in p.lstrip(MARK) for p, _, _ in self.pieces)
        return plain and self.escape and not any(kind == USER_DEFINED for *_, kind in self.pieces)


class PieceCodec:
    """Encoder and decoder of a model file."""

    def __init__(self, path: str) -> None:
        from tokenizers import decoders

        with open(path, "rb") as file:
            self.model = PieceModel.parse(file.read())
        self.core = self.model.core()
        self.normalizer = self.model.normalizer()
        steps = [decoders.Replace(MARK, " ")] if self.model.escape else []
        steps += [decoders.ByteFallback(), decoders.Fuse()]
        if self.model.dummy_prefix:
            steps.append(decoders.Strip(" ", 1, 0))
        self.core.decoder = decoders.Sequence(steps)
        self.table = UnitTable(self._encode_units) if self.model.splits_at_marks() else None
        own = [self._piece_bytes(p, kind) for p, _, kind in self.model.pieces]
        self.piece_at = np.cumsum([0, *map(len, own)])
        self.piece_raw = np.frombuffer(b"".join(own), dtype=np.uint8)
        self.simple = self.model.escape and not self.model.charsmap and not self.model.remove_extra

    def _encode_units(self, units: list[str]) -> list[list[int]]:
        return [e.ids for e in self.core.encode_batch(units, add_special_tokens=False)]

    def normalized(self, texts: list[str]) -> list[str]:
        if self.simple:  # the rules that concern single characters only
            mark = MARK if self.model.dummy_prefix else ""
            return [mark + t.replace(" ", MARK) if t else "" for t in texts]
        return [self.normalizer.normalize_str(t) if self.normalizer and t else t for t in texts]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds per text)."""
        own = self.normalized(texts)
        if self.table is None:
            ids = self._encode_units(own)
            return np.fromiter((i for x in ids for i in x), dtype=np.uint32), np.cumsum([0, *map(len, ids)])
        points = np.frombuffer("".join(own).encode("utf-32-le"), dtype=np.uint32)
        edges = np.cumsum([0, *map(len, own)])
        if not len(points):
            return np.empty(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        mark = points == ord(MARK)
        begin = mark.copy()
        begin[1:] &= ~mark[:-1]
        begin[edges[:-1][edges[:-1] < len(points)]] = True
        return self.table.ids(points, np.flatnonzero(begin), edges)

    def _piece_bytes(self, piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:-1], 16)])
        return (piece.replace(MARK, " ") if self.model.escape else piece).encode()

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Texts of flat ids by table lookup; bytes that are no UTF-8 take
        the library's decoder, with its replacement characters."""
        first, size = self.piece_at[ids], self.piece_at[ids + 1] - self.piece_at[ids]
        run = np.concatenate(([0], np.cumsum(size)))
        raw = self.piece_raw[np.arange(run[-1]) + np.repeat(first - run[:-1], size)].tobytes()
        edges = run[bounds].tolist()
        out = []
        for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            a += self.model.dummy_prefix and raw[a : a + 1] == b" " and a < b
            try:
                out.append(raw[a:b].decode())
            except UnicodeDecodeError:
                out.append(self.core.decode(ids[bounds[i] : bounds[i + 1]].tolist(), skip_special_tokens=False))
        return out


def codec(path: str) -> PieceCodec:
    return kept_in_worker(PieceCodec, path)


CODED_SCHEMA = "doc_id bigint, n_tokens bigint, ids_crc32 bigint, decoded_sha256 string, round_trip boolean, parity boolean"


def encode_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): piece ids of every row as array<int>.

    Defined cases: a null or empty text has no ids; null ids of rows stay
    null; repeated rows are encoded alike, one by one; an empty table gives
    no rows; other columns are ignored."""

    def encode(batches):
        coder = codec(path)
        for batch in batches:
            doc = batch.column(0)
            for row, texts in _texts(batch.column(1)):
                ids, bounds = coder.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [doc.slice(row, len(texts)), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))],
                    names=["doc_id", "ids"],
                )

    own = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return own.mapInArrow(encode, "doc_id bigint, ids array<int>")


def decode_pieces(coded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give the empty text."""

    def decode(batches):
        coder = codec(path)
        for batch in batches:
            own = [x or [] for x in batch.column(1).to_pylist()]
            flat = np.fromiter((i for x in own for i in x), dtype=np.int64)
            texts = coder.decode(flat, np.cumsum([0, *map(len, own)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return coded.select(F.col(id_col).cast("long"), F.col(ids_col).cast("array<int>")).mapInArrow(decode, "doc_id bigint, text string")


def _texts(column: pa.Array):
    for row, data, offsets in text_chunks(column):
        raw = data.tobytes()
        yield row, [raw[a:b].decode("utf-8") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


class _Reference:
    def __init__(self, path: str) -> None:
        import sentencepiece

        self.encode = sentencepiece.SentencePieceProcessor(model_file=path).encode


def check_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: token count, unsigned CRC-32 of the ids as little-endian u32,
    digest of the decoded text, whether it equals the text, and whether
    ``sentencepiece`` gives the same ids.  Same defined cases as
    ``encode_pieces``."""
    import hashlib

    def check(batches):
        coder, reference = codec(path), kept_in_worker(_Reference, path)
        for batch in batches:
            doc = batch.column(0)
            for row, texts in _texts(batch.column(1)):
                ids, bounds = coder.encode(texts)
                cuts = list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
                raw, flat = ids.astype("<u4").tobytes(), ids.tolist()
                own = [flat[a:b] for a, b in cuts]
                back = coder.decode(ids.astype(np.int64), bounds)
                theirs = reference.encode(texts, num_threads=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        doc.slice(row, len(texts)),
                        pa.array(np.diff(bounds)),
                        pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in cuts], pa.int64()),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back], pa.string()),
                        pa.array([t == b for t, b in zip(texts, back, strict=True)]),
                        pa.array([a == b for a, b in zip(own, theirs, strict=True)]),
                    ],
                    names=["doc_id", "n_tokens", "ids_crc32", "decoded_sha256", "round_trip", "parity"],
                )

    own = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return own.mapInArrow(check, CODED_SCHEMA)
