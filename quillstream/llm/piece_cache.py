"""Batch encoding with the tokenizers library, one call per distinct piece.

A byte-level BPE encodes every pre-tokenised piece on its own, so a text's
ids are the concatenation of its pieces' ids.  The pieces of a chunk are
found with NumPy (character classes come from the library's own
pre-tokeniser, asked once per character), named by 64-bit hashes, and only
pieces not met before go to the library's model.  The table of known pieces
is bounded (``MAX_PIECES``) and starts anew when full.

Texts that hold an added token's string, and tokenizers with other
pre-tokenisers or a normaliser, take the library's whole-text path.
"""

from __future__ import annotations

import json
import sys
import types

import numpy as np
import pyarrow as pa

from quillstream.llm.arrow_text import SpanHasher, mix64, text_chunks

LETTER, NUMBER, OTHER, SPACE, UNKNOWN = range(5)
MAX_PIECES = 1_000_000
#: The suffixes that the pre-tokeniser keeps with an apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def byte_alphabet() -> dict[int, int]:
    """Byte -> code point under which a byte-level vocabulary writes it:
    printable Latin-1 stays, the other bytes follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(rest)}


class UnitTable:
    """Ids of text units, each encoded once and found by a 64-bit hash."""

    def __init__(self, encode) -> None:
        self.encode = encode  # list of unit strings -> list of id lists
        self.hasher = SpanHasher(seed=3)
        self.hasher.weights = mix64(np.arange(0x110000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.flat = np.empty(1 << 16, dtype=np.uint32)
        self.at = np.zeros(1 << 16, dtype=np.int64)  # unit i has flat[at[i]:at[i + 1]]

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        count = len(self.known)
        if count + len(texts) + 1 >= len(self.at):
            self.at = np.concatenate((self.at, np.zeros(len(self.at) + len(texts), dtype=np.int64)))
        own = self.encode(texts)
        sizes = np.array([len(x) for x in own], dtype=np.int64)
        used, total = int(self.at[count]), int(sizes.sum())
        if used + total > len(self.flat):
            self.flat = np.concatenate((self.flat, np.empty(len(self.flat) + total, dtype=np.uint32)))
        self.flat[used : used + total] = np.fromiter((i for x in own for i in x), dtype=np.uint32, count=total)
        self.at[count + 1 : count + 1 + len(own)] = used + np.cumsum(sizes)
        self.known.update(zip(hashes.tolist(), range(count, count + len(own)), strict=True))

    def ids(self, points: np.ndarray, starts: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds per text) of the units that begin at ``starts`` in
        the code points; ``edges`` are the text bounds, which start units."""
        ends = np.append(starts[1:], len(points))
        hashes = self.hasher.spans(self.hasher.prefix(points), starts, ends)
        distinct, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > MAX_PIECES:
            self._forget()
        index = np.fromiter((self.known.get(h, -1) for h in distinct.tolist()), dtype=np.int64, count=len(distinct))
        new = np.flatnonzero(index < 0)
        if len(new):
            base = len(self.known)
            raw = points.astype("<u4").tobytes()
            spans = zip(starts[where[new]].tolist(), ends[where[new]].tolist(), strict=True)
            self._learn(distinct[new], [raw[4 * a : 4 * b].decode("utf-32-le") for a, b in spans])
            index[new] = base + np.arange(len(new))
        unit = index[inverse]
        first, size = self.at[unit], self.at[unit + 1] - self.at[unit]
        run = np.concatenate(([0], np.cumsum(size)))
        ids = self.flat[np.arange(run[-1]) + np.repeat(first - run[:-1], size)]
        return ids, run[np.searchsorted(starts, edges)]


class PieceEncoder:
    """Encodes Arrow string columns to flat ids."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        pre = spec.get("pre_tokenizer") or {}
        self.by_piece = (
            pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space", True)
            and not spec.get("normalizer")
            and spec["model"].get("type") == "BPE"
        )
        self.model, self.split = self.tokenizer.model, self.tokenizer.pre_tokenizer
        self.alphabet = byte_alphabet()
        self.kind = np.full(0x110000, UNKNOWN, dtype=np.uint8)
        self.table = UnitTable(self._encode_units)

    def _encode_units(self, units: list[str]) -> list[list[int]]:
        mapped = (u.encode("utf-8").decode("latin-1").translate(self.alphabet) for u in units)
        return [[t.id for t in self.model.tokenize(m)] for m in mapped]

    def _learn_characters(self, points: np.ndarray) -> np.ndarray:
        kinds = self.kind[points]
        for c in np.unique(points[kinds == UNKNOWN]).tolist():
            for kind, probe in ((LETTER, "a"), (NUMBER, "1"), (OTHER, ".")):
                if len(self.split.pre_tokenize_str(probe + chr(c))) == 1:
                    self.kind[c] = kind
                    break
            else:
                self.kind[c] = SPACE
        return self.kind[points]

    def piece_starts(self, points: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Start of every piece; ``edges`` are the text bounds."""
        n = len(points)
        kinds = self._learn_characters(points)
        cut = np.zeros(n + 1, dtype=bool)
        cut[1:n] = kinds[1:] != kinds[:-1]
        edge = np.zeros(n + 1, dtype=bool)
        edge[edges] = True
        cut |= edge
        cut[n] = True
        # a space run before another run of its text gives up its last character:
        # a blank joins the next piece, another white space stands alone
        ends = np.flatnonzero(cut[1:] & ~edge[1:] & (kinds == SPACE))
        blank = points[ends] == 0x20
        cut[ends[blank] + 1] = False
        cut[ends] = True
        # contractions: a lone apostrophe that starts a piece, then letters
        lone = np.flatnonzero((points == 0x27) & cut[:n] & cut[1:] & ~edge[1:])
        for i in lone.tolist():
            if i + 1 < n and kinds[i + 1] == LETTER:
                for suffix in CONTRACTIONS:
                    stop = i + 1 + len(suffix)
                    if stop <= n and not edge[i + 2 : stop].any() and "".join(map(chr, points[i + 1 : stop])) == suffix:
                        cut[i + 1] = False
                        cut[stop] = True
                        break
        return np.flatnonzero(cut[:n])

    def _encode_pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        heads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        edges = heads[offsets]
        return self.table.ids(points, self.piece_starts(points, edges), edges)

    def chunks(self, column: pa.Array):
        """Yield (first row, ids, bounds): the ids of row first + i are
        ids[bounds[i]:bounds[i + 1]]; null counts as empty."""
        for row, data, offsets in text_chunks(column):
            n = len(offsets) - 1
            raw = data.tobytes()
            if self.by_piece and not any(a.encode() in raw for a in self.added):
                ids, bounds = self._encode_pieces(data, offsets) if len(data) else (np.empty(0, np.uint32), np.zeros(n + 1, np.int64))
            else:
                texts = [raw[a:b].decode("utf-8") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                own = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
                ids = np.fromiter((x for e in own for x in e), dtype=np.uint32)
                bounds = np.cumsum([0, *map(len, own)])
            yield row, ids, bounds


def kept_in_worker(kind: type, path: str):
    """``kind(path)``, made once in this worker process and kept between
    tasks."""
    holder = sys.modules.setdefault("_quillstream_worker_state", types.ModuleType("_quillstream_worker_state"))
    made = holder.__dict__.setdefault("encoders", {})
    if (kind.__name__, path) not in made:
        made[kind.__name__, path] = kind(path)
    return made[kind.__name__, path]


def encoder(path: str) -> PieceEncoder:
    return kept_in_worker(PieceEncoder, path)
