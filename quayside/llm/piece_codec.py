"""SentencePiece encoding and decoding by an Aho-Corasick Viterbi pass.

An automaton over the model's pieces reports, at each position, every piece that
ends there (its output links, longest first); each report relaxes the best score of that
position from the best score of its start. One pass over a unit and a walk
back give the best segmentation.

A text is cut into units before each run of spaces: no piece holds a space after another
character (checked at load), so units never share a piece, the best path of the text is the
paths of its units, and a unit seen before is looked up.

Scores are the model's own. A model of type BPE keeps its pieces and scores, and its text is
encoded as the unigram model of the same pieces (the best of the library's exact n-best search once
the model's type field says unigram); merges by rank are no Viterbi path. Ties go to
the longer last piece.

Defined results: null and empty texts have no ids. Characters without a piece become their
UTF-8 bytes' pieces. Decoding gives the text back, except that U+2581 becomes the space it
stands for. Repeated rows repeat; other columns pass through.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SPACE = "▁"
MEMO = 1_000_000  # units remembered by a worker process
_UNIT = re.compile(f"{SPACE}+[^{SPACE}]*")


class PieceCodec:
    def __init__(self, model_path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=model_path)
        n = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        pieces = [sp.id_to_piece(i) for i in range(n)]
        self.automaton = ahocorasick.Automaton()
        scores = []
        for i, piece in enumerate(pieces):
            if not special[i] and not sp.is_unused(i):
                if SPACE in piece.lstrip(SPACE):
                    raise ValueError(f"piece {piece!r} holds a space after another character")
                scores.append(sp.get_score(i))
                self.automaton.add_word(piece, (len(piece), i, scores[-1]))
        self.automaton.make_automaton()
        self.unknown = min(scores) - 10
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        table = [b"" if special[i] else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        for b, i in enumerate(self.byte):
            table[i] = bytes([b])
        self.table = table
        self.memo: dict[str, bytes] = {}

    def segment(self, unit: str) -> list[int]:
        """The best path through one unit."""
        n = len(unit)
        best = [0.0] + [-np.inf] * n
        via: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        reached = 0  # positions up to here are final: reports come by rising end

        def settle(upto: int) -> None:
            # a character that no single piece covers may stand for its bytes
            for at in range(reached + 1, upto + 1):
                if not covered[at] and best[at - 1] + self.unknown > best[at]:
                    best[at], via[at] = best[at - 1] + self.unknown, (at - 1, -1)

        covered = [False] * (n + 1)
        reports: list[tuple[int, int, int, float]] = []
        for end, (length, piece, score) in self.automaton.iter(unit):
            end += 1
            if end > reached + 1:
                settle(end - 1)
                reached = end - 1
            start = end - length
            if length == 1:
                covered[end] = True
            if best[start] + score > best[end]:
                best[end], via[end] = best[start] + score, (start, piece)
        settle(n)
        out: list[int] = []
        at = n
        while at:
            start, piece = via[at]
            if piece < 0:
                out.extend(self.byte[b] for b in reversed(unit[start:at].encode("utf-8", "surrogatepass")))
            else:
                out.append(piece)
            at = start
        return out[::-1]

    def _unit(self, unit: str) -> bytes:
        found = self.memo.get(unit)
        if found is None:
            found = np.array(self.segment(unit), "<i4").tobytes()
            if len(unit) <= 64:
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                self.memo[unit] = found
        return found

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian 32-bit integers."""
        if not text:
            return b""
        units = _UNIT.findall(SPACE + text.replace(" ", SPACE))
        found = list(map(self.memo.get, units))
        if None in found:
            found = [self._unit(u) if f is None else f for u, f in zip(units, found, strict=True)]
        return b"".join(found)

    def decode(self, ids: bytes | np.ndarray) -> str:
        table = self.table
        ids = np.frombuffer(ids, "<i4") if isinstance(ids, bytes) else ids
        out = b"".join([table[i] for i in ids.tolist()])
        return out[1:].decode("utf-8", "replace")


@lru_cache(2)
def codec(model_path: str) -> PieceCodec:
    """One per worker process, so that its memory outlives a task."""
    return PieceCodec(model_path)


def _id_lists(parts: list[bytes]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), "<i4")))


def _added(df: DataFrame, column: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*(f for f in df.schema.fields if f.name != column), T.StructField(column, kind)])


def _kept(df: DataFrame, column: str) -> tuple[list[int], list[str]]:
    keep = [i for i, c in enumerate(df.columns) if c != column]
    return keep, [*(df.columns[i] for i in keep), column]


def _slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def encode(docs: DataFrame, model_path: str, text: str = "text", out: str = "piece_ids") -> DataFrame:
    """``docs`` with the array<int> column ``out``: the ids of each whole ``text``."""
    at = docs.columns.index(text)
    keep, names = _kept(docs, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path)
        for whole in batches:
            for batch in _slices(whole):
                texts = batch.column(at).to_pylist()
                # no cycles arise here, and scanning the memory for some costs a quarter of the time
                gc.disable()
                ids = _id_lists([own.encode(t) for t in texts])
                gc.enable()
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), ids], names)

    return docs.mapInArrow(run, _added(docs, out, T.ArrayType(T.IntegerType())))


def decode(docs: DataFrame, model_path: str, ids: str = "piece_ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the string column ``out``: the text of each id array (null: empty)."""
    at = docs.columns.index(ids)
    keep, names = _kept(docs, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path)
        for whole in batches:
            for batch in _slices(whole):
                lists = batch.column(at)
                flat = lists.flatten().to_numpy().astype("<i4", copy=False)
                ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
                texts = [own.decode(flat[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)] if len(ends) else []
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(texts, pa.string())], names)

    return docs.mapInArrow(run, _added(docs, out, T.StringType()))
