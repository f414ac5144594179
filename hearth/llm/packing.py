"""Bounded-space online packing of token sequences into fixed windows.

Each partition of the input keeps ``open_windows`` windows open. A document's
whole windows are cut off first; the rest goes to the open window where it leaves
the least room. Where none has room, the fullest is topped up with the head of the
piece and emitted, and an empty window opens in its place. What is still open at
the end of a partition is merged: leftovers of ``fan_in`` partitions at a time are
packed anew in the same way, until one task holds the last ``open_windows``. Those
are joined end to end; only the last window is short, and is cut into sequences
of power-of-two length, which need no padding.

Every round is written to the shared folder. A task holds its open windows and one
document; no rows are grouped by key, so no key can be hot. Null texts are empty
and consist of the end token; repeated rows and ids are packed as documents of their own. A very long text is
cut into whole windows as it comes. Only the two named columns are read, so other columns cannot clash. An empty table gives no pieces.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.bpe import Cache, byte_alphabet, chunks
from hearth.llm.common import materialize

WINDOW = 4096
OPEN_WINDOWS = 32
FAN_IN = 16
#: Chunks of each of the two generations whose ids a worker keeps for its tasks.
CACHE_CHUNKS = 200_000
#: Bytes of ids in finished windows that a task holds before it passes them on.
BATCH_BYTES = 8 << 20
PIECES = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary, sequence_id bigint, offset bigint, open boolean"
_NAMES = ["doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset", "open"]
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()]

Piece = tuple[int | None, int, int, bytes]  # id, start, tokens of the document, ids as little-endian uint32


class _ChunkIds(Cache):
    """Ids of a chunk of text as bytes, by the tokenizers library; bounded."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__(self._library_ids, CACHE_CHUNKS)
        self.tokenizer = Tokenizer.from_file(path)
        self.letters = byte_alphabet()

    def _library_ids(self, chunk: str) -> bytes:
        if chunk.isalpha() and len(chunk) <= 64 and (chunk.isascii() or max(chunk) < "\u0250"):  # one word, normalised already: only the model is needed
            word = chunk if chunk.isascii() else "".join([self.letters[b] for b in chunk.encode()])
            return array("I", [t.id for t in self.tokenizer.model.tokenize(word)]).tobytes()
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()


@lru_cache(1)
def _chunk_ids(path: str) -> _ChunkIds:
    return _ChunkIds(path)  # for all tasks of a worker


def tokens(path: str, end: int) -> Callable[[], Callable[[str | None], bytes]]:
    """Makes a function from a text to its ids and the end token, as little-endian uint32."""

    def make():
        ids = _chunk_ids(path)
        last = np.array([end], "<u4").tobytes()
        return lambda text: b"".join([*map(ids.__getitem__, chunks(text or "")), last])

    return make


class Windows:
    """The open windows of one task, and the pieces of those that are full."""

    def __init__(self, first: int, size: int, count: int):
        self.next, self.size, self.count = first, size, count
        self.open: dict[int, tuple[int, list[Piece]]] = {}  # sequence: room, pieces
        self.done: list[tuple] = []
        self.bytes = 0

    def _emit(self, sequence: int, pieces: list[Piece], still_open: bool = False) -> None:
        offset = 0
        for doc, start, total, ids in pieces:
            n = len(ids) // 4
            self.done.append((doc, start, n, total, ids, sequence, offset, still_open))
            self.bytes += len(ids)
            offset += n

    def add(self, doc, start: int, total: int, ids: bytes) -> None:
        while len(ids) // 4 >= self.size:
            self._emit(self.next, [(doc, start, total, ids[: 4 * self.size])])
            self.next += 1
            start, ids = start + self.size, ids[4 * self.size :]
        while n := len(ids) // 4:
            fits = [(room, s) for s, (room, _) in self.open.items() if room >= n]
            if not fits and len(self.open) < self.count:
                self.open[self.next] = (self.size, [])
                fits = [(self.size, self.next)]
                self.next += 1
            room, s = min(fits) if fits else min((room, s) for s, (room, _) in self.open.items())
            cut = min(n, room)
            pieces = self.open.pop(s)[1]
            pieces.append((doc, start, total, ids[: 4 * cut]))
            if cut == room:
                self._emit(s, pieces)
            else:
                self.open[s] = (room - cut, pieces)
            start, ids = start + cut, ids[4 * cut :]

    def leave_open(self) -> None:
        for s, (_, pieces) in sorted(self.open.items()):
            self._emit(s, pieces, True)
        self.open = {}

    def close(self) -> None:
        """Joins what is open end to end; the last, short window is cut at powers of two."""
        rest = [p for _, (_, pieces) in sorted(self.open.items()) for p in pieces]
        self.open = {}
        left = sum(len(p[3]) // 4 for p in rest)
        while left:
            room = size = self.size if left >= self.size else 1 << (left.bit_length() - 1)
            taken: list[Piece] = []
            while room:
                doc, start, total, ids = rest.pop(0)
                cut = min(room, len(ids) // 4)
                taken.append((doc, start, total, ids[: 4 * cut]))
                if cut < len(ids) // 4:
                    rest.insert(0, (doc, start + cut, total, ids[4 * cut :]))
                room -= cut
            self._emit(self.next, taken)
            self.next += 1
            left -= size

    def batch(self) -> pa.RecordBatch:
        rows, self.done, self.bytes = self.done, [], 0
        cols = list(zip(*rows, strict=True)) if rows else [[]] * len(_NAMES)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES, strict=True)], names=_NAMES)


def _first_sequence(round_: int) -> int:
    return (round_ << 56) | (TaskContext.get().partitionId() << 32)


def pack(
    docs: DataFrame, encode: Callable[[], Callable[[str | None], bytes]], id_col: str = "doc_id", text_col: str = "text",
    window: int = WINDOW, open_windows: int = OPEN_WINDOWS, fan_in: int = FAN_IN,
) -> DataFrame:
    """Pieces of all documents: (doc_id, start, length, doc_tokens, ids, sequence_id, offset).

    ``ids`` are little-endian unsigned 32-bit numbers. ``encode`` makes, once a
    task, the function from a text to the ids of its document.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, w = encode(), Windows(_first_sequence(0), window, open_windows)
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = f(text.as_py())
                w.add(doc, 0, len(ids) // 4, ids)
                if w.bytes >= BATCH_BYTES:
                    yield w.batch()
        w.leave_open()
        yield w.batch()

    def merge(round_: int, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w = Windows(_first_sequence(round_), window, open_windows)
            for b in batches:
                for doc, start, total, ids in zip(*(b.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids")), strict=True):
                    w.add(doc, start, total, ids)
                    if w.bytes >= BATCH_BYTES:
                        yield w.batch()
            if last:
                w.close()
            else:
                w.leave_open()
            yield w.batch()

        return run

    source = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    out = materialize(source.mapInArrow(first, PIECES), "pack-0")
    done = [out.where("not open")]
    task = f"(shiftright(sequence_id, 32) & {(1 << 24) - 1})"
    tasks = (out.where("open").agg(F.max(F.expr(task))).first()[0] or 0) + 1
    round_ = 0
    while True:
        # leftovers are at most open_windows windows a task, so fan_in tasks' fit one
        round_ += 1
        tasks = -(-tasks // fan_in)
        left = out.where("open").withColumn("__g", F.expr(f"cast({task} div {fan_in} as int)"))
        dealt = left.repartitionByRange(tasks, "__g") if tasks > 1 else left.coalesce(1)
        dealt = dealt.sortWithinPartitions("sequence_id", "offset").drop("__g")
        out = materialize(dealt.mapInArrow(merge(round_, tasks == 1), PIECES), f"pack-{round_}")
        done.append(out.where("not open"))
        if tasks == 1:
            break
    whole = done[0]
    for d in done[1:]:
        whole = whole.union(d)
    return whole.drop("open")

