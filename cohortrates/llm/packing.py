"""Packing of token documents into windows with almost no padding, by minimum bin slack.

Whole windows of a long document are cut off it; what remains is shorter than a window. For each window
the longest remainder is taken first. A subset-sum over the lengths that are left, kept as one bitset of
reachable sums per length, finds the multiset that comes closest to the capacity, and walking the bitsets
back tells how many of each length it takes. A window that stays short is filled by cutting the next
remainder. The last tokens of a task are cut into windows that are a power of two long, which need no
padding.

A task packs the documents of its own partition, block by block, so nothing is shuffled and memory is
bounded by a block.
"""

from __future__ import annotations

import struct
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import sheltered, text_of
from .tokens import WORDS, encoder, vocabulary

WINDOW = 2048
END = 1

#: Tokens a task holds before it packs what it has; the rest is carried over.
BLOCK = 8_000_000

#: A piece: the document, the first of its ids, and how many.
Piece = tuple[int, int, int]


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length to take so that their sum comes closest to ``room`` from below.

    ``counts`` has the number of remainders by length. Bit s of a bitset tells that the sum s can be
    reached with the lengths so far. The search ends early once the room can be filled to the last.
    """
    full = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        if length > room:
            continue
        before, left, part = reach, counts[length], 1
        while left:  # 1, 2, 4, ... of a length at a time
            part = min(part, left)
            reach |= (reach << (length * part)) & full
            left -= part
            part *= 2
        steps.append((length, before))
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    taken = {}
    for length, before in reversed(steps):
        n = 0
        while not before >> total & 1:
            total -= length
            n += 1
        if n:
            taken[length] = n
    return taken


def pack_lengths(docs: Iterable[tuple[int, int]], window: int, last: bool) -> tuple[list[list[Piece]], list[Piece]]:
    """Windows made of pieces of the documents (number, length), and the pieces left for a later call.

    With ``last`` nothing is left: the final pieces become windows of a power of two each.
    """
    windows: list[list[Piece]] = []
    rest: dict[int, list[Piece]] = defaultdict(list)
    for doc, length in docs:
        cut = length - length % window
        windows += [[(doc, at, window)] for at in range(0, cut, window)]
        if length > cut:
            rest[length - cut].append((doc, cut, length - cut))
    counts = {n: len(pieces) for n, pieces in rest.items()}
    total = sum(n * c for n, c in counts.items())

    def take(length: int) -> Piece:
        counts[length] -= 1
        if not counts[length]:
            del counts[length]
        return rest[length].pop()

    def put(piece: Piece) -> None:
        rest[piece[2]].append(piece)
        counts[piece[2]] = counts.get(piece[2], 0) + 1

    def fill(size: int) -> list[Piece]:
        nonlocal total
        inside = [take(max((n for n in counts if n <= size), default=max(counts)))]
        room = size - inside[0][2]
        if room < 0:
            doc, at, n = inside[0]
            inside, room = [(doc, at, size)], 0
            put((doc, at + size, n - size))
        if room:
            for length, n in best_fill(counts, room).items():
                inside += [take(length) for _ in range(n)]
                room -= length * n
        if room:  # no multiset fills it: cut a longer remainder
            doc, at, n = take(min(counts))
            inside.append((doc, at, room))
            put((doc, at + room, n - room))
        total -= size
        return inside

    while total >= window:
        windows.append(fill(window))
    if not last:
        return windows, [p for n in counts for p in rest[n]]
    while total:
        windows.append(fill(1 << (total.bit_length() - 1)))
    return windows, []


def pack_documents(
    docs: Iterable[tuple[object, bytes]], window: int = WINDOW, block: int = BLOCK
) -> Iterator[tuple[object, int, int, int, int, int, int]]:
    """doc_id, start, length, CRC-32 of the ids, ids of the document, window number, and place in the window.

    Takes documents as (doc_id, ids in 32 bits each). Holds the documents of a block.
    """
    held: dict[int, tuple[object, bytes, int, int]] = {}
    waiting: list[tuple[int, int]] = []
    number = made = size = 0

    def emit(last: bool) -> Iterator[tuple]:
        nonlocal made, waiting, held, size
        windows, left = pack_lengths(waiting, window, last)
        for pieces in windows:
            place = 0
            for doc, at, n in pieces:
                doc_id, ids, base, whole = held[doc]
                yield doc_id, base + at, n, zlib.crc32(memoryview(ids)[4 * at : 4 * (at + n)]), whole, made, place
                place += n
            made += 1
        kept = {doc: (held[doc][0], held[doc][1][4 * at :], held[doc][2] + at, held[doc][3]) for doc, at, _ in left}
        waiting, held, size = [(doc, n) for doc, _, n in left], kept, 0

    for doc_id, ids in docs:
        n = len(ids) // 4
        held[number] = (doc_id, ids, 0, n)
        waiting.append((number, n))
        number += 1
        size += n
        if size >= block:
            yield from emit(last=False)
    yield from emit(last=True)


SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(
    docs: DataFrame, path: str | None = None, end: int = END, window: int = WINDOW, block: int = BLOCK
) -> DataFrame:
    """Encode and pack every row of ``docs``; one row per piece.

    Null and empty texts are documents of the end id alone; equal rows are documents of their own. The
    sequence_id is the partition's number and a count within it. Only doc_id and text are read.
    """
    path = path or vocabulary("word_bpe_49k.json")
    tail = struct.pack("<I", end)
    docs, _ = sheltered(docs, "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = []

        def documents() -> Iterator[tuple[object, bytes]]:
            encode = encoder(path, WORDS)
            for batch in batches:
                seen[:] = [batch.schema.field(0).type]
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    yield doc_id, encode(text) + tail

        rows, first = [], TaskContext.get().partitionId() << 40

        def table() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(columns[0], seen[0])] + [pa.array(c, pa.int64()) for c in columns[1:]]
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", *[x.split()[0] for x in SCHEMA.split(", ")]])

        for doc_id, start, length, crc, whole, sequence, place in pack_documents(documents(), window, block):
            rows.append((doc_id, start, length, crc, whole, first + sequence, place))
            if len(rows) == 10_000:
                yield table()
                rows.clear()
        if rows:
            yield table()

    return docs.select("doc_id", text_of("text").alias("text")).mapInArrow(run, f"doc_id {kind}, {SCHEMA}")
