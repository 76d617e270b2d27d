"""Token ids in files of independent zstandard frames, with a seek table and checksums.

A file is a row of frames, each a run of little-endian unsigned 32-bit ids, then an index of its
documents (doc_id, first id, number of ids) in a skippable frame, then the seek table of the public
zstandard seekable format: the compressed size, plain size and checksum of each frame. Any zstandard
tool can read the ids; a reader that wants some documents decompresses only the frames they lie in.
Documents may span frames, so no frame, and nothing held in memory, grows with a document's length.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled, shared_folder, sheltered, text_of
from .files import create, open_random
from .tokens import BYTES, encoder, vocabulary

#: Fixed values of the seekable format and of the skippable frame that holds the index.
SEEK_MAGIC, SEEK_FOOTER, INDEX_MAGIC, CHECKED = 0x184D2A5E, 0x8F92EAB1, 0x184D2A5B, 0x80

#: Plain bytes of a frame.
FRAME = 1 << 18

END = 2

INDEX = np.dtype([("id", "<i8"), ("null", "<u1"), ("first", "<u8"), ("n", "<u8")])


class Damaged(ValueError):
    """A file does not hold what its checksums say."""


class Writer:
    """Writes one file. Holds a frame, the frame list and the document index."""

    def __init__(self, out, frame: int = FRAME, level: int = 3):
        self.out, self.frame = out, frame
        self.pack = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True).compress
        self.waiting, self.size, self.frames, self.docs, self.total = [], 0, [], [], 0

    def _flush(self, plain: bytes) -> None:
        packed = self.pack(plain)
        self.out.write(packed)
        self.frames.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // 4
        self.docs.append((doc_id or 0, doc_id is None, self.total, n))
        self.total += n
        self.waiting.append(ids)
        self.size += len(ids)
        if self.size >= self.frame:
            plain = b"".join(self.waiting)
            cut = len(plain) - len(plain) % self.frame
            for i in range(0, cut, self.frame):
                self._flush(plain[i : i + self.frame])
            self.waiting, self.size = [plain[cut:]], len(plain) - cut

    def close(self) -> None:
        if self.size:
            self._flush(b"".join(self.waiting))
        index = self.pack(np.array(self.docs, dtype=INDEX).tobytes())
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(table) + 9) + table)
        self.out.write(struct.pack("<IBI", len(self.frames), CHECKED, SEEK_FOOTER))
        self.out.close()


@dataclass
class Reader:
    """Reads documents of one file; ``plain`` counts the bytes it had to decompress."""

    source: object
    plain: int = 0

    def __post_init__(self) -> None:
        size = self.source.size()
        count, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_FOOTER or not flags & CHECKED:
            raise Damaged("no seek table with checksums")
        table = np.frombuffer(self._at(size - 9 - 12 * count, 12 * count), dtype="<u4").reshape(-1, 3).astype(np.int64)
        self.sizes, self.sums = table[:, 1], table[:, 2]
        self.places = np.concatenate([[0], table[:, 0].cumsum()])
        self.starts = np.concatenate([[0], table[:, 1].cumsum()])
        at = int(self.places[-1])
        magic, length = struct.unpack("<II", self._at(at, 8))
        if magic != INDEX_MAGIC:
            raise Damaged("no document index")
        self.index = np.frombuffer(zstandard.ZstdDecompressor().decompress(self._at(at + 8, length)), dtype=INDEX)
        self._held = (-1, b"")

    def _at(self, place: int, n: int) -> bytes:
        self.source.seek(place)
        return self.source.read(n)

    def _frame(self, k: int) -> bytes:
        if self._held[0] != k:
            packed = self._at(int(self.places[k]), int(self.places[k + 1] - self.places[k]))
            plain = zstandard.ZstdDecompressor().decompress(packed)
            if len(plain) != self.sizes[k] or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.sums[k]:
                raise Damaged(f"frame {k}")
            self._held = (k, plain)
            self.plain += len(plain)
        return self._held[1]

    def parts(self, place: int) -> Iterator[bytes]:
        """The ids of the document at a place of the index, frame by frame."""
        begin = int(self.index["first"][place]) * 4
        end = begin + int(self.index["n"][place]) * 4
        k = int(np.searchsorted(self.starts, begin, side="right")) - 1
        while begin < end:
            frame = self._frame(k)
            piece = frame[begin - int(self.starts[k]) : end - int(self.starts[k])]
            yield piece
            begin += len(piece)
            k += 1

    def ids(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of all documents with this id."""
        found = np.flatnonzero((self.index["null"] == (doc_id is None)) & (self.index["id"] == (doc_id or 0)))
        return [np.frombuffer(b"".join(self.parts(int(i))), dtype="<u4") for i in found]


def write(docs: DataFrame, folder: str, path: str | None = None, end: int = END, frame: int = FRAME) -> DataFrame:
    """Encode and write all texts in ascending order of doc_id; returns the files with their order and sizes.

    Rows are dealt by ranges of doc_id and text, so rows of one id can lie in several files. Null
    doc_ids come first; null texts are empty; equal rows are documents of their own. Each task holds one
    batch of rows and one frame. The returned table is written before it is returned.
    """
    path = path or vocabulary("byte_bpe_50k.json")
    tail = struct.pack("<I", end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            if writer is None and batch.num_rows:
                encode, shard = encoder(path, BYTES), TaskContext.get().partitionId()
                name, out = create(folder, f"part-{shard:06d}", ".ids.zst")
                writer = Writer(out, frame)
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                writer.add(doc_id, encode(text) + tail)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [name], "n_docs": [len(writer.docs)], "n_ids": [writer.total]})

    docs, _ = sheltered(docs, "doc_id", "text")
    rows = docs.select(F.col("doc_id").cast("long"), text_of("text").alias("text"))
    dealt = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    return settled(dealt.mapInArrow(run, "shard long, path string, n_docs long, n_ids long"), "token-manifest")


def read(manifest: DataFrame) -> DataFrame:
    """Every document of the files: doc_id, ids of all documents before it, its ids' number and CRC-32."""
    order = manifest.select("path", "shard", "n_ids")
    before = order.selectExpr("path", "coalesce(sum(n_ids) OVER (ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with open_random(path) as source:
                    reader = Reader(source)
                    found = reader.index
                    sums = []
                    for i in range(len(found)):
                        crc = 0
                        for part in reader.parts(i):
                            crc = zlib.crc32(part, crc)
                        sums.append(crc)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(found["id"], mask=found["null"].astype(bool)),
                            pa.array(found["first"].astype(np.int64) + base),
                            pa.array(found["n"].astype(np.int64)),
                            pa.array(np.array(sums, dtype=np.int64)),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    # one file to a task where there are as many tasks; a file is the unit of reading anew
    files = before.repartition(max(1, manifest.count()), "path")
    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, path: str | None = None, end: int = END, frame: int = FRAME) -> DataFrame:
    """Write ``docs`` to files in the shared folder and report what is read back, one row per document."""
    folder = shared_folder(docs.sparkSession, "token-files")
    back = read(write(docs, folder, path, end, frame))
    return back.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
