"""Token-id files: independent zstandard frames, a trailing seek table and per-frame checksums.

A file holds one frame per document, then a skippable frame with the document ids, then the seek
table of the public "zstd seekable format": per frame the compressed size, the decompressed size and
the low 32 bits of the XXH64 of its content, then a footer.  A plain zstd decoder reads the file
front to back; ``SeekableReader`` reads single documents without touching the others.

``write_frames`` range-partitions documents by id, so that the files in shard order hold all documents
in ascending ``doc_id`` order; each task streams one file to the shared folder and returns its
manifest row.  A retried task writes another file; only the one in the manifest counts.

Defined cases: a null or empty text is a document with the end id alone; documents of equal id
follow one another in the order of their texts' hash; a null id sorts first; an empty table gives no files and
an empty manifest; other columns of the input are left out.
"""

from __future__ import annotations

import io
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import id_text, materialize, scratch
from .tokens import crc32, encoder

# Fixed values of the zstd seekable format.
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SKIPPABLE_DOC_IDS = 0x184D2A5D
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
NULL_ID = -(2**63)

MANIFEST = "shard int, path string, n_docs long, n_tokens long, n_bytes long"
FRAMES = "shard int, frame long, doc_id long, n_tokens long, ids_crc32 long, before long"


class SeekableWriter:
    """Streams frames to an open binary file."""

    def __init__(self, out, level: int = 3):
        self.out, self.packer = out, zstandard.ZstdCompressor(level=level, write_checksum=False, write_content_size=True)
        self.entries, self.doc_ids, self.size = bytearray(), [], 0

    def add(self, doc_id: int | None, raw: bytes) -> None:
        frame = self.packer.compress(raw)
        self.entries += struct.pack("<III", len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF)
        self.doc_ids.append(NULL_ID if doc_id is None else doc_id)
        self.out.write(frame)
        self.size += len(frame)

    def close(self) -> int:
        """Write ids, seek table and footer; the file's size."""
        ids = np.array(self.doc_ids, dtype="<i8").tobytes()
        table = bytes(self.entries) + struct.pack("<IBI", len(self.doc_ids), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        for magic, body in ((SKIPPABLE_DOC_IDS, ids), (SKIPPABLE_SEEK_TABLE, table)):
            self.out.write(struct.pack("<II", magic, len(body)) + body)
            self.size += 8 + len(body)
        return self.size


class SeekableReader:
    """Random access to the frames of an open, seekable binary file of ``size`` bytes."""

    def __init__(self, source, size: int):
        self.source, self.unpacker = source, zstandard.ZstdDecompressor()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("not a seekable file with checksums")
        start = size - 9 - 12 * n
        self.entries = np.frombuffer(self._at(start, 12 * n), dtype="<u4").reshape(n, 3)
        self.offsets = np.concatenate([[0], np.cumsum(self.entries[:, 0], dtype=np.int64)])
        self.doc_ids = np.frombuffer(self._at(int(self.offsets[-1]) + 8, 8 * n), dtype="<i8")

    def _at(self, offset: int, n: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(n)

    def __len__(self) -> int:
        return len(self.entries)

    def _content(self, k: int, frame: bytes) -> bytes:
        raw = self.unpacker.decompress(frame, max_output_size=int(self.entries[k, 1]))
        if len(raw) != self.entries[k, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.entries[k, 2]:
            raise ValueError(f"frame {k}: checksum does not match")
        return raw

    def frame(self, k: int) -> bytes:
        """The content of frame ``k``; reads that frame alone."""
        return self._content(k, self._at(int(self.offsets[k]), int(self.entries[k, 0])))

    def document(self, doc_id: int) -> list[bytes]:
        """The contents of the frames of a document id."""
        lo, hi = np.searchsorted(self.doc_ids, [doc_id, doc_id + 1])
        return [self.frame(k) for k in range(lo, hi)]

    def frames(self, together: int = 4 << 20) -> Iterator[tuple[int, bytes]]:
        """All frames in order, read in runs of about ``together`` bytes."""
        k = 0
        while k < len(self):
            stop = max(k + 1, int(np.searchsorted(self.offsets, self.offsets[k] + together)) - 1)
            run = self._at(int(self.offsets[k]), int(self.offsets[stop] - self.offsets[k]))
            for j in range(k, stop):
                a = int(self.offsets[j] - self.offsets[k])
                yield j, self._content(j, run[a : a + int(self.entries[j, 0])])
            k = stop


def open_uri(uri: str, mode: str):
    """An open file of any file system that Arrow knows, and its size when reading."""
    fs, path = pa.fs.FileSystem.from_uri(uri)
    if mode == "r":
        return fs.open_input_file(path), fs.get_file_info(path).size
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return fs.open_output_stream(path, compression=None), None


def write_frames(docs: DataFrame, folder: str, tokenizer: str, end_id: int, shards: int | None = None) -> DataFrame:
    """Encode and write all documents; the manifest, one row per file, in shard order.

    ``docs`` has ``doc_id`` and ``text``; ``shards`` is ``spark.sql.shuffle.partitions`` by default.
    """
    n = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"

    def write(batches):
        shard = TaskContext.get().partitionId()
        path, out, to, tokens = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.ids.zst", None, None, 0
        encode, end = encoder(tokenizer).ids, struct.pack("<I", end_id)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if out is None:
                    out = open_uri(path, "w")[0]
                    to = SeekableWriter(out)
                raw = encode(text) + end
                to.add(doc_id, raw)
                tokens += len(raw) // 4
        if out is not None:
            size = to.close()
            out.close()
            yield pa.RecordBatch.from_pylist(
                [{"shard": shard, "path": path, "n_docs": len(to.doc_ids), "n_tokens": tokens, "n_bytes": size}],
                schema=pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64())]),
            )

    tie = F.xxhash64("text")
    dealt = id_text(docs).withColumn("tie", tie).repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    return materialize(dealt.select("doc_id", "text").mapInArrow(write, MANIFEST), "manifest")


def read_frames(manifest: DataFrame) -> DataFrame:
    """Every frame of the files of a manifest: shard, frame, doc_id, n_tokens, ids_crc32 and ``before``, the ids before it in its file."""

    def read(batches):
        for batch in batches:
            for shard, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                source, size = open_uri(path, "r")
                with source:
                    files = SeekableReader(source, size)
                    crcs = np.fromiter((crc32(raw) for _, raw in files.frames()), dtype=np.int64, count=len(files))
                lengths = files.entries[:, 1].astype(np.int64) // 4
                ids = pa.array(files.doc_ids, mask=files.doc_ids == NULL_ID)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(files), shard, dtype=np.int32)), pa.array(np.arange(len(files))), ids, pa.array(lengths), pa.array(crcs), pa.array(np.cumsum(lengths) - lengths)],
                    names=["shard", "frame", "doc_id", "n_tokens", "ids_crc32", "before"],
                )

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("shard", "path").repartition(n).mapInArrow(read, FRAMES)


def lookup(manifest: DataFrame, wanted: DataFrame) -> DataFrame:
    """The ids of the wanted ``doc_id`` rows alone: each file's seek table is read, and no frame but theirs."""

    def read(batches):
        for batch in batches:
            for path, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                source, size = open_uri(path, "r")
                with source:
                    files = SeekableReader(source, size)
                    rows = [{"doc_id": i, "ids": np.frombuffer(raw, "<u4").tolist()} for i in sorted(set(ids)) for raw in files.document(i)]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))]))

    index = read_ids(manifest)
    hits = index.join(wanted.select(F.col("doc_id").cast("long")).distinct(), "doc_id", "left_semi")
    return hits.groupBy("path", F.floor(F.col("frame") / 4096)).agg(F.collect_set("doc_id").alias("ids")).select("path", "ids").mapInArrow(read, "doc_id long, ids array<long>")


def read_ids(manifest: DataFrame) -> DataFrame:
    """path, frame and doc_id of every frame, from the files' tails alone."""

    def read(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                source, size = open_uri(path, "r")
                with source:
                    ids = SeekableReader(source, size).doc_ids
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(ids), pa.string()), pa.array(np.arange(len(ids))), pa.array(ids, mask=ids == NULL_ID)], names=["path", "frame", "doc_id"])

    return manifest.select("path").mapInArrow(read, "path string, frame long, doc_id long")


def token_files(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Write the files and read them back: doc_id, start, n_tokens, ids_crc32, shard and frame.

    ``start`` counts the ids of all documents before it; the running sum across files is over one row per file.
    """
    manifest = write_frames(docs, folder or scratch(docs.sparkSession, "token-files"), tokenizer, end_id)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = manifest.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    frames = read_frames(manifest).join(F.broadcast(base), "shard")  # a row per file, of which there are as many as shuffle partitions
    return frames.select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "shard", "frame")


def encode_buffer(items: list[tuple[int, bytes]]) -> bytes:
    """One file's bytes in memory."""
    out = io.BytesIO()
    to = SeekableWriter(out)
    for doc_id, raw in items:
        to.add(doc_id, raw)
    to.close()
    return out.getvalue()
