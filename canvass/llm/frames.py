"""Token ids in the public seekable zstandard format, one shard per partition, in the order of the ids.

A shard is a row of independent zstandard frames, then two skippable frames: an index (per frame: first id, whether it
is NULL, number of documents, tokens before the frame) and the seek table (per frame: compressed size, size, checksum;
then the number of frames, a flag byte and the magic number). A frame holds whole documents:

    documents (uint32), then per document id (int64), NULL flag and number of tokens (uint32 each), then all token ids
    (uint32); all little-endian

A frame is closed once it holds FRAME_TOKENS tokens; a longer document has a frame of its own. A reader fetches the
tail, finds the frames of the documents it wants, and decompresses only those; each frame's checksum is verified.

Each shard is written under a new name, and only shards in the manifest (written by Spark, so by the attempts that
succeeded) are read: lost executors leave unread files behind, no wrong ones.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canvass.llm.byte_bpe import ByteBPE
from canvass.llm.common import pieces, python_ready, shared_dir, written

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2
FRAME_TOKENS = 1 << 16
#: Bytes of text encoded at once.
SLICE = 8 << 20
#: Fixed values of the format.
SKIPPABLE_SEEK, SKIPPABLE_INDEX, SEEK_MAGIC, CHECKSUMS = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1, 0x80
_ENTRY, _INDEX, _DOC = struct.Struct("<III"), struct.Struct("<qIIQ"), np.dtype([("id", "<i8"), ("null", "<u4"), ("n", "<u4")])


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


class Writer:
    """Frames written to an open stream."""

    def __init__(self, out):
        self.out, self.packer = out, zstandard.ZstdCompressor(level=3)
        self.table: list[tuple[int, int, int]] = []
        self.index: list[tuple[int, int, int, int]] = []
        self.tokens = self.documents = self.pending = 0
        self.heads: list[tuple[int, int, int]] = []
        self.ids: list[np.ndarray] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if self.heads and self.pending + len(ids) > FRAME_TOKENS:
            self._frame()
        self.heads.append((doc_id or 0, doc_id is None, len(ids)))
        self.ids.append(ids)
        self.pending += len(ids)

    def _frame(self) -> None:
        heads = np.array(self.heads, _DOC)
        body = struct.pack("<I", len(heads)) + heads.tobytes() + np.concatenate(self.ids).astype("<u4").tobytes()
        packed = self.packer.compress(body)
        self.out.write(packed)
        self.table.append((len(packed), len(body), xxhash.xxh64_intdigest(body) & 0xFFFFFFFF))
        self.index.append((*self.heads[0][:2], len(heads), self.tokens))
        self.tokens += self.pending
        self.documents += len(heads)
        self.heads, self.ids, self.pending = [], [], 0

    def close(self) -> None:
        if self.heads:
            self._frame()
        index = b"".join(_INDEX.pack(*x) for x in self.index)
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        seek = b"".join(_ENTRY.pack(*x) for x in self.table) + struct.pack("<IBI", len(self.table), CHECKSUMS, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(seek)) + seek)


class Reader:
    """Random access to the documents of a shard."""

    def __init__(self, file):
        self.file, self.read_bytes = file, 0
        size = file.size()
        count, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or not flags & CHECKSUMS:
            raise ValueError("not a seekable shard")
        seek = count * _ENTRY.size + 9
        self.table = list(_ENTRY.iter_unpack(self._at(size - seek, seek - 9)))
        tail = size - seek - 8
        self.index = list(_INDEX.iter_unpack(self._at(tail - count * _INDEX.size, count * _INDEX.size)))
        self.places = np.concatenate(([0], np.cumsum([x[0] for x in self.table], dtype=np.int64)))

    def _at(self, place: int, size: int) -> bytes:
        self.file.seek(int(place))
        self.read_bytes += size
        return self.file.read(size)

    def frame(self, k: int) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(id, tokens before the document in this shard, ids) of the documents of frame k."""
        packed, size, checksum = self.table[k]
        body = zstandard.ZstdDecompressor().decompress(self._at(self.places[k], packed), max_output_size=size)
        if len(body) != size or xxhash.xxh64_intdigest(body) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k}: wrong checksum")
        (count,) = struct.unpack_from("<I", body)
        heads = np.frombuffer(body, _DOC, count, 4)
        ids = np.frombuffer(body, "<u4", offset=4 + count * _DOC.itemsize)
        ends = np.cumsum(heads["n"], dtype=np.int64)
        for (doc_id, null, n), end in zip(heads.tolist(), ends.tolist(), strict=True):
            yield None if null else doc_id, self.index[k][3] + end - n, ids[end - n : end]

    def documents(self, wanted: int | None) -> list[np.ndarray]:
        """The ids of all documents of that id; only frames that can hold it are decompressed."""
        order = lambda x, null: (0, 0) if null else (1, x)
        key, found = order(wanted, wanted is None), []
        for k, x in enumerate(self.index):
            if order(*x[:2]) > key:
                break
            if k + 1 == len(self.index) or order(*self.index[k + 1][:2]) >= key:
                found += [ids for doc_id, _, ids in self.frame(k) if doc_id == wanted]
        return found


def _writing(folder: str, vocabulary: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        coder, first, writer = ByteBPE(vocabulary), None, None
        system, root = _place(folder)
        path = f"{root}/{uuid.uuid4().hex}.zst"
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                system.create_dir(root, recursive=True)
                writer, first = Writer(stream := system.open_output_stream(path, compression=None)), batch.column(0)[0].as_py()
            for part in pieces(batch, 1, SLICE):
                for doc_id, ids in zip(part.column(0).to_pylist(), coder.encode(part.column(1), end_id), strict=True):
                    writer.add(doc_id, ids)
        if writer:
            writer.close()
            stream.close()
            row = ([path.rsplit("/", 1)[1]], [first], [writer.documents], [writer.tokens], [len(writer.table)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(row, (pa.string(), *[pa.int64()] * 4), strict=True)],
                ["shard", "first_id", "documents", "tokens", "frames"],
            )

    return run


def write_frames(
    docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write the shards and return their manifest: shard, documents, tokens, frames, start (tokens before the shard).

    Rows are in the order of their ids, NULL first, then of their texts. NULL texts are empty: the end id only.
    """
    python_ready(docs.sparkSession)
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")
    ).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "text").select("id", "text")
    order = Window.orderBy("part")
    shards = ordered.mapInArrow(
        _writing(folder, vocabulary, end_id), "shard string, first_id long, documents long, tokens long, frames long"
    )
    manifest = written(shards.withColumn("part", F.spark_partition_id()), "frames-manifest")
    before = F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return manifest.withColumn("start", F.coalesce(before, F.lit(0)))


def _reading(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _place(folder)
        for batch in batches:
            for shard, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with system.open_input_file(f"{root}/{shard}") as file:
                    reader = Reader(file)
                    for k in range(len(reader.table)):
                        rows = [(i, start + at, len(x), zlib.crc32(x.tobytes())) for i, at, x in reader.frame(k)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"]
                        )

    return run


def read_frames(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens and ids_crc32, from the files."""
    python_ready(manifest.sparkSession)
    shards = manifest.select("shard", "start")
    many = max(1, min(manifest.count(), 10_000))
    return shards.repartition(many, "shard").mapInArrow(
        _reading(folder), "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def token_frames(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write `docs` and read the files back: one row per document."""
    folder = folder or shared_dir(docs.sparkSession, "frames")
    return read_frames(write_frames(docs, folder, **options), folder)
