"""Token-id files: fixed-width bit packing with block offsets.

A shard file holds, in this order,

    16 bytes   magic "LMTOKEN1", then id width in bits and ids per block (two little-endian uint32)
    blocks     each block's ids, packed least significant bit first, padded to a byte
    doc table  per document: int64 doc_id, uint64 index of its first id, uint8 doc_id is null
    offsets    uint64 file offset of every block, and of their end
    32 bytes   n_docs, n_ids, n_blocks, offset of the doc table (four little-endian uint64)

Any id range is read by seeking to the blocks that cover it and unpacking them with
numpy. Writers give every attempt a file name of its own and only the manifest,
built from the attempts that Spark accepted, says which files count; a lost
executor leaves at most an unlisted file behind.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.chunks import grouped
from leafmill.llm.tokenizers_fast import json_tokenizer
from leafmill.runtime import shared_dir, ship_package

MAGIC = b"LMTOKEN1"
HEADER, TRAILER = 16, 32
MANIFEST = "shard int, path string, n_docs long, n_ids long"
DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(planes[:, :bits].reshape(-1), bitorder="little").tobytes()


def unpack_bits(data: bytes, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = flat
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").reshape(-1).astype(np.uint32)


def open_store(uri: str):
    """The file system and path of a URI or plain path, on the driver and on executors alike."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class ShardWriter:
    def __init__(self, uri: str, bits: int, block: int):
        store, path = open_store(uri)
        store.create_dir(path.rpartition("/")[0], recursive=True)
        self.sink, self.bits, self.block = store.open_output_stream(path), bits, block
        self.sink.write(MAGIC + np.array([bits, block], "<u4").tobytes())
        self.at, self.n_ids = HEADER, 0
        self.offsets: list[int] = []
        self.docs: list[tuple[int, int, int]] = []
        self.waiting: list[np.ndarray] = []
        self.waits = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id or 0, self.n_ids, doc_id is None))
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.waits += len(ids)
        if self.waits >= self.block:
            self._blocks(False)

    def _blocks(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        until = len(ids) if last else len(ids) // self.block * self.block
        for a in range(0, until, self.block):
            data = pack_bits(ids[a : min(a + self.block, until)], self.bits)
            self.offsets.append(self.at)
            self.sink.write(data)
            self.at += len(data)
        self.waiting, self.waits = [ids[until:]], len(ids) - until

    def close(self) -> None:
        self._blocks(True)
        table = np.array(self.docs, dtype=[("doc_id", "<i8"), ("start", "<u8"), ("null", "u1")])
        self.sink.write(table.tobytes())
        self.sink.write(np.array([*self.offsets, self.at], "<u8").tobytes())
        self.sink.write(np.array([len(table), self.n_ids, len(self.offsets), self.at], "<u8").tobytes())
        self.sink.close()


class ShardReader:
    def __init__(self, uri: str):
        store, path = open_store(uri)
        self.source = store.open_input_file(path)
        size = self.source.size()
        head = self.source.read_at(HEADER, 0)
        if head[:8] != MAGIC:
            raise ValueError(f"not a token file: {uri}")
        self.bits, self.block = (int(x) for x in np.frombuffer(head, "<u4", 2, 8))
        n_docs, self.n_ids, n_blocks, docs_at = (int(x) for x in np.frombuffer(self.source.read_at(TRAILER, size - TRAILER), "<u8"))
        self.docs = np.frombuffer(self.source.read_at(17 * n_docs, docs_at), [("doc_id", "<i8"), ("start", "<u8"), ("null", "u1")])
        self.offsets = np.frombuffer(self.source.read_at(8 * (n_blocks + 1), docs_at + 17 * n_docs), "<u8").astype(np.int64)

    def ids(self, first: int, until: int) -> np.ndarray:
        """Ids first..until, from the blocks that cover them only."""
        if until <= first:
            return np.zeros(0, np.uint32)
        a, b = first // self.block, (until - 1) // self.block
        data = self.source.read_at(int(self.offsets[b + 1] - self.offsets[a]), int(self.offsets[a]))
        parts = []
        for k in range(a, b + 1):
            n = min(self.block, self.n_ids - k * self.block)
            at = int(self.offsets[k] - self.offsets[a])
            parts.append(unpack_bits(data[at : at + (n * self.bits + 7) // 8], n, self.bits))
        return np.concatenate(parts)[first - a * self.block : until - a * self.block]

    def document(self, k: int) -> np.ndarray:
        """Random access to the k-th document of the shard."""
        until = int(self.docs["start"][k + 1]) if k + 1 < len(self.docs) else self.n_ids
        return self.ids(int(self.docs["start"][k]), until)

    def walk(self, ids_at_once: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Runs of documents: their table rows, the bounds of each in the ids, the ids."""
        starts = np.append(self.docs["start"].astype(np.int64), self.n_ids)
        a = 0
        while a < len(self.docs):
            b = max(a + 1, int(np.searchsorted(starts, starts[a] + ids_at_once, "right")) - 1)
            yield self.docs[a:b], starts[a : b + 1] - starts[a], self.ids(int(starts[a]), int(starts[b]))
            a = b


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, block: int = 8192) -> list[tuple[int, str, int, int]]:
    """Encode all documents in ascending doc_id order (null first) and write one shard per range of rows.

    Rows with the same doc_id follow one another, by a hash of the text, over several shards if they are many. Returns the manifest - one
    entry per non-empty shard, in order - which is also written as ``_manifest`` beside the shards.
    """
    spark = docs.sparkSession
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        coder = json_tokenizer(tokenizer)
        uri = f"{folder}/shard-{task.partitionId():06d}-{uuid.uuid4().hex}.lmt"
        writer = None
        for batch, texts in grouped(batches, "text"):
            names = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            for doc_id, (ids, _) in zip(names, coder.encode(texts)):
                writer = writer or ShardWriter(uri, bits_for(max(coder.vocabulary, end_id + 1)), block)
                writer.add(doc_id, np.append(ids, np.uint32(end_id)).astype(np.uint32))
        if writer:
            writer.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([task.partitionId()], pa.int32()), pa.array([uri]), pa.array([len(writer.docs)], pa.int64()), pa.array([writer.n_ids], pa.int64())],
                ["shard", "path", "n_docs", "n_ids"],
            )

    # Ranges are found on a sample of their keys, so these are two numbers; texts stay with the executors.
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("mark"))
    ordered = marked.repartitionByRange("doc_id", "mark").sortWithinPartitions("doc_id", "mark", "text").select("doc_id", "text")
    # One small row per shard: bounded by the number of partitions, not by the documents.
    manifest = sorted(tuple(r) for r in ordered.mapInArrow(run, MANIFEST).collect())
    if manifest:
        store, path = open_store(folder)
        with store.open_output_stream(f"{path}/_manifest") as sink:
            sink.write("".join(f"{shard}\t{uri}\t{n_docs}\t{n_ids}\n" for shard, uri, n_docs, n_ids in manifest).encode())
    return manifest


def read_token_files(spark: SparkSession, manifest: list[tuple[int, str, int, int]]) -> DataFrame:
    """Per document, read back from the files: doc_id, ids before it in all shards, its ids' number and checksum."""
    ship_package(spark)
    rows, base = [], 0
    for shard, path, n_docs, n_ids in manifest:
        rows.append((shard, path, base))
        base += n_ids
    listed = spark.createDataFrame(rows, "shard int, path string, base long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for table, bounds, ids in ShardReader(row["path"]).walk():
                    raw = ids.astype("<u4").tobytes()
                    sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(table["doc_id"].astype(np.int64), mask=table["null"].astype(bool)),
                            pa.array(row["base"] + table["start"].astype(np.int64)),
                            pa.array(np.diff(bounds)),
                            pa.array(sums, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return listed.repartition(max(1, len(rows))).mapInArrow(run, DOCS)


def token_file_round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write the files into the shared folder and read every document back.

    Defined cases: a null or empty text is its end id alone; repeated rows are
    written one by one; an empty table writes nothing and returns no rows; columns
    other than doc_id and text are ignored.
    """
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    manifest = write_token_files(docs, folder, tokenizer, end_id)
    return read_token_files(spark, manifest)
