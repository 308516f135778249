"""Token ids in binary files: each document compressed by itself with a shared dictionary, found through an index.

A file is a row of segments. A segment is a header, an index with a document's key, place and number of ids, and the
documents' zstandard frames. Ids take two bytes where the vocabulary allows, else four. The dictionary is trained on the
serialised ids of a bounded sample and stored beside the files; headers carry its SHA-256. Spark's text writer puts the
bytes in place (segments know their length, so the line feed it adds is skipped), so any store that Spark writes will do.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerforge.llm.encoder import encoder
from offerforge.llm.frames import arrow_schema, map_rows, texts
from offerforge.session import written

MAGIC = b"TIDS"
#: Magic, id width, file number, segment number, documents, ids, length of the frames, SHA-256 of the dictionary.
HEADER = struct.Struct("<4sBIIIQQ32s")
#: Key, 1 if the key is null, ids, first byte of the frame.
ENTRY = np.dtype([("key", "<i8"), ("no_key", "u1"), ("ids", "<u8"), ("at", "<u8")])
END_ID = 0
SEGMENT_BYTES = 4 << 20
FILE_CHARS = 24_000_000
DICTIONARY_BYTES = 65536
SAMPLE_DOCS = 1000
SAMPLE_CHARS = 20_000
LEVEL = 3


def train_dictionary(docs: DataFrame, tokenizer: str, rows: int, end_id: int = END_ID) -> bytes:
    """Dictionary from at most ``SAMPLE_DOCS`` documents of at most ``SAMPLE_CHARS`` characters (doc_id, text), picked by
    a hash; empty where zstandard finds too little to train on. It only affects the size of the files."""
    import zstandard

    share = min(1.0, 2 * SAMPLE_DOCS / max(rows, 1))
    some = docs.where(F.length("text").between(1, SAMPLE_CHARS))
    some = some.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < int(1_000_000 * share) + 1).limit(SAMPLE_DOCS)

    def make(batch):
        encode = encoder(tokenizer).ids
        return [{"ids": encode(t) + end_id.to_bytes(4, "little")} for t in batch.column(1).to_pylist()]

    ids = [np.frombuffer(r["ids"], "<u4") for r in map_rows(some, make, "ids binary").collect()]
    width = 2 if all(len(x) == 0 or x.max() < 65536 for x in ids) else 4
    samples = [x.astype(f"<u{width}").tobytes() for x in ids]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


@lru_cache(maxsize=2)
def _codecs(dictionary: bytes):
    import zstandard

    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared), zstandard.ZstdDecompressor(dict_data=shared)


@lru_cache(maxsize=2)
def _digest(dictionary: bytes) -> bytes:
    return hashlib.sha256(dictionary).digest()


def _segment(file: int, number: int, width: int, dictionary: bytes, docs: list[tuple[int | None, bytes]]) -> bytes:
    pack, frames = _codecs(dictionary)[0], []
    index, at = np.zeros(len(docs), dtype=ENTRY), 0
    for k, (key, ids) in enumerate(docs):
        frame = pack.compress(np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes())
        index[k] = key or 0, key is None, len(ids) // 4, at
        frames.append(frame)
        at += len(frame)
    total = int(index["ids"].sum())
    head = HEADER.pack(MAGIC, width, file, number, len(docs), total, at, _digest(dictionary))
    return b"".join([head, index.tobytes(), *frames])


def segments(content: bytes) -> Iterator[tuple[dict, np.ndarray, memoryview]]:
    """Header, index and frames of every segment of a file."""
    view, at = memoryview(content), 0
    while at < len(content):
        magic, width, file, number, docs, total, size, digest = HEADER.unpack_from(view, at)
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        index = np.frombuffer(view, ENTRY, docs, at + HEADER.size)
        start = at + HEADER.size + docs * ENTRY.itemsize
        yield {"width": width, "file": file, "number": number, "ids": total, "digest": digest}, index, view[start : start + size]
        at = start + size + 1


def document(head: dict, index: np.ndarray, frames: memoryview, k: int, dictionary: bytes) -> bytes:
    """The ids of the segment's ``k``-th document as little-endian unsigned 32-bit bytes; no other frame is touched."""
    if head["digest"] != _digest(dictionary):
        raise ValueError("the file was written with another dictionary")
    end = index["at"][k + 1] if k + 1 < len(index) else len(frames)
    raw = _codecs(dictionary)[1].decompress(frames[int(index["at"][k]) : int(end)])
    return np.frombuffer(raw, f"<u{head['width']}").astype("<u4").tobytes()


def _as_text(binary: str) -> Column:
    return F.col(binary).cast("string")


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, vocabulary: int = 65536,
                 key: str = "doc_id", text: str = "text") -> None:
    """Writes the ids of every text and the end id under ``path``, in ascending order of the key, nulls first.

    Files hold ``FILE_CHARS`` characters on average, dealt by ranges of the key and a hash of the text, so that even rows
    with one key spread over files as long as their texts differ. Null texts count as empty. No rows give no files.
    """
    spark = docs.sparkSession
    rows = texts(docs, key, text, "doc_id").withColumn("doc_id", F.col("doc_id").cast("long"))
    n, chars = rows.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    dictionary = train_dictionary(rows, tokenizer, n, end_id)
    width, end = 2 if vocabulary <= 65536 else 4, end_id.to_bytes(4, "little")
    kinds = arrow_schema(spark, "segment binary")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, file, number, held, size = encoder(tokenizer).ids, TaskContext.get().partitionId(), 0, [], 0

        def out():
            return pa.RecordBatch.from_pylist([{"segment": _segment(file, number, width, dictionary, held)}], schema=kinds)

        for batch in batches:
            for k, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = ids_of(body.as_py()) + end
                held.append((k, ids))
                size += len(ids)
                if size >= SEGMENT_BYTES:
                    yield out()
                    number, held, size = number + 1, [], 0
        if held:
            yield out()

    files = max(1, chars // FILE_CHARS)
    rows = rows.withColumn("_tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(files, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").drop("_tie")
    rows.mapInArrow(encode, "segment binary").select(_as_text("segment").alias("value")).write.text(f"{path}/files")
    spark.createDataFrame([(bytearray(dictionary),)], "d binary").select(_as_text("d").alias("value")).coalesce(1).write.text(
        f"{path}/dictionary")


def _dictionary(spark: SparkSession, path: str) -> bytes:
    found = spark.read.format("binaryFile").load(f"{path}/dictionary").where("length > 0").select("content").collect()
    return bytes(found[0][0])[:-1] if found else b""


def read_tokens(spark: SparkSession, path: str, keys: list[int] | None = None, ids: bool = True) -> DataFrame:
    """Documents of the files: file, place, doc_id, before (the ids before it in its file), n_tokens, ids_crc32 and, unless
    ``ids`` is false, the ids as little-endian unsigned 32-bit bytes. With ``keys`` only these are decompressed."""
    kinds = "file long, place long, doc_id long, before long, n_tokens long, ids_crc32 long" + (", ids binary" if ids else "")
    schema = arrow_schema(spark, kinds)
    wanted, dictionary = None if keys is None else frozenset(keys), _dictionary(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                before = place = 0
                for head, index, frames in segments(content.as_py()):
                    ahead = before + np.concatenate([[0], np.cumsum(index["ids"])]).astype(int)
                    docs = [None if no else key for key, no in zip(index["key"].tolist(), index["no_key"].tolist(), strict=True)]
                    picked = [k for k, doc in enumerate(docs) if wanted is None or doc in wanted]
                    rows = []
                    for k in picked:
                        part = document(head, index, frames, k, dictionary)
                        row = (head["file"], place + k, docs[k], int(ahead[k]), len(part) // 4, zlib.crc32(part))
                        rows.append((*row, part) if ids else row)
                    before, place = int(ahead[-1]), place + len(index)
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").load(f"{path}/files").where("length > 0").select("content")
    return files.mapInArrow(run, kinds)


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, all read back from the files.

    ``start`` adds the ids of the files before, of which there is one row each.
    """
    docs = written(read_tokens(spark, path, ids=False))
    files = docs.groupBy("file").agg(F.sum("n_tokens").alias("ids"))
    ahead = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("ids").over(ahead), F.lit(0)).alias("ahead"))
    return docs.join(files, "file").select(
        "doc_id", (F.col("ahead") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
