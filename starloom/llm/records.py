"""Token ids in length-delimited binary files with checksums, and an offset index for reads in any order.

A data file is a run of records. A record is the length of its payload (8 bytes), a masked CRC-32C of those bytes (4 bytes),
the payload and a masked CRC-32C of the payload (4 bytes), all little-endian: the framing that readers of length-delimited
records know. The payload is one document: bytes per id (1), a flag for a null doc_id (1), doc_id (8), then the ids.
The index, a Parquet table beside the files, holds file, place and size of every record. It is written last and by Spark's own commit,
so only files of tasks that counted are in it; what lost or repeated tasks left behind is removed afterwards.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.encoding import encoder
from starloom.llm.tables import prepared
from starloom.llm.words import slices, string_buffers

END_ID = 2
FILE_BYTES = 1 << 28
SPLIT_BYTES = 1 << 24
_HEAD, _MARK, _PAYLOAD = struct.Struct("<QI"), struct.Struct("<I"), struct.Struct("<BBq")
_FRAME = _HEAD.size + _MARK.size
INDEX = "file string, shard long, record long, offset long, length long, doc_id long, n_tokens long"
REPORT = "doc_id long, start long, n_tokens long, ids_crc32 long"
TOKENS = "doc_id long, file string, record long, ids array<int>"
_BLOCK = 64


class CorruptRecord(ValueError):
    """A length or a checksum in a data file does not fit."""


def _byte_table() -> np.ndarray:
    """Remainders of all bytes by the Castagnoli polynomial 0x1EDC6F41 (bits reversed)."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0x82F63B78), table >> np.uint32(1))
    return table


_BYTES = _byte_table()


def _followed(values: np.ndarray, zeros: int) -> np.ndarray:
    """Remainders after ``zeros`` further zero bytes."""
    for _ in range(zeros):
        values = _BYTES[values & 255] ^ (values >> np.uint32(8))
    return values


def _shift_tables(levels: int) -> list[np.ndarray]:
    """Per level the effect of 64 * 2^level zero bytes on a remainder, as four tables by byte."""
    own = np.stack([_followed(np.arange(256, dtype=np.uint32) << np.uint32(8 * k), _BLOCK) for k in range(4)])
    tables = [own]
    for _ in range(levels - 1):
        tables.append(_shifted(_shifted(np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32)[:, None]), tables[-1]), tables[-1]))
    return tables


def _shifted(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[0][values & 255] ^ table[1][(values >> np.uint32(8)) & 255] ^ table[2][(values >> np.uint32(16)) & 255] ^ table[3][values >> np.uint32(24)]


#: Effect of a byte at each place of a block on the remainder at the block's end.
_PLACES = np.stack([_followed(_BYTES, _BLOCK - 1 - p) for p in range(_BLOCK)])
_SHIFTS = _shift_tables(40)


def crc32c(parts: list[bytes]) -> np.ndarray:
    """CRC-32C of each byte string; all are worked on at once, in blocks that are then put together pairwise."""
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    out = np.zeros(len(parts), dtype=np.uint32)
    short = np.flatnonzero(sizes < 4)
    for i in short:  # the start value reaches beyond their bytes
        value = 0xFFFFFFFF
        for byte in parts[i]:
            value = int(_BYTES[(value ^ byte) & 255]) ^ (value >> 8)
        out[i] = value ^ 0xFFFFFFFF
    long = np.flatnonzero(sizes >= 4)
    # each part takes 2^k blocks, zeros first: these do not change a remainder that starts from zero
    levels = np.ceil(np.log2(np.maximum(1, -(-sizes[long] // _BLOCK)))).astype(np.int64)
    for level in np.unique(levels):
        own = long[levels == level]
        width = _BLOCK << int(level)
        step = max(1, (1 << 20) // width)
        for first in range(0, len(own), step):
            chosen = own[first : first + step]
            data = np.zeros((len(chosen), width), dtype=np.uint8)
            for row, i in enumerate(chosen):
                data[row, width - sizes[i] :] = np.frombuffer(parts[i], dtype=np.uint8)
            for k in range(4):  # the start value of all ones
                data[np.arange(len(chosen)), width - sizes[chosen] + k] ^= 0xFF
            blocks = data.reshape(-1, _BLOCK)
            values = np.zeros(len(blocks), dtype=np.uint32)
            for place in range(_BLOCK):
                values ^= _PLACES[place][blocks[:, place]]
            values = values.reshape(len(chosen), -1)
            for k in range(int(level)):
                values = _shifted(values[:, 0::2], _SHIFTS[k]) ^ values[:, 1::2]
            out[chosen] = values[:, 0] ^ np.uint32(0xFFFFFFFF)
    return out


def masked(crc: np.ndarray) -> np.ndarray:
    """Checksums turned by 15 bits plus a constant, so that data which holds checksums is safe to checksum again."""
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)


def payload(doc_id: int | None, ids: np.ndarray) -> bytes:
    """A document's payload; ids take two bytes each where all fit."""
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    return _PAYLOAD.pack(width, doc_id is None, doc_id or 0) + ids.astype(f"<u{width}").tobytes()


def parsed(data: bytes) -> tuple[int | None, np.ndarray]:
    width, missing, doc_id = _PAYLOAD.unpack_from(data)
    return None if missing else doc_id, np.frombuffer(data, f"<u{width}", offset=_PAYLOAD.size).astype("<u4")


def framed(payloads: list[bytes]) -> list[bytes]:
    """The records of payloads."""
    heads = masked(crc32c([struct.pack("<Q", len(p)) for p in payloads])).tolist()
    feet = masked(crc32c(payloads)).tolist()
    return [_HEAD.pack(len(p), a) + p + _MARK.pack(b) for p, a, b in zip(payloads, heads, feet, strict=True)]


def unframed(data: bytes) -> list[bytes]:
    """Payloads of a run of whole records, all checksums verified."""
    at, payloads, heads, feet = 0, [], [], []
    view = memoryview(data)
    while at < len(data):
        if at + _FRAME > len(data):
            raise CorruptRecord(f"{len(data) - at} bytes left over")
        length, head = _HEAD.unpack_from(data, at)
        end = at + _HEAD.size + length
        if end + _MARK.size > len(data):
            raise CorruptRecord(f"a record of {length} bytes does not end")
        payloads.append(bytes(view[at + _HEAD.size : end]))
        heads.append(head)
        feet.append(_MARK.unpack_from(data, end)[0])
        at = end + _MARK.size
    if (masked(crc32c([struct.pack("<Q", len(p)) for p in payloads])) != np.array(heads, dtype=np.uint32)).any():
        raise CorruptRecord("checksum of a length")
    if (masked(crc32c(payloads)) != np.array(feet, dtype=np.uint32)).any():
        raise CorruptRecord("checksum of a payload")
    return payloads


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that all executors reach; schemes are those of the cluster's storage."""
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _writer(folder: str, vocabulary: str | None, end_id: int, file_bytes: int):
    end = np.array([end_id], dtype="<u4")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        system, root = _place(folder)
        partition, files = TaskContext.get().partitionId(), 0
        out, name, record, offset = None, None, 0, 0
        try:
            for batch in batches:
                ids, texts = batch.column(0), batch.column(1)
                _, bounds = string_buffers(texts)
                for first, last in slices(bounds):
                    docs = ids[first:last].to_pylist()
                    tokens = [np.concatenate([encode(t or ""), end]) for t in texts[first:last].to_pylist()]
                    rows = []
                    for doc, own, data in zip(docs, tokens, framed([payload(d, t) for d, t in zip(docs, tokens, strict=True)]), strict=True):
                        if out is None:
                            name = f"part-{partition:06d}-{files:04d}-{uuid.uuid4().hex}.rec"
                            out, record, offset, files = system.open_output_stream(f"{root}/{name}"), 0, 0, files + 1
                        out.write(data)
                        rows.append((name, (partition << 24) + files, record, offset, len(data) - _FRAME, doc, len(own)))
                        record, offset = record + 1, offset + len(data)
                        if offset >= file_bytes:
                            out.close()
                            out = None
                    yield _columns(rows, INDEX)
        finally:
            if out is not None:
                out.close()

    return write


def _columns(rows: list[tuple], schema: str) -> pa.RecordBatch:
    types = {"string": pa.string(), "long": pa.int64(), "array<int>": pa.list_(pa.int32())}
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, types[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], names=[name for name, _ in fields])


def write_records(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the ids of all documents below ``path`` in ascending doc_id order; the offset index is returned.

    Every row is a document of its own. A null or empty text is the end id alone; null ids come last, rows of one id in the order of
    a hash of their text. Files follow each other by ``shard``, records in a file by ``record``. The range sort has keys
    below doc_id, so the rows of one id spread over tasks too. An existing folder is an error; no rows give an empty index.
    """
    spark = prepared(docs.sparkSession)
    path = path.rstrip("/")
    system, root = _place(path)
    if system.get_file_info(root).type != fs.FileType.NotFound:
        raise FileExistsError(path)
    system.create_dir(f"{root}/data", recursive=True)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    keys = [F.col("doc_id").asc_nulls_last(), F.col("tie"), F.col("row")]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    ordered.mapInArrow(_writer(f"{path}/data", vocabulary, end_id, file_bytes), INDEX).write.parquet(f"{path}/index")
    found = index(spark, path)
    counted = {row.file for row in found.select("file").distinct().toLocalIterator()}  # one name per file of FILE_BYTES
    for info in system.get_file_info(fs.FileSelector(f"{root}/data")):
        if info.base_name not in counted:
            system.delete_file(info.path)
    return found


def index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{path.rstrip('/')}/index")


def _splits(rows: DataFrame, split_bytes: int) -> DataFrame:
    """Byte ranges of whole records of about ``split_bytes``, each with the number of ids before it in all files."""
    split = F.floor(F.col("offset") / F.lit(split_bytes)).alias("split")
    cuts = rows.groupBy("shard", "file", split).agg(
        F.min("record").alias("record"), F.min("offset").alias("first"), F.max(F.col("offset") + F.col("length") + F.lit(_FRAME)).alias("last"), F.sum("n_tokens").alias("n")
    )
    files = rows.groupBy("shard").agg(F.sum("n_tokens").alias("all"))  # one row per file
    before = files.select("shard", (F.sum("all").over(Window.orderBy("shard")) - F.col("all")).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("shard").orderBy("split")) - F.col("n")
    return cuts.withColumn("inside", inside).join(before, "shard").select("file", "record", "first", "last", "n", (F.col("before") + F.col("inside")).alias("start"))


def _scan(spark: SparkSession, path: str, split_bytes: int, schema: str, give) -> DataFrame:
    """Rows that ``give(file, record, start, payload)`` makes of all records, read in byte ranges spread over tasks."""
    folder = f"{path.rstrip('/')}/data"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _place(folder)
        for batch in batches:
            for cut in batch.to_pylist():
                with system.open_input_file(f"{root}/{cut['file']}") as source:
                    data = source.read_at(cut["last"] - cut["first"], cut["first"])
                rows, start = [], cut["start"]
                for record, part in enumerate(unframed(data), cut["record"]):
                    doc_id, ids = parsed(part)
                    rows.append(give(cut["file"], record, start, doc_id, ids))
                    start += len(ids)
                if start - cut["start"] != cut["n"]:
                    raise CorruptRecord(f"{cut['file']} holds other records than its index")
                for first in range(0, len(rows), 1000):
                    yield _columns(rows[first : first + 1000], schema)

    cuts = _splits(index(spark, path), split_bytes)
    tasks = max(1, min(cuts.count(), 20_000))  # rows of the list are small, so their number and not their size deals them
    return cuts.repartition(tasks).mapInArrow(read, schema)


def record_report(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Per record ``doc_id, start, n_tokens, ids_crc32``, read from the files; start counts the ids of all records before it."""
    return _scan(spark, path, split_bytes, REPORT, lambda file, record, start, doc, ids: (doc, start, len(ids), zlib.crc32(ids)))


def read_records(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """All records with their ids, file and place."""
    return _scan(spark, path, split_bytes, TOKENS, lambda file, record, start, doc, ids: (doc, file, record, ids.astype(np.int32)))


def shuffled_records(spark: SparkSession, path: str, seed: int) -> DataFrame:
    """All records once, in an order drawn by ``seed``: the index is put into that order, then single records are read by their offsets.

    Equal seeds give equal orders. Only index rows are shuffled. A batch of records is read file by file and given in drawn order.
    """
    folder = f"{path.rstrip('/')}/data"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _place(folder)
        for batch in batches:
            wanted = batch.to_pylist()
            found: list[tuple] = [()] * len(wanted)
            source, opened = None, None
            for i in sorted(range(len(wanted)), key=lambda i: (wanted[i]["file"], wanted[i]["offset"])):
                row = wanted[i]
                if row["file"] != opened:
                    if source is not None:
                        source.close()
                    source, opened = system.open_input_file(f"{root}/{row['file']}"), row["file"]
                (part,) = unframed(source.read_at(row["length"] + _FRAME, row["offset"]))
                doc_id, ids = parsed(part)
                found[i] = (doc_id, row["file"], row["record"], ids.astype(np.int32))
            if source is not None:
                source.close()
            yield _columns(found, TOKENS)

    drawn = index(spark, path).withColumn("draw", F.xxhash64(F.lit(seed), "shard", "record"))
    keys = ["draw", "shard", "record"]
    return drawn.repartitionByRange(*keys).sortWithinPartitions(*keys).select("file", "record", "offset", "length").mapInArrow(read, TOKENS)
