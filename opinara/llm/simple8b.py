"""Token-ID output in Simple-8b words: selectors pack varying counts of ids into 64-bit words.

File format: a folder of Parquet files in ascending document order.  A row is a segment
of consecutive whole documents with about ``SEGMENT_IDS`` ids; its ``payload`` is

    "S8B1", u32 ids per block, u64 number of ids, u32 number of blocks,
    u32 per block and one more: place of its first word, then the 64-bit words.

Each word holds a selector in its top four bits.  Blocks start at a word of their own,
so any block decodes alone, and all words of a selector decode in one array operation.
A value of more than 60 bits is an escape: selector 15 with an empty word, and the value
in the word after it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tokens import PieceTokenizer

# Fixed values of the coding: ids per word and bits per id, by selector; 14 is the single id, 15 the escape.
COUNTS = [240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 1]
BITS = [0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 60]
ESCAPE = 15
BLOCK_IDS = 4096
SEGMENT_IDS = 1 << 16
_HEAD = struct.Struct("<4sIQI")


def _words_of_block(values: np.ndarray) -> np.ndarray:
    """Greedy packing: at each place the selector that takes most ids."""
    n = len(values)
    taken = np.ones(n, np.int64)
    selector = np.full(n, 14, np.uint8)
    selector[values >= np.uint64(1 << 60)] = ESCAPE
    # bits of each value (60 for all that selector 14 holds), and the most in runs of 1, 2, 4, ... values
    bits = np.minimum(np.frexp(values.astype(np.float64))[1], 60).astype(np.uint8)
    bits[selector == ESCAPE] = 64
    most = [bits]
    while 2 << len(most) <= 2 * n:
        half = 1 << (len(most) - 1)
        most.append(np.maximum(most[-1][:-half], most[-1][half:]))
    for k in range(13, -1, -1):
        count = COUNTS[k]
        if count > n:
            break
        run = most[count.bit_length() - 1]  # two runs that overlap cover ``count`` values
        fits = np.flatnonzero(np.maximum(run[: n - count + 1], run[len(run) - (n - count + 1) :]) <= BITS[k])
        taken[fits], selector[fits] = count, k
    places, at, steps = [], 0, taken.tolist()
    while at < n:
        places.append(at)
        at += steps[at]
    place = np.array(places, np.int64)
    chosen = selector[place]
    target = np.cumsum(1 + (chosen == ESCAPE)) - 1 - (chosen == ESCAPE)
    out = np.zeros(n and int(target[-1]) + 1 + int(chosen[-1] == ESCAPE), np.uint64)
    out[target] = chosen.astype(np.uint64) << np.uint64(60)
    for k in range(2, 15):
        mine = np.flatnonzero(chosen == k)
        if len(mine):
            ids = values[place[mine][:, None] + np.arange(COUNTS[k])]
            out[target[mine]] |= np.bitwise_or.reduce(ids << (np.arange(COUNTS[k]) * BITS[k]).astype(np.uint64), axis=1)
    escaped = chosen == ESCAPE
    out[target[escaped] + 1] = values[place[escaped]]
    return out


def encode(values: np.ndarray) -> bytes:
    """The payload of an array of unsigned 64-bit values."""
    values = np.asarray(values, np.uint64)
    blocks = [_words_of_block(values[i : i + BLOCK_IDS]) for i in range(0, len(values), BLOCK_IDS)]
    places = np.cumsum([0, *map(len, blocks)]).astype("<u4")
    body = np.concatenate([np.empty(0, np.uint64), *blocks]).astype("<u8")
    return _HEAD.pack(b"S8B1", BLOCK_IDS, len(values), len(blocks)) + places.tobytes() + body.tobytes()


def _values_of_words(words: np.ndarray) -> np.ndarray:
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    for i in np.flatnonzero(selector == ESCAPE).tolist():  # a value after an escape may look like one
        if not raw[i]:
            raw[i + 1] = True
    counts = np.array([*COUNTS, 0])[selector]
    counts[raw] = 1
    begin = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for k in range(2, 15):
        mine = np.flatnonzero((selector == k) & ~raw)
        if len(mine):
            shift = (np.arange(COUNTS[k]) * BITS[k]).astype(np.uint64)
            out[begin[mine][:, None] + np.arange(COUNTS[k])] = (words[mine][:, None] >> shift) & np.uint64((1 << BITS[k]) - 1)
    out[begin[raw]] = words[raw]
    return out


def decode(payload: bytes, first: int = 0, count: int | None = None) -> np.ndarray:
    """Values ``first`` to ``first + count``; only the blocks that hold them are read."""
    magic, size, n, n_blocks = _HEAD.unpack_from(payload)
    if magic != b"S8B1":
        raise ValueError("not a Simple-8b payload")
    stop = n if count is None else min(n, first + count)
    if first >= stop:
        return np.empty(0, np.uint64)
    places = np.frombuffer(payload, "<u4", n_blocks + 1, _HEAD.size)
    words = np.frombuffer(payload, "<u8", int(places[-1]), _HEAD.size + places.nbytes)
    low, high = first // size, -(-stop // size)
    return _values_of_words(words[places[low] : places[high]])[first - low * size : stop - low * size]


SEGMENTS = pa.schema([
    ("file", pa.int32()), ("start", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())),
    ("n_ids", pa.int64()), ("payload", pa.binary()),
])
_SEGMENT_DDL = "file int, start long, doc_id array<long>, n_tokens array<long>, n_ids long, payload binary"


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1) -> None:
    """Code every text (null: empty) and ``end_id`` after it, and write all ids in ascending doc_id order.

    One shuffle, by ranges of doc_id; equal doc_ids follow each other in the order of
    their texts.  The file number is the number of the range.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, number, done = PieceTokenizer.load(tokenizer), TaskContext.get().partitionId(), 0
        ids, docs_, parts = [], [], 0

        def segment() -> pa.RecordBatch:
            flat = np.concatenate(parts_ := [np.append(x, np.uint32(end_id)) for x in ids])
            return pa.RecordBatch.from_pylist([{
                "file": number, "start": done, "doc_id": docs_, "n_tokens": [len(x) for x in parts_],
                "n_ids": len(flat), "payload": encode(flat),
            }], SEGMENTS)

        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc, tokens in zip(batch.column("doc_id").to_pylist(), _in_parts(coder, texts)):
                ids.append(tokens)
                docs_.append(doc)
                parts += len(tokens) + 1
                if parts >= SEGMENT_IDS:
                    yield segment()
                    done += parts
                    ids, docs_, parts = [], [], 0
        if ids:
            yield segment()

    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(code, _SEGMENT_DDL).write.mode("overwrite").parquet(path)


def _in_parts(coder: PieceTokenizer, texts: list[str]) -> Iterator[np.ndarray]:
    """Ids text by text, coded in groups of a few million characters."""
    from .words import groups

    for _, some in groups(texts):
        yield from coder.encode(some)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files alone: ``doc_id, file, start, n_tokens, ids_crc32``, ``start`` over all files."""
    segments = spark.read.parquet(path)

    def open_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode(row["payload"]).astype("<u4")
                n = np.array(row["n_tokens"], np.int64)
                cuts = np.cumsum(n)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(row["doc_id"], pa.int64()),
                    "file": pa.array([row["file"]] * len(n), pa.int32()),
                    "inside": pa.array(row["start"] + cuts - n),
                    "n_tokens": pa.array(n),
                    "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in np.split(ids, cuts[:-1])], pa.int64()),
                })

    rows = segments.mapInArrow(open_segments, "doc_id long, file int, inside long, n_tokens long, ids_crc32 long")
    per_file = segments.groupBy("file").agg(F.sum("n_ids").alias("ids"))  # one row per file
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_file.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return rows.join(bases, "file").select(
        "doc_id", "file", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )
