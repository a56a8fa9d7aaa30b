"""Token ids in training order, as binary shards of fixed stride.

The texts' ids, each text ended by the end mark, make one stream that is cut into sequences of ``length`` ids. A
keyed Feistel network with cycle walking permutes the sequence numbers 0 .. N-1, which gives every sequence its slot in
training order. Range partitions of slots are the shards: shard s holds slots s * per_shard and on, one record of
``2 * length + 1`` bytes each (little-endian 16-bit ids and a line feed), so a reader seeks to any slot and goes on from there.

How it runs: one pass tokenises and writes ids with their place in their task's part of the stream; the parts' sizes (one
number for each task) give every part its offset; a second pass cuts texts where sequences begin and sends the
pieces, compressed, to their shard. Slots are dense, so the shard of a piece is known without sampling, and all shards have
the same size whatever the texts. Spark's own committer writes the shards: a lost task leaves nothing behind.

The stream's order is that of the table's files and rows. The same table, key and length give the same shards; another key, another
order of the same sequences. Only the last sequence is padded, with end marks.

Defined cases: NULL and empty texts add nothing to the stream. Repeated rows are repeated. A table without any text
gives no shard. A text may be longer than a sequence, or than a shard.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
from array import array
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscope.llm.common import Scratch, bounded_batches, grouped_batches

LENGTH = 2048
PER_SHARD = 4096
ROUNDS = 6
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9"}
CHUNK_BYTES = 4 << 20

# Fixed value: the split pattern of the byte-level vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Tokenizer:
    """Byte-level BPE from a rank file's content."""

    def __init__(self, ranks: bytes):
        pairs = (line.split() for line in ranks.splitlines() if line)
        merges = {base64.b64decode(a): int(b) for a, b in pairs}
        self.encoding = tiktoken.Encoding("shards", pat_str=SPLIT, mergeable_ranks=merges, special_tokens={})
        self.end = max(merges.values()) + 1  # free in the vocabulary
        if self.end >= 1 << 16:
            raise ValueError("ids do not fit into 16 bits")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 16-bit ids of each text, with the end mark."""
        ordinary, end = self.encoding.encode_ordinary, [self.end]
        return [np.array(array("H", ordinary(t) + end), dtype="<u2").tobytes() for t in texts]


def _round_keys(key: int) -> list[np.uint64]:
    return [
        np.uint64(int.from_bytes(hashlib.blake2b(f"{key}:{r}".encode(), digest_size=8).digest(), "little")) for r in range(ROUNDS)
    ]


def _mix(half: np.ndarray, key: np.uint64, mask: np.uint64) -> np.ndarray:
    x = half + key
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) & mask


def permute(numbers: np.ndarray, n: int, key: int, *, inverse: bool = False) -> np.ndarray:
    """Keyed permutation of 0 .. n-1, applied to each of ``numbers``.

    The network works on the smallest even number of bits that holds n - 1, at most four times n values; a result outside
    goes through it again until it falls inside, which keeps the whole a permutation.
    """
    if n <= 1:
        return np.zeros(len(numbers), dtype=np.int64)
    half = np.uint64(max((int(n - 1).bit_length() + 1) // 2, 1))
    mask = np.uint64((1 << int(half)) - 1)
    keys = _round_keys(key)
    out = np.asarray(numbers).astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        if inverse:
            for k in reversed(keys):
                left, right = right ^ _mix(left, k, mask), left
        else:
            for k in keys:
                left, right = right, left ^ _mix(right, k, mask)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


@dataclass(frozen=True)
class Layout:
    """What a reader must know; stored beside the shards."""

    sequences: int
    tokens: int
    length: int
    per_shard: int
    key: int
    end: int

    @property
    def stride(self) -> int:
        return 2 * self.length + 1


def write_shards(
    documents: DataFrame, path: str, ranks: bytes, *, key: int, text: str = "text", length: int = LENGTH, per_shard: int = PER_SHARD,
) -> Layout:
    """Write ``path``/shards and ``path``/layout; ``ranks`` is the content of a vocabulary file."""
    spark = documents.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "training-order")
    vocabulary = spark.sparkContext.broadcast(ranks)
    end = Tokenizer(ranks).end

    def tokenise(batches):
        tokenizer = Tokenizer(vocabulary.value)
        task, start = TaskContext.get().partitionId(), 0
        for batch in grouped_batches(batches, CHUNK_BYTES, "text"):
            ids = tokenizer.encode(batch.column("text").to_pylist())
            sizes = np.fromiter((len(x) // 2 for x in ids), dtype=np.int64, count=len(ids))
            ends = start + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), task, dtype=np.int32)), pa.array(ends - sizes), pa.array(ids, pa.binary())],
                names=["task", "start", "ids"],
            )
            start = int(ends[-1])

    texts = documents.select(F.col(text).alias("text")).filter("text is not null and text <> ''")
    parts = scratch.keep(texts.mapInArrow(tokenise, "task int, start long, ids binary"), "ids", **PACKED)
    # One row for each task of the scan.
    sizes = parts.groupBy("task").agg(F.max(F.col("start") + F.expr("octet_length(ids) div 2")).alias("n")).orderBy("task").collect()
    offsets = dict(zip((r.task for r in sizes), itertools.accumulate((r.n for r in sizes), initial=0)))
    total = sum(r.n for r in sizes)
    n = -(-total // length)
    layout = Layout(n, total, length, per_shard, key, end)
    shared = spark.sparkContext.broadcast(offsets)

    def cut(batches):
        offset, packer = shared.value, zstandard.ZstdCompressor(level=6)
        for batch in batches:
            numbers, places, pieces = [], [], []
            for task, start, ids in zip(*(c.to_pylist() for c in batch.columns)):
                at, here = offset[task] + start, 0
                while here < len(ids):
                    number, place = divmod(at, length)
                    piece = ids[here:here + 2 * (length - place)]
                    numbers.append(number)
                    places.append(place)
                    pieces.append(packer.compress(piece))
                    here += len(piece)
                    at += len(piece) // 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(permute(np.array(numbers, dtype=np.int64), n, key)), pa.array(places, pa.int32()), pa.array(pieces, pa.binary())],
                names=["slot", "place", "piece"],
            )

    def join(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        slot, record, out, pad = None, b"", [], end.to_bytes(2, "little")
        for batch in batches:
            for at, piece in zip(batch.column("slot").to_pylist(), batch.column("piece").to_pylist()):
                if at != slot and slot is not None:
                    out.append(record + pad * (length - len(record) // 2))
                    record = b""
                slot, record = at, record + unpack(piece)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                out = []
        if slot is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([record + pad * (length - len(record) // 2)], pa.binary())], names=["record"]
            )

    if n:
        pieces = parts.mapInArrow(cut, "slot long, place int, piece binary")
        shards = pieces.repartitionById(-(-n // per_shard), (F.col("slot") / per_shard).cast("int")).sortWithinPartitions("slot", "place")
        # A cast from binary leaves the bytes as they are, and the text sink writes them as they are.
        records = shards.select("slot", "piece").mapInArrow(join, "record binary").select(F.col("record").cast("string").alias("value"))
        records.write.text(f"{path}/shards", lineSep="\n")
    scratch.drop()
    spark.createDataFrame([tuple(asdict(layout).values())], ", ".join(f"{k} long" for k in asdict(layout))).coalesce(1).write.json(f"{path}/layout")
    return layout


def read_layout(spark: SparkSession, path: str) -> Layout:
    return Layout(**spark.read.json(f"{path}/layout").first().asDict())


def read_slots(spark: SparkSession, path: str, *, first: int = 0) -> DataFrame:
    """``slot``, ``shard``, ``offset`` (of the record in its shard), ``sequence`` (its number in the stream) and ``ids`` of slot
    ``first`` and all after it.

    Shards before the first slot's are not opened.
    """
    layout = read_layout(spark, path)
    schema = "slot long, shard int, offset long, sequence long, ids array<int>"
    if first >= layout.sequences:
        return spark.createDataFrame([], schema)
    stride, per_shard = layout.stride, layout.per_shard

    def run(batches):
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                shard = int(re.search(r"part-(\d+)-[^/]*$", file)[1])
                records = np.frombuffer(content, dtype=np.uint8).reshape(-1, stride)
                skip = max(first - shard * per_shard, 0)
                for at in range(skip, len(records), 512):
                    block = np.ascontiguousarray(records[at:at + 512, :-1]).view("<u2").astype(np.int32)
                    place = np.arange(at, at + len(block))
                    slot = shard * per_shard + place
                    sequence = permute(slot, layout.sequences, layout.key, inverse=True)
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.arange(len(block) + 1, dtype=np.int32) * block.shape[1]), pa.array(block.ravel())
                    )
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(slot), pa.array(np.full(len(block), shard, dtype=np.int32)), pa.array(place * stride), pa.array(sequence), lists],
                        names=["slot", "shard", "offset", "sequence", "ids"],
                    )

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    files = spark.read.format("binaryFile").load(f"{path}/shards").select("path", "content")
    shard = F.regexp_extract("path", r"part-(\d+)-[^/]*$", 1).cast("long")
    return files.filter(shard >= first // per_shard).mapInArrow(run, schema)
