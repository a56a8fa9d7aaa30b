"""Line dedup against levelled sorted runs of line hashes.

The index is a set of runs: tables of 128-bit line hashes, bucketed and sorted by hash, each hash
in one run only. A batch of documents is reduced to its own hashes, shuffled once to the runs'
buckets, and merge-joined with every run; no run is ever shuffled. Hashes the runs hold are old:
all lines of the batch with them go. The others become a new run at level 0. When a level has
``fanout`` runs they are merged, bucket by bucket, into one run of the next level.

Batches must come in rising order of the key: then what an earlier batch holds has the smaller key,
and a line stays in the smallest document that holds it.

Defined cases: a NULL or empty text is one empty line. Lines whose key has fewer than ``min_chars``
code points are never dropped. Rows with a NULL key take no part and keep all lines. Rows that repeat a
document's key count as the same document. An empty batch changes nothing.
"""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscope.llm.common import Scratch, as_bytes, packed
from corpuscope.staging import shared_folder

MIN_CHARS = 10
FANOUT = 4
BUCKETS = 32
BLANK = b" \t\n\x0b\x0c\r"


def line_hash(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of a line's key; None if the key is too short to count."""
    key = line.strip(BLANK).lower()  # of bytes: A-Z alone
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


class LineIndex:
    """Runs of line hashes in a folder that all executors share.

    ``path`` may hold the committed runs of earlier sessions; they are found again. ``close`` drops
    this session's scratch tables (after the results of :meth:`add` have been used) and leaves the runs.
    """

    def __init__(
        self, spark: SparkSession, path: str | None = None, *, min_chars: int = MIN_CHARS, fanout: int = FANOUT,
        buckets: int = BUCKETS,
    ):
        self.spark, self.min_chars, self.fanout, self.buckets = spark, min_chars, fanout, buckets
        self.path = path or f"{shared_folder(spark)}/llm/line-index-{uuid.uuid4().hex}"
        self.scratch = Scratch(spark, "line-dedup")
        root = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self.files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        self.files.mkdirs(root)
        self.runs: list[tuple[int, str]] = []
        for status in self.files.listStatus(root):
            name = status.getPath().getName()
            if self._exists(f"{name}/_SUCCESS"):
                self._register(name)
            elif name.startswith("level"):
                self._remove(name)
        self._settle()

    def _hadoop(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _exists(self, name: str) -> bool:
        return self.files.exists(self._hadoop(name))

    def _remove(self, name: str) -> None:
        self.files.delete(self._hadoop(name), True)

    def _settle(self) -> None:
        """A merged run replaces its parts; drop parts that a lost session had not yet removed."""
        for _, name in list(self.runs):
            if self._exists(f"{name}/_MERGED"):
                stream = self.files.open(self._hadoop(f"{name}/_MERGED"))
                parts = bytes(stream.readAllBytes()).decode().split()
                stream.close()
                for part in parts:
                    self._forget(part)

    def _register(self, name: str) -> None:
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{name}` (h BINARY) USING parquet CLUSTERED BY (h) SORTED BY (h) "
            f"INTO {self.buckets} BUCKETS LOCATION '{self.path}/{name}'"
        )
        self.runs.append((int(name.split("_")[1]), name))

    def _forget(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        self.runs = [r for r in self.runs if r[1] != name]
        self._remove(name)

    def _write(self, hashes: DataFrame, level: int, parts: list[str] = ()) -> None:
        name = f"level_{level}_{uuid.uuid4().hex}"
        # Dealt by bucket: however many partitions a shuffle has, a bucket is written by one task, as one file.
        bucket = F.pmod(F.hash("h"), F.lit(self.buckets))
        (hashes.repartitionById(self.buckets, bucket).write.format("parquet").bucketBy(self.buckets, "h").sortBy("h")
         .option("path", f"{self.path}/{name}").saveAsTable(f"`{name}`"))
        if parts:
            stream = self.files.create(self._hadoop(f"{name}/_MERGED"))
            stream.write(bytearray("\n".join(parts).encode()))
            stream.close()
        self.runs.append((level, name))

    def _compact(self) -> None:
        level = 0
        while any(at >= level for at, _ in self.runs):
            parts = [name for at, name in self.runs if at == level]
            if len(parts) >= self.fanout:
                merged = self.spark.table(f"`{parts[0]}`")
                for name in parts[1:]:
                    merged = merged.union(self.spark.table(f"`{name}`"))
                self._write(merged, level + 1, parts)
                for name in parts:
                    self._forget(name)
            level += 1

    def add(self, batch: DataFrame, *, key: str = "doc_id", text: str = "text", last: bool = False) -> DataFrame:
        """Drop the lines that earlier batches or smaller documents of this batch hold; index the rest.

        Returns one row per row of ``batch``: ``row`` (as it was), ``kept`` (the text left), ``n_lines`` and
        ``n_dropped``. Runs the jobs that update the index; the texts are rewritten when the result is used. After the
        ``last`` batch nothing reads the index, so it is left as it was.
        """
        min_chars, scratch = self.min_chars, self.scratch
        name = uuid.uuid4().hex

        def hashes(batches):
            for rows in batches:
                docs, found = [], []
                for doc, value in zip(rows.column("doc").to_pylist(), as_bytes(rows.column("text"))):
                    if doc is None or not value:
                        continue
                    own = {line_hash(line, min_chars) for line in value.split(b"\n")}
                    own.discard(None)
                    found.extend(own)
                    docs.extend([doc] * len(own))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.binary()), pa.array(docs, pa.int64())], names=["h", "doc"]
                )

        source = packed(batch, doc=F.col(key).cast("long"), text=F.col(text)).select("doc", "text")
        lines = scratch.keep(source.mapInArrow(hashes, "h binary, doc long"), f"{name}-lines")
        # Tasks combine before the shuffle, so a line that a third of the documents hold is one row of each task.
        tagged = lines.groupBy("h").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
        tagged = tagged.withColumn("old", F.lit(False))
        for _, run in self.runs:
            held = self.spark.table(f"`{run}`").select(F.col("h").alias("known"))
            tagged = tagged.join(held, F.col("h") == F.col("known"), "left").select(
                "h", "first", "last", (F.col("old") | F.col("known").isNotNull()).alias("old")
            )
        tagged = scratch.keep(tagged, f"{name}-tagged")
        if not last:
            self._write(tagged.filter("not old").select("h"), 0)
        # Of an old hash all lines go (first is NULL), of a new one all but those of the first document.
        repeated = tagged.filter("old or first <> last").select(
            F.col("h").alias("again"), F.when(~F.col("old"), F.col("first")).alias("first")
        )
        drops = lines.join(repeated, F.col("h") == F.col("again")).filter("first is null or doc <> first")
        drops = scratch.keep(drops.groupBy("doc").agg(F.collect_list("h").alias("hashes")), f"{name}-drops")
        scratch.drop(f"{name}-lines")
        scratch.drop(f"{name}-tagged")
        if not last:
            self._compact()

        def rewrite(batches):
            for rows in batches:
                kept, n_lines, n_dropped = [], [], []
                for value, gone in zip(as_bytes(rows.column("row").field(text)), rows.column("hashes").to_pylist()):
                    split = (value or b"").split(b"\n")
                    left = split
                    if gone:
                        gone = set(gone)
                        left = [line for line in split if line_hash(line, min_chars) not in gone]
                    kept.append(b"\n".join(left))
                    n_lines.append(len(split))
                    n_dropped.append(len(split) - len(left))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("row"), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()),
                     pa.array(n_dropped, pa.int64())], names=["row", "kept", "n_lines", "n_dropped"],
                )

        whole = packed(batch, key=F.col(key).cast("long"))
        joined = whole.join(drops, F.col("key") == F.col("doc"), "left").select("row", "hashes")
        return joined.mapInArrow(
            rewrite, f"row {joined.schema['row'].dataType.simpleString()}, kept string, n_lines long, n_dropped long"
        )

    def close(self) -> None:
        """Drop the scratch tables behind the results of :meth:`add`; the runs stay."""
        self.scratch.drop()

    def drop_runs(self) -> None:
        for _, name in list(self.runs):
            self._forget(name)
        self.files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(self.path), True)


def dedup(
    documents: DataFrame, *, key: str = "doc_id", text: str = "text", batches: int = 3, fanout: int = 2, **options
) -> DataFrame:
    """Line dedup of a whole table, as ``batches`` successive batches of a fresh index (see :meth:`LineIndex.add`).

    The key range is cut evenly; rows with a NULL key come with the first batch. With this ``fanout`` the runs of the first
    batches are merged before the last batch, which reads the merged run; what only later batches would read is not made.
    """
    index = LineIndex(documents.sparkSession, fanout=fanout, **options)
    at = F.col(key).cast("long")
    low, high = documents.agg(F.min(at), F.max(at)).first()
    low, high = (low, high) if low is not None else (0, 0)
    cuts = [low + (high - low + 1) * k // batches for k in range(1, batches)]
    parts, before = [], None
    for cut in [*cuts, None]:
        inside = at.isNotNull()
        if before is not None:
            inside &= at >= before
        if cut is not None:
            inside &= at < cut
        if before is None:
            inside |= at.isNull()
        parts.append(index.add(documents.filter(inside), key=key, text=text, last=cut is None))
        before = cut
    result = parts[0]
    for part in parts[1:]:
        result = result.union(part)
    index.drop_runs()
    return result


def deduplicated(documents: DataFrame, *, text: str = "text", length: str = "n_chars", **options) -> DataFrame:
    """The documents with all their columns, their texts (and, if there is such a column, lengths) as the dedup left them.

    A NULL text stays NULL.
    """
    done = dedup(documents, text=text, **options)
    new = F.when(F.col(f"row.{text}").isNotNull(), F.col("kept"))
    row = F.col("row").withField(text, new)
    if length in documents.columns:
        row = row.withField(length, F.length(new).cast(documents.schema[length].dataType))
    return done.select(row.alias("row")).select("row.*")
