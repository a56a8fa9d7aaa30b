"""SimHash near-dedup with pigeonring filtering.

Fingerprints are computed row by row; only distinct ones are compared. The 64 bits form a ring of
``SEGMENTS`` = 16 segments of 4 bits. If two fingerprints differ in at most 2 bits, some segment starts a
chain in which the first k segments differ in at most 2k/16 bits, for every k: so the first 7 segments of
that chain are equal (k < 8 leaves no difference), the first 15 differ in at most one bit, and all 16 in two.
Seven equal segments are 28 bits of index key for each of the 16 starts; within a bucket the rest of the
chain is tested before the full Hamming distance.

Buckets of at most ``BUCKET`` fingerprints are joined pair by pair, so the candidates grow linearly. The
fingerprints of larger buckets are linked exactly another way: two fingerprints differ in at most 2 bits if
and only if they share a centre, which is the fingerprint itself or one with a single bit flipped. A
centre has at most 65 members, whatever the bucket's size.

Defined cases: a text without words, or NULL, has fingerprint zero and is linked like any other. Rows that
repeat a doc_id are judged each by its own text; the smallest doc_id names the component. Rows with a NULL doc_id have
a fingerprint, and are in no component (component_id is NULL) and link nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuscope.llm.common import Scratch, as_bytes, packed, unpacked
from corpuscope.llm.components import connected_components

SEED = 42
SHINGLE = 3
SEGMENTS = 16
DISTANCE = 2
BUCKET = 64

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """Majority of the bits of all word shingles' XXH64, repeats included."""
    words = text.translate(_FOLD).split() if text else []  # bytes split at \x20 and \x09-\x0D alone
    if not words:
        return 0
    joined = b" ".join(words)
    count = max(len(words) - size + 1, 1)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths)[:count].tolist()
    stops = (ends - 1)[min(size, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops)), dtype=np.uint64, count=count)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, count, 1 << 16):
        part = hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << k for k in np.flatnonzero(2 * ones > count).tolist())


def fingerprints(documents: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``same`` (a hash of the text) and ``fp``, the 64-bit fingerprint as a signed long, for each row."""

    def run(batches):
        for rows in batches:
            bits = [fingerprint(value) for value in as_bytes(rows.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("same"), pa.array(np.array(bits, dtype=np.uint64).view(np.int64))],
                names=["doc_id", "same", "fp"],
            )

    source = packed(documents, doc_id=F.col(key).cast("long"), same=_same(text), text=F.col(text)).select("doc_id", "same", "text")
    return source.mapInArrow(run, "doc_id long, same long, fp long")


def _same(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _rotated(fp: Column, start: int) -> Column:
    """The ring read from segment ``start`` on: that segment in the lowest bits."""
    bits = start * (64 // SEGMENTS)
    return fp if not bits else F.shiftrightunsigned(fp, bits).bitwiseOR(F.shiftleft(fp, 64 - bits))


def links(distinct: DataFrame, scratch: Scratch, bucket: int = BUCKET) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints ``fp`` that join all that differ in at most 2 bits.

    Pairs from small buckets are the links themselves. In large buckets a centre's members are all tied to its
    smallest: every tie is a link, and linked fingerprints stay connected.
    """
    width = 64 // SEGMENTS
    equal = SEGMENTS // DISTANCE - 1  # segments of a chain whose budget is below one bit
    low = (1 << width * equal) - 1
    rings = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(s).cast("byte").alias("start"), _rotated(F.col("fp"), s).alias("ring")) for s in range(SEGMENTS)
    ])).alias("k")).select("fp", "k.start", "k.ring", F.col("k.ring").bitwiseAND(low).alias("chain"))
    rings = scratch.keep(rings, "rings")
    sizes = rings.groupBy("start", "chain").count().filter("count > 1")
    sizes = scratch.keep(sizes, "buckets")
    small = rings.join(sizes.filter(F.col("count") <= bucket).drop("count"), ["start", "chain"], "left_semi")
    small = scratch.keep(small, "small")
    other = small.select("start", "chain", F.col("fp").alias("fp_b"), F.col("ring").alias("ring_b"))
    differ = F.col("ring").bitwiseXOR(F.col("ring_b"))
    # Budgets step up where k * DISTANCE / SEGMENTS reaches a whole bit: 15 segments may differ in one.
    chain = F.bit_count(differ.bitwiseAND((1 << width * (SEGMENTS - 1)) - 1)) <= DISTANCE - 1
    pairs = small.join(other, ["start", "chain"]).filter(
        (F.col("fp") < F.col("fp_b")) & chain & (F.bit_count(differ) <= DISTANCE)
    ).select(F.col("fp").alias("a"), F.col("fp_b").alias("b"))
    large = rings.join(sizes.filter(F.col("count") > bucket).drop("count"), ["start", "chain"], "left_semi")
    large = large.select("fp").distinct()
    flips = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), k)))
    centres = large.select("fp", F.explode(F.concat(F.array("fp"), flips)).alias("centre"))
    # At most 65 members each.
    ties = centres.groupBy("centre").agg(F.array_sort(F.collect_list("fp")).alias("members")).filter(F.size("members") > 1)
    ties = ties.select(F.col("members")[0].alias("a"), F.explode(F.slice("members", 2, 64)).alias("b"))
    return pairs.union(ties).distinct()


def near_duplicates(documents: DataFrame, *, key: str = "doc_id", text: str = "text", bucket: int = BUCKET) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of each row."""
    return _judged(documents, key, text, bucket).drop("same")


def _judged(documents: DataFrame, key: str, text: str, bucket: int = BUCKET) -> DataFrame:
    """The same, with the hash of the row's text."""
    scratch = Scratch(documents.sparkSession, "simhash")
    prints = scratch.keep(fingerprints(documents, key=key, text=text), "prints")
    # Copies meet inside each task, so a text that a third of the rows hold is one row of each.
    least = scratch.keep(prints.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = connected_components(links(least.select("fp"), scratch, bucket), scratch)
    roots = scratch.keep(roots, "roots")
    scratch.drop("rings"), scratch.drop("buckets"), scratch.drop("small")
    members = least.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )
    groups = members.groupBy("root").agg(F.min("least").alias("component_id"))
    # fp -> component_id, told only where it is not the fingerprint's own smallest document.
    named = members.join(groups, "root").select(F.col("fp").alias("of"), "component_id")
    return prints.join(named, F.col("fp") == F.col("of"), "left").select(
        "doc_id", "same", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def representatives(documents: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents, with all their columns, that name their component; rows with a NULL key stay.

    Rows are told apart by key and text, so that a key which repeats with another text keeps or loses each on its own. The
    rows that go are a narrow table, and its size on disk decides how it is joined.
    """
    scratch = Scratch(documents.sparkSession, "representatives")
    members = _judged(documents, key, text, **options)
    gone = members.filter("doc_id <> component_id").select(F.col("doc_id").alias("gone"), F.col("same").alias("gone_text"))
    gone = scratch.keep(gone.distinct(), "gone")
    rows = packed(documents, key=F.col(key).cast("long"), same=_same(text))
    return unpacked(rows.join(gone, (F.col("key") == F.col("gone")) & (F.col("same") == F.col("gone_text")), "left_anti"))
