"""Secret scans with an incremental ledger of blobs.

Every version of a text is addressed by its content (SHA-256). The ledger holds, for each blob and rule version
that was ever scanned, what was found. A scan takes the distinct blobs of its input, leaves out the pairs
that the ledger has, scans one copy of each of the others, appends the findings as a committed
batch, and joins the findings back to all paths that hold the blob.

Rules find leftmost non-overlapping matches, one rule at a time; the places are code points with exclusive ends.

Defined cases: a NULL text is the empty text and has no findings. Paths may be NULL or repeat: every input row
gets its blob's findings. An empty table commits an empty batch. A batch that a lost session left
without its success mark is not read, and its blobs are scanned again.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscope.llm.common import bounded_batches, packed
from corpuscope.staging import shared_folder


@dataclass(frozen=True)
class Rule:
    """``hint``: literals (lower case) of which a text must hold one, so most texts skip the pattern."""

    kind: str
    pattern: str
    least: int  # code points of ``group``
    group: int = 0
    hint: tuple[str, ...] = ()


# The kinds, their patterns and least lengths; and kinds added to them.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2,
         ("passw", "secret", "token", "key")),
    Rule("access", r"AKIA[A-Z0-9]+", 20, 0, ("akia",)),
    Rule("hex", r"[0-9a-f]+", 24),
)
ADDED_RULES = (
    Rule("key_block", r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----", 0, 0, ("private key",)),
    Rule("forge", r"gh[oprsu]_[A-Za-z0-9]{36,}", 0, 0, ("gh",)),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0, ("xox",)),
)
RULES = BASE_RULES + ADDED_RULES
RULE_VERSION = "1"

SPANS = "array<struct<kind:string,start:int,end:int>>"
_LONG_HEX = re.compile(r"[0-9a-f]{24}")


def find(text: str, rules: tuple[Rule, ...] = RULES) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all secrets, by start, then in the order of the rules."""
    lowered = text.lower()
    found = []
    for order, rule in enumerate(rules):
        if rule.hint and not any(h in lowered for h in rule.hint):
            continue
        if rule.kind == "hex" and not _LONG_HEX.search(text):
            continue
        for m in re.finditer(rule.pattern, text, re.ASCII):
            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                found.append((m.start(), order, m.end()))
    found.sort()
    return [(rules[order].kind, start, end) for start, order, end in found]


class Ledger:
    """Findings of all blobs scanned so far: one folder of parquet for each committed batch."""

    SCHEMA = f"blob binary, rule_version string, spans {SPANS}"

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or f"{shared_folder(spark)}/llm/secret-ledger-{uuid.uuid4().hex}"
        self.root = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self.files = self.root.getFileSystem(spark._jsc.hadoopConfiguration())
        self.files.mkdirs(self.root)

    def table(self) -> DataFrame:
        """All committed batches."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        names = [s.getPath().getName() for s in self.files.listStatus(self.root)]
        done = [f"{self.path}/{n}" for n in names if self.files.exists(hadoop(f"{self.path}/{n}/_SUCCESS"))]
        if not done:
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(*done)

    def append(self, findings: DataFrame) -> None:
        findings.write.parquet(f"{self.path}/batch-{uuid.uuid4().hex}")


def scan(
    versions: DataFrame, ledger: Ledger, *, text: str = "text", rules: tuple[Rule, ...] = RULES, rule_version: str = RULE_VERSION,
) -> DataFrame:
    """``row`` (the whole row), ``blob`` and ``spans`` of each row of ``versions``.

    Runs the job that scans what the ledger lacks. ``rule_version`` must change whenever ``rules`` do.
    """
    bounded_batches(ledger.spark)
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    addressed = versions.select(F.unhex(F.sha2(content, 256)).alias("blob"), content.alias("text"))
    # Tasks drop their own copies before the shuffle, so a blob that a third of all rows hold moves once from each.
    blobs = addressed.groupBy("blob").agg(F.first("text").alias("text"))
    seen = ledger.table().filter(F.col("rule_version") == rule_version).select(F.col("blob").alias("seen"))
    unseen = blobs.join(seen, F.col("blob") == F.col("seen"), "left_anti")

    def run(batches):
        for batch in batches:
            spans = [
                [{"kind": k, "start": a, "end": b} for k, a, b in find(value, rules)] for value in batch.column("text").to_pylist()
            ]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("blob"), pa.array([rule_version] * len(spans)), pa.array(spans, kind)],
                names=["blob", "rule_version", "spans"],
            )

    ledger.append(unseen.mapInArrow(run, Ledger.SCHEMA))
    # Most blobs are clean: only findings are joined, and what has none gets the empty list.
    findings = ledger.table().filter((F.col("rule_version") == rule_version) & (F.size("spans") > 0))
    findings = findings.select(F.col("blob").alias("of_blob"), "spans")
    paths = packed(versions, blob=F.unhex(F.sha2(content, 256)))
    return paths.join(findings, F.col("blob") == F.col("of_blob"), "left").select(
        "row", "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans")
    )
