"""Run registered queries beside their SQL and report differences.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TABLES = ("documents", "labels")


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _kind(name: str) -> str:
    name = name.lower()
    for kind, names in {
        "int": ("bigint", "int64", "long", "int", "integer"), "double": ("double", "float"),
        "string": ("varchar", "string"), "bool": ("boolean",),
    }.items():
        if name in names:
            return kind
    return name


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b and type(a) is type(b)


def difference(spark_df, con, sql: str) -> str | None:
    """None when names, types, row count and every value agree."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    kinds = {d[0]: _kind(str(d[1])) for d in expected.description}
    want = expected.fetchall()
    ours = {f.name: _kind(f.dataType.simpleString()) for f in spark_df.schema.fields}
    if ours != kinds:
        return f"schema {ours} != {kinds}"
    order = sorted(names)
    got = [tuple(row[n] for n in order) for row in spark_df.collect()]
    want = [tuple(row[names.index(n)] for n in order) for row in want]
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    rank = lambda row: tuple((v is not None, v) for v in row)
    for mine, theirs in zip(sorted(got, key=rank), sorted(want, key=rank)):
        if not all(_same(a, b) for a, b in zip(mine, theirs)):
            return f"{dict(zip(order, mine))} != {dict(zip(order, theirs))}"
    return None


def main(argv: list[str]) -> int:
    from checks.oracle import ORACLE
    from checks.queries import QUERIES
    from corpuscope.session import tuned

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = tuned(
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="compare-")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            if name in ORACLE:
                found = difference(QUERIES[name](spark, sf_dir), con, ORACLE[name])
            else:
                found = None if QUERIES[name](spark, sf_dir).count() else "no rows"
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.1f}s {(found or '')[:700]}", flush=True)
    print(f"{len(names) - failed}/{len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
