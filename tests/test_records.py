from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from corpuscope.sources import records, tables

NAMES = ["Unnamed: 0", "description", "transcription", "sample_name", "keywords", "medical_specialty"]


def by_characters(line, inside):
    """The same automaton, one character at a time."""
    state = "quoted" if inside else "start"
    k = 0
    while k < len(line):
        c = line[k]
        if state == "quoted" and c == '"':
            if line[k + 1:k + 2] == '"':
                k += 1
            else:
                state = "bare"
        elif state in ("start", "bare") and c == ",":
            state = "start"
        elif state == "start":
            state = "quoted" if c == '"' else "bare"
        k += 1
    return state == "quoted"


def test_quotes_open_after_a_line():
    rng = random.Random(1)
    for _ in range(20_000):
        line = "".join(rng.choice('"",,ab ') for _ in range(rng.randint(0, 12)))
        for inside in (False, True):
            assert records.ends_inside(line, inside) == by_characters(line, inside), (line, inside)


def test_prefix_over_ranges():
    # (file, start, after outside, after inside, a record ends under inside)
    scanned = [(7, 0, True, False, True), (7, 100, False, True, False), (7, 200, True, False, True), (7, 300, False, True, False), (3, 0, False, True, True)]
    states = records.prefix_states(reversed(scanned))
    assert states == {
        (7, 0): (False, 0, True), (7, 100): (True, 0, False), (7, 200): (True, 0, False), (7, 300): (False, 200, False), (3, 0): (False, 0, True),
    }


def made(seed, rows, end="\n"):
    rng = random.Random(seed)

    def cell():
        kind = rng.random()
        if kind < 0.2:
            return rng.choice(["", "NA", "null", " padded ", 'five "feet"', '"', "a,b"])
        words = [rng.choice(["tide", "quay", 'the "old" pier', "ñandú", ",", '"', "\n", "\r\n" if end != "\n" else "\n", '""']) for _ in range(rng.randint(0, 25))]
        return " ".join(words)

    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(["", *NAMES[1:]])
    for k in range(rows):
        writer.writerow([k, *[cell() for _ in range(5)]])
        if rng.random() < 0.1:
            out.write(end)  # empty lines are no records
        if rng.random() < 0.1:
            out.write(f'{rows + k},5" wide,6"" x "7",a"b,c "d" e,f{end}')  # quotes that open nothing
    return out.getvalue()


def whole(spark, path):
    """The file read by one task."""
    schema = ", ".join(f"`{n}` string" for n in NAMES)
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, enforceSchema=True, mode="FAILFAST", **tables.DIALECT)


@pytest.mark.parametrize("size, end", [("600b", "\n"), ("2k", "\r\n"), ("128m", "\n")])
def test_ranges_give_the_records_of_one_reader(spark, tmp_path, size, end):
    (tmp_path / "a").mkdir()
    for k in range(2):
        (tmp_path / "a" / f"notes{k}.csv").write_bytes(made(k, 60, end).encode())
    (tmp_path / "a" / "header.csv").write_bytes(("," + ",".join(NAMES[1:]) + end).encode())
    path = str(tmp_path / "a")
    want = sorted(map(tuple, whole(spark, path).collect()), key=str)
    assert len(want) > 120
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        tasks = records.lines(spark, path).rdd.getNumPartitions()
        assert tasks > 10 if size != "128m" else tasks <= 3
        got = records.records(spark, path)
        assert got.where("first").count() == 3
        raw = got.where("not first").select(records.cells(F.col("text"), NAMES, **tables.DIALECT).alias("c")).select("c.*")
        assert sorted(map(tuple, raw.collect()), key=str) == want
        assert tables.read_notes_csv(spark, path).count() == len(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_small_ranges_share_tasks_and_files(spark, tmp_path):
    (tmp_path / "notes.csv").write_bytes(made(3, 2500).encode())
    path = str(tmp_path / "notes.csv")
    want = sorted(map(tuple, whole(spark, path).collect()), key=str)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600b")
    try:
        most = records.TASKS_A_CORE * spark.sparkContext.defaultParallelism
        assert records.lines(spark, path).rdd.getNumPartitions() > 10 * most
        got = records.records(spark, path)
        assert len(got.inputFiles()) <= 2 * most and got.rdd.getNumPartitions() <= 4 * most
        raw = got.where("not first").select(records.cells(F.col("text"), NAMES, **tables.DIALECT).alias("c")).select("c.*")
        assert sorted(map(tuple, raw.collect()), key=str) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_header_that_differs_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("," + ",".join(NAMES[1:]) + "\n1,d,t,s,k,m\n")
    (tmp_path / "b.csv").write_text("," + ",".join(reversed(NAMES[1:])) + "\n1,d,t,s,k,m\n")
    with pytest.raises(ValueError, match="differs"):
        tables.read_notes_csv(spark, str(tmp_path))


def test_a_header_in_quotes_over_two_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",description,transcription,sample_name,keywords,medical_specialty,\"more\nof it\"\n1,d,t,s,k,m,x\n")
    got = tables.read_notes_csv(spark, str(tmp_path / "a.csv"))
    assert got.columns[-1] == "more\nof it" and got.first()[-1] == "x"
