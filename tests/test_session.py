from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

from corpuscope.session import ship

PROGRAM = """
import sys
sys.path.append(sys.argv[1])
from pyspark.sql import SparkSession
from corpuscope.session import tuned
from corpuscope.sources import tables

spark = tuned(
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", sys.argv[2] + "/shared").getOrCreate()
)
print("rows", tables.read_notes_csv(spark, sys.argv[2] + "/notes.csv").count())
"""


def test_workers_get_the_package_in_any_folder(tmp_path):
    """The workers' folder and path do not hold the package."""
    (tmp_path / "notes.csv").write_text(',description,transcription,sample_name,keywords,medical_specialty\n0,d,"a\nb",s,k,m\n1,d,t,s,k,m\n')
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable}
    repo = str(Path(__file__).resolve().parents[1])
    done = subprocess.run([sys.executable, "-c", PROGRAM, repo, str(tmp_path)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "rows 2" in done.stdout, done.stderr[-3000:]


def test_the_package_is_sent_once(spark):
    before = spark.sparkContext.listFiles
    assert ship(spark) is spark and spark.sparkContext.listFiles == before
