import shutil
import subprocess
import sys
from pathlib import Path

from stepwave.plans.catalogue import QUERIES

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from stepwave.session import tuned
import __spark_entry__
spark = tuned(SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2")).getOrCreate()
print(__spark_entry__.queries()["cycle_peaks"](spark, {folder!r}).count())
"""


def test_workers_do_not_need_the_package(tmp_path, sf_dir):
    repo = str(Path(__file__).parents[1])
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=repo, folder=sf_dir)], cwd=tmp_path, capture_output=True, text=True
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout.split()[-1]) == 150


ENTRY = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__
print(__spark_entry__.__file__, *sorted(__spark_entry__.queries()))
"""


def test_entry_without_the_corpus_folders(tmp_path):
    """The rest is there without the corpus operators, whether or not the file of the pipeline was left."""
    repo = Path(__file__).parents[1]
    for name, files in (("with", ["__spark_entry__.py", "corpus_pipeline.py"]), ("without", ["__spark_entry__.py"])):
        copy = tmp_path / name
        shutil.copytree(repo / "stepwave", copy / "stepwave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
        for file in files:
            if (repo / file).exists():
                shutil.copy(repo / file, copy / file)
        done = subprocess.run([sys.executable, "-c", ENTRY.format(repo=str(copy))], cwd=tmp_path, capture_output=True, text=True)
        assert done.returncode == 0, done.stderr[-2000:]
        place, *names = done.stdout.split()
        assert place.startswith(str(copy))
        assert names == sorted(QUERIES)
