"""Sessions, the shared checkpoint folder and scratch data."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

from commitlens import session
from commitlens.schemas import COMMIT

ROOT = Path(__file__).resolve().parents[1]


class _Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class _Context:
    def __init__(self, master, folder=None):
        self.master, self.folder, self.applicationId = master, folder, f"app-{id(self)}"

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, master, **conf):
        self.sparkContext, self.conf = _Context(master), _Conf(conf)


def test_unset_folder_is_an_error_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(_Session("spark://host:7077"))
    assert session.checkpoint_root(_Session("local[2]"))


def test_the_scheme_of_the_folder_is_kept():
    s = _Session("yarn", **{"spark.checkpoint.dir": "file:///shared/here/"})
    assert session.scratch_path(s, "x").startswith("file:///shared/here/x-")


def test_preset_shuffle_partitions_survive(tmp_path):
    code = ("from pyspark.sql import SparkSession\n"
            "SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
            ".config('spark.sql.shuffle.partitions', '37').getOrCreate()\n"
            "from commitlens.session import build_session\n"
            "print('parts', build_session().conf.get('spark.sql.shuffle.partitions'))\n")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert "parts 37" in out.stdout, out.stderr[-800:]


def test_scratch_is_empty_after_a_run(tmp_path):
    code = ("from commitlens.session import build_session, clear_scratch\n"
            "from commitlens.plans.bindings import QUERIES\n"
            "spark = build_session('local[2]')\n"
            "for k in ('commit_count', 'seq_max', 'text_top_words_cat', 'stream_daily_commits'):\n"
            "    QUERIES[k](spark, '/root/testdata/sf0.001').collect()\n"
            "clear_scratch(spark)\n"
            "again = QUERIES['commit_count'](spark, '/root/testdata/sf0.001').collect()\n"
            "print('again', again[0][0] > 0)\n"
            "clear_scratch(spark)\n")
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": f"--conf spark.checkpoint.dir={tmp_path} pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=600, env=env)
    assert "again True" in out.stdout, out.stderr[-800:]
    left = [p for p in tmp_path.rglob("*") if p.is_file()]
    assert left == []


def test_check_commits_can_be_called_again(spark, tmp_path):
    from commitlens.sources.commits import check_commits, read_commits
    (tmp_path / "c.json").write_text('{"sha": "a"}\n{"sha": "b"\n')
    for _ in range(3):
        assert check_commits(spark, str(tmp_path)).collect()[0][:] == (1, 1)
    assert read_commits(spark, str(tmp_path)).columns == [f.name for f in COMMIT.fields]


def test_a_changed_table_makes_a_new_view(spark, tmp_path):
    from commitlens.session import landed_view
    made = []
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))

    def path():
        return landed_view(spark, "v", str(tmp_path), ["t"], lambda p: (made.append(p), spark.range(1).write.parquet(p)))
    assert path() == path() and len(made) == 1
    spark.range(5).write.mode("append").parquet(str(tmp_path / "t.parquet"))
    assert path() != made[0] and len(made) == 2
