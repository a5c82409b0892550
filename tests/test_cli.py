import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def _run(*args):
    return subprocess.run([sys.executable, "-m", "commitlens", *args], cwd=ROOT, capture_output=True, text=True,
                          timeout=600)


def test_cli_list_and_sql():
    out = _run("list")
    assert out.returncode == 0 and "commit_ext_freq" in out.stdout.split()
    sql = _run("sql", "commit_ext_freq")
    assert "SELECT" in sql.stdout


def test_cli_run_writes_result(tmp_path):
    out = _run("run", "commit_ext_freq", "--sf", "/root/testdata/sf0.001", "--master", "local[2]", "--show", "5",
               "--out", str(tmp_path / "res"), "--format", "csv")
    assert out.returncode == 0, out.stderr[-2000:]
    assert "ext" in out.stdout
    assert any(p.suffix == ".csv" for p in (tmp_path / "res").iterdir())


def test_cli_refuses_to_overwrite(tmp_path):
    args = ("run", "commit_count", "--sf", "/root/testdata/sf0.001", "--master", "local[2]", "--out", str(tmp_path / "o"))
    assert _run(*args).returncode == 0
    again = _run(*args)
    assert again.returncode != 0 and "PATH_ALREADY_EXISTS" in again.stderr
    assert _run(*args, "--overwrite").returncode == 0
