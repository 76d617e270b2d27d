"""The library without its optional subpackage and pipeline."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from cohortrates.catalog.registry import QUERIES

ROOT = Path(__file__).resolve().parent.parent

ASK = """
import __spark_entry__ as e
from cohortrates.session import build_session
assert set(e.queries()) == set(e.oracle_sql()), "a query without SQL"
spark = build_session("without", "local[1]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"})
print("QUERIES", len(e.queries()), e.queries()["prevalence_overall"](spark, e.SMOKE_DIR).count())
spark.stop()
"""


def copy_without(folder: Path, *names: str) -> Path:
    def left_out(at: str, found: list[str]) -> set[str]:
        here = Path(at).relative_to(ROOT)
        return {n for n in found if str(here / n) in names or n in (".git", "__pycache__")}

    shutil.copytree(ROOT, folder / "copy", ignore=left_out)
    return folder / "copy"


@pytest.mark.parametrize("names", [("cohortrates/llm", "tests/llm"), ("cohortrates/llm", "tests/llm", "corpus_pipeline.py")])
def test_other_queries_work(tmp_path, names):
    done = subprocess.run([sys.executable, "-c", ASK], cwd=copy_without(tmp_path, *names), capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    said = done.stdout.split("QUERIES")[1].split()
    assert int(said[0]) == len(QUERIES) and int(said[1]) > 0


def test_other_errors_are_not_hidden(tmp_path):
    (copy := copy_without(tmp_path, "cohortrates/llm", "tests/llm")) and (copy / "cohortrates/llm").mkdir()
    (copy / "cohortrates/llm/__init__.py").write_text("import no_such_module_at_all\n")
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=copy, capture_output=True, text=True, timeout=300)
    assert done.returncode != 0 and "no_such_module_at_all" in done.stderr
