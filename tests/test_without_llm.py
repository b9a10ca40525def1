"""The rest imports without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


SAID = "import __spark_entry__ as e; print(sum(q.startswith('op') or q == 'pipeline' for q in e.queries()), len(e.oracle_sql()) > 60)"


def copied(folder, *files):
    shutil.copytree(ROOT / "meterwatch", folder / "meterwatch", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "oracle_queries.py", *files):
        shutil.copy(ROOT / name, folder / name)
    return lambda: subprocess.run([sys.executable, "-c", SAID], cwd=folder, capture_output=True, text=True)


@pytest.mark.parametrize("files", [(), ("corpus_pipeline.py",)])
def test_entry_without_the_llm_folder(tmp_path, files):
    files = [f for f in files if (ROOT / f).exists()]
    assert copied(tmp_path, *files)().stdout.split() == ["0", "True"]


def test_a_fault_inside_the_operators_is_not_hidden(tmp_path):
    run = copied(tmp_path)
    (tmp_path / "meterwatch" / "llm").mkdir()
    (tmp_path / "meterwatch" / "llm" / "__init__.py").write_text("")
    (tmp_path / "meterwatch" / "llm" / "queries.py").write_text("import no_such_package")
    assert "no_such_package" in run().stderr
