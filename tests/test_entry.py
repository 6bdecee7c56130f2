import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__

ROOT = os.path.dirname(os.path.abspath(__spark_entry__.__file__))


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_loads_without_its_optional_part(tmp_path, pipeline):
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{ROOT}/tagreef", tmp_path / "tagreef", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "tagreef" / "llm" / "__pycache__").mkdir(parents=True)  # what an emptied folder may leave
    if pipeline and os.path.exists(f"{ROOT}/corpus_pipeline.py"):
        shutil.copy(f"{ROOT}/corpus_pipeline.py", tmp_path)
    code = "import __spark_entry__ as e; from tagreef import checks; assert e.queries() == checks.QUERIES and e.oracle_sql() == checks.ORACLE"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": ""}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_faults_of_the_optional_part_are_not_hidden(monkeypatch):
    monkeypatch.setitem(sys.modules, "pandas_of_nobody", None)
    with pytest.raises(ModuleNotFoundError):
        __spark_entry__._optional("pandas_of_nobody")
