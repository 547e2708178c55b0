"""The driver contract in __spark_entry__.py."""
import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as E

ROOT = os.path.dirname(os.path.abspath(E.__file__))


def test_contract(spark):
    qs, ora = E.queries(), E.oracle_sql()
    assert set(ora) <= set(qs)
    assert len(qs) >= 112 and len(ora) >= 102
    assert all(callable(f) for f in qs.values())
    assert all(sql.lstrip().upper().startswith(("WITH", "SELECT")) for sql in ora.values())
    df = E.entry(spark)
    assert df.count() > 0
    assert "run_key" in df.columns and "first_alert" in df.columns


@pytest.mark.parametrize("pipeline", [True, False])
def test_without_training_data_operators(tmp_path, pipeline):
    """A copy without the folder of these operators (and without the pipeline) lists all other queries."""
    shutil.copytree(os.path.join(ROOT, "faultline"), tmp_path / "faultline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py"] + ["corpus_pipeline.py"] * (pipeline and os.path.exists(os.path.join(ROOT, "corpus_pipeline.py"))):
        shutil.copy(os.path.join(ROOT, name), tmp_path)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as E; print('\\n'.join(E.queries()))"], cwd=tmp_path, capture_output=True, text=True, check=True).stdout
    others = [q for q in E.queries() if q != "pipeline" and not (q.startswith("op") and q[2].isdigit())]
    assert out.split() == others
