import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SAY = "import __spark_entry__ as e; q = e.queries(); o = e.oracle_sql(); print(len(q), sum(k.startswith('op') for k in q), 'pipeline' in q, set(o) <= set(q))"


def names(tmp_path, *gone):
    for part in ("allelix", "__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / part).is_dir():
            shutil.copytree(ROOT / part, tmp_path / part)
        elif (ROOT / part).exists():
            shutil.copy(ROOT / part, tmp_path / part)
    for part in gone:
        at = tmp_path / part
        if at.is_dir():
            shutil.rmtree(at)
        else:
            at.unlink(missing_ok=True)
    done = subprocess.run([sys.executable, "-c", SAY], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True)
    count, numbered, pipeline, known = done.stdout.split()
    return int(count), int(numbered), pipeline == "True", known == "True"


@pytest.mark.parametrize("gone", [("allelix/llm",), ("allelix/llm", "corpus_pipeline.py")])
def test_other_queries_stay_without_the_training_data_operators(tmp_path, gone):
    count, numbered, pipeline, known = names(tmp_path, *gone)
    assert count >= 98 and numbered == 0 and not pipeline and known


def test_a_module_that_cannot_be_imported_takes_only_its_own_queries(tmp_path):
    (tmp_path / "xxhash.py").write_text("raise ImportError")
    count, numbered, pipeline, known = names(tmp_path)
    assert count >= 98 and numbered == 0 and not pipeline and known


def test_without_the_pipeline_file_the_rest_stays(tmp_path):
    pytest.importorskip("allelix.llm.queries")
    assert names(tmp_path, "corpus_pipeline.py")[1:3] == (13, False)
