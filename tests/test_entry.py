"""The driver entry without the optional training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
LIST = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"


def test_entry_without_training_data_operators(tmp_path):
    """With the operators gone, with or without the pipeline's file, all other queries are there."""
    for name, without in (("folders", ["llm"]), ("all", ["llm", "corpus_pipeline.py"])):
        copy = tmp_path / name
        shutil.copytree(ROOT / "qualitymart", copy / "qualitymart", ignore=shutil.ignore_patterns("__pycache__", *without))
        for file in ("__spark_entry__.py", "corpus_pipeline.py"):
            if file not in without and (ROOT / file).exists():
                shutil.copy(ROOT / file, copy / file)
        found = subprocess.run([sys.executable, "-c", LIST], cwd=copy, env={"PYTHONPATH": "", "PATH": "/usr/bin:/bin"}, capture_output=True, text=True, check=False)
        assert found.returncode == 0, found.stderr[-2000:]
        queries, oracles, pipeline = found.stdout.split()
        assert int(queries) >= 170 and int(oracles) >= 170 and pipeline == "False"
