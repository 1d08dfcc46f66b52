"""The library without its training-data operators."""

import json
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
SAY = "import __spark_entry__ as e, json; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


def test_entry_without_the_folder_of_operators(tmp_path):
    """Their folder may go, with the pipeline or without it: the other queries stay as they are."""
    from ebbline.catalog.oracle import ORACLE
    from ebbline.catalog.queries import QUERIES

    for kept in ("corpus_pipeline.py", None):
        copy = tmp_path / (kept or "bare")
        shutil.copytree(ROOT / "ebbline", copy / "ebbline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
        for name in filter(None, ("__spark_entry__.py", kept)):
            shutil.copy(ROOT / name, copy / name)
        said = subprocess.run([sys.executable, "-c", SAY], cwd=copy, capture_output=True, text=True, check=True)
        assert json.loads(said.stdout) == [sorted(QUERIES), sorted(ORACLE)]
