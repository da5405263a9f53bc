"""The entry module stands without the optional text-preparation part."""

import os
import shutil
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LISTS = "import __spark_entry__ as e; print(len(e.queries()), sorted(set(e.queries()) & {'pipeline'}))"


@pytest.mark.parametrize("left", [[], ["corpus_pipeline.py"]], ids=["neither", "pipeline only"])
def test_entry_without_the_text_folders(tmp_path, left):
    for name in ["rillstone", "catalog"]:
        shutil.copytree(f"{HERE}/{name}", tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py", *left]:
        if os.path.exists(f"{HERE}/{name}"):
            shutil.copy(f"{HERE}/{name}", tmp_path / name)
    run = subprocess.run([sys.executable, "-c", LISTS], cwd=tmp_path, capture_output=True, text=True, check=False)
    assert run.returncode == 0, run.stderr
    count, names = run.stdout.split(maxsplit=1)
    assert int(count) > 100 and names.strip() == "[]"
