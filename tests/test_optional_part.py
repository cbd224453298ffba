"""The rest of the repository without its optional part."""

import os
import shutil
import subprocess
import sys

import pytest

from conftest import ROOT

LISTED = "import __spark_entry__ as e; print(*sorted(set(e.queries()) | set(e.oracle_sql())))"


def listed(folder):
    said = subprocess.run([sys.executable, "-c", LISTED], cwd=folder, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    return said.stdout.split()


@pytest.mark.parametrize("pipeline_left", [False, True])
def test_entry_without_optional_part(folder, pipeline_left):
    """Query names with ``tradewatch/llm`` gone, and with or without ``corpus_pipeline.py``."""
    copy = f"{folder}/copy"
    gone = shutil.ignore_patterns(".git", "llm", "__pycache__", *([] if pipeline_left else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, copy, ignore=gone)
    names = listed(copy)
    assert len(names) > 80 and not any(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in names)
    assert set(names) <= set(listed(ROOT))


def test_nothing_else_imports_the_optional_part():
    for top in ("tradewatch", "tools", "tests"):
        for path, folders, files in os.walk(f"{ROOT}/{top}"):
            folders[:] = [f for f in folders if f not in ("llm", "__pycache__")]
            for name in files:
                if name.endswith(".py") and name != os.path.basename(__file__):
                    with open(f"{path}/{name}") as source:
                        assert "tradewatch.llm" not in source.read(), name
