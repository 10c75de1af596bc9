"""The library and its entry work without the subpackage ``llm``, with and without the pipeline's module."""

import os
import shutil
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAYS = "import __spark_entry__ as e; names = set(e.queries()); print(len(names), any(n.startswith('op') and n[2].isdigit() for n in names), 'pipeline' in names, set(e.oracle_sql()) <= names)"


def said(at):
    out = subprocess.run([sys.executable, "-B", "-c", SAYS], cwd=at, env=os.environ | {"PYTHONPATH": at}, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return out.stdout.split()


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_entry_without_the_subpackage(tmp_path, with_pipeline):
    at = str(tmp_path / "repo")
    shutil.copytree(HERE, at, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", *([] if with_pipeline else ["corpus_pipeline.py"])))
    from boxloom.plans import catalog

    assert said(at) == [str(len(catalog.queries())), "False", "False", "True"]


def test_nothing_else_imports_the_subpackage():
    for folder, _, names in os.walk(os.path.join(HERE, "boxloom")):
        if os.path.basename(folder) != "llm":
            for name in names:
                if name.endswith(".py"):
                    assert "boxloom.llm" not in open(os.path.join(folder, name)).read(), name
