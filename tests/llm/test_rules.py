"""Source rules of the llm operators."""

import ast
import os

from conftest import ROOT


def sources():
    folder = os.path.join(ROOT, "gridlens", "llm")
    for f in [*sorted(os.listdir(folder)), "../../corpus_pipeline.py"]:
        if f.endswith(".py"):
            path = os.path.join(folder, f)
            yield path, ast.parse(open(path).read())


def test_no_cross_join_local_checkpoint_or_rdd():
    for path, tree in sources():
        for n in ast.walk(tree):
            assert not (isinstance(n, ast.Attribute) and n.attr in ("crossJoin", "localCheckpoint", "rdd", "mapPartitions")), path


def test_native_operators_run_no_python():
    for name in ("sharding", "chat"):
        text = open(os.path.join(ROOT, "gridlens", "llm", name + ".py")).read()
        for word in ("mapIn", "applyIn", "udf", "pandas", "pyarrow", "numpy"):
            assert word not in text, (name, word)


def test_nothing_else_imports_llm():
    for top, dirs, files in os.walk(os.path.join(ROOT, "gridlens")):
        dirs[:] = [d for d in dirs if d != "llm"]
        for f in files:
            if f.endswith(".py"):
                assert "gridlens.llm" not in open(os.path.join(top, f)).read(), f
