"""Source-level guards on the library: no local checkpoints, no driver-side collects,
no Python UDFs, no hard-coded machine-local paths."""

import pathlib
import re
import subprocess
import sys

LIB = pathlib.Path(__file__).resolve().parent.parent / "callsight"
SOURCES = {p: p.read_text() for p in LIB.rglob("*.py")}


def offenders(pattern: str, allow: tuple[str, ...] = ()) -> list[str]:
    return [str(p) for p, src in SOURCES.items() if re.search(pattern, src) and p.name not in allow]


def test_no_local_checkpoint():
    assert offenders(r"localCheckpoint") == []


def test_no_driver_collects():
    assert offenders(r"\.collect\(\)|\.toPandas\(|\.toLocalIterator\(") == []


def test_no_python_udfs():
    # the operators for training data, in a subpackage of their own, choose their style
    bad = offenders(r"\budf\(|pandas_udf|applyInPandas|mapInPandas|\.rdd\b")
    assert [p for p in bad if pathlib.Path(p).parent.name != "llm"] == []


def test_no_machine_local_paths():
    # the only temp folder is the local-master fallback in session.py
    assert offenders(r"[\"']/tmp|tempfile", allow=("session.py",)) == []


def test_nothing_imports_the_training_data_subpackage():
    bad = offenders(r"callsight[./]llm|from callsight import llm|corpus_pipeline")
    assert [p for p in bad if pathlib.Path(p).parent.name != "llm"] == []


def test_entry_works_without_the_training_data_subpackage():
    # blocked, as if the folder, or a package it needs, were missing
    code = (
        "import sys; sys.modules['callsight.llm'] = None; sys.path.insert(0, sys.argv[1]); "
        "import __spark_entry__ as e; from callsight.plans import registry as r; "
        "assert e.queries() == r.QUERIES and e.oracle_sql() == r.ORACLE"
    )
    done = subprocess.run([sys.executable, "-c", code, str(LIB.parent)], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
