"""The driver contract holds without the optional corpus operators, and hides no other import error."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _names(*absent):
    code = (
        "import sys\n"
        f"for name in {absent!r}: sys.modules[name] = None\n"
        "import __spark_entry__ as e\n"
        "from tillflow.plans import ORACLE_SQL, QUERIES\n"
        "assert set(QUERIES) <= set(e.queries()) and set(ORACLE_SQL) <= set(e.oracle_sql())\n"
        "print('EXTRA', len(set(e.queries()) - set(QUERIES)))\n"
    )
    return subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT)


def test_entry_without_the_corpus_operators():
    for absent in (("corpus_pipeline",), ("tillflow.llm",), ("corpus_pipeline", "tillflow.llm")):
        out = _names(*absent)
        assert out.returncode == 0 and "EXTRA 0" in out.stdout, out.stderr


def test_other_import_errors_are_not_hidden():
    out = _names("pandas")
    assert out.returncode != 0 and "pandas" in out.stderr
