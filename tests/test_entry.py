import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent


def test_entry_point_imports_without_a_session_and_names_agree():
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert len(q) > 80 and set(s) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True)


def test_flagship_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
