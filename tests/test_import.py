"""The entry module must import where Spark's own files cannot be found next to the package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_spark_files(tmp_path):
    code = (
        "import pyspark, sys\n"
        f"pyspark.__file__ = {str(tmp_path / '__init__.py')!r}\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) >= 136 and len(e.oracle_sql()) >= 116\n"
        "from pyspark.sql import SparkSession\n"
        "assert SparkSession.getActiveSession() is None\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
