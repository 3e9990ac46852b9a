import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry_works_without_the_document_operators(tmp_path):
    """The entry, its queries and SQL load where the subpackage and the pipeline are gone."""
    shutil.copytree(ROOT / "wattlake", tmp_path / "wattlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pv_detect' in q and not any(x.startswith('op1') for x in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
