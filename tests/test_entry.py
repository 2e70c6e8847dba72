"""The registered queries: names, SQL beside them, independence of the optional subpackage."""

import ast
import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_sql_is_beside_queries():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and "did_events" in e.queries()


def test_nothing_outside_needs_the_subpackage():
    for f in (ROOT / "lacuna").rglob("*.py"):
        if "llm" not in f.relative_to(ROOT).parts:
            for node in ast.walk(ast.parse(f.read_text())):
                names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
                assert not any("llm" in n or "corpus_pipeline" in n for n in names), f


def test_entry_without_the_subpackage(tmp_path):
    for f in (ROOT / "lacuna").rglob("*.py"):
        if "llm" not in f.relative_to(ROOT).parts:
            to = tmp_path / f.relative_to(ROOT)
            to.parent.mkdir(parents=True, exist_ok=True)
            to.write_text(f.read_text())
    (tmp_path / "__spark_entry__.py").write_text((ROOT / "__spark_entry__.py").read_text())
    code = "import __spark_entry__ as e; assert 'did_events' in e.queries() and not any(n.startswith('op') for n in e.queries()) and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": ""})
