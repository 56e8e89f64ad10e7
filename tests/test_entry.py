import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(entry.__file__).parent


def test_names_and_oracles_belong_together():
    names = set(entry.queries())
    assert set(entry.oracle_sql()) <= names and "people_consolidate" in names


def test_imports_without_the_corpus_operators(tmp_path):
    for name in ("__spark_entry__.py", "factweave"):
        (tmp_path / name).symlink_to(ROOT / name) if name.endswith(".py") else None
    package = tmp_path / "factweave"
    package.mkdir()
    for item in (ROOT / "factweave").iterdir():
        if item.name not in ("llm", "__pycache__"):
            (package / item.name).symlink_to(item)
    code = "import __spark_entry__ as e; assert e.llm is None and 'url_normalize' in e.queries() and not any(q.startswith('op') for q in e.queries())"
    copy = tmp_path / "run"
    copy.mkdir()
    (copy / "__spark_entry__.py").write_text((ROOT / "__spark_entry__.py").read_text())
    package.rename(copy / "factweave")
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env={"PYTHONPATH": str(copy), "PATH": "/usr/bin:/bin:" + str(Path(sys.executable).parent)})


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
