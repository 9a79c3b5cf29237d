import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(len(e.LLM_QUERIES), len(e.queries()) == len(e.QUERIES), len(e.oracle_sql()) == len(e.ORACLES))"


def test_without_the_folders_the_rest_stands_alone(tmp_path):
    for name in ("touchstone", "workload"):
        shutil.copytree(f"{REPO}/{name}", tmp_path / name, ignore=shutil.ignore_patterns("llm"))
    shutil.copy(f"{REPO}/__spark_entry__.py", tmp_path)
    out = subprocess.run([sys.executable, "-c", COUNT], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert out.returncode == 0 and out.stdout.split() == ["0", "True", "True"], out.stderr
