import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.mark.parametrize("name", ["touchstone.llm.warc", "regex"])
def test_missing_library_or_module_is_an_error(name):
    code = f"import sys; sys.modules[{name!r}] = None; import __spark_entry__"
    out = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": REPO})
    assert out.returncode != 0 and "ModuleNotFoundError" in out.stderr
