"""The entry point with and without what is optional."""

import subprocess
import sys
from pathlib import Path

import pytest

from paywarden.registry import QUERIES

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("module", ["xxhash", "public_tokenizers", "pyarrow.compute", "paywarden.llm", "corpus_pipeline"])
def test_core_queries_do_without_optional_modules(module):
    code = f"import sys; sys.modules[{module!r}] = None; import __spark_entry__ as e; print(*e.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    assert set(QUERIES) <= set(done.stdout.split()) and "op1_" not in done.stdout
    if (ROOT / "paywarden" / "llm").exists():
        named = module.startswith(("paywarden.llm", "corpus_pipeline"))
        assert ("without the operators" in done.stderr) != named
