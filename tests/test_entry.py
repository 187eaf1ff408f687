"""The entry points, also where the training-data subpackage is absent."""

import subprocess
import sys

import pytest

CODE = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name in ("corpus_pipeline", "tidemark.llm"):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as e
assert e.queries() and not [k for k in e.queries() if k.startswith("op") or k == "pipeline"]
assert set(e.oracle_sql()) <= set(e.queries())
"""


@pytest.mark.parametrize("absent", ['"corpus_pipeline", "tidemark.llm"', '"ahocorasick"', '"public_tokenizers"'])
def test_entry_without_the_subpackage(absent):
    code = CODE.replace('"corpus_pipeline", "tidemark.llm"', absent)
    subprocess.run([sys.executable, "-c", code.replace(f"({absent})", f"({absent},)")], check=True, cwd=__file__.rsplit("/", 2)[0])


def test_entry(spark, sf_dir):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
