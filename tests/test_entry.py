"""The driver's entry without the optional part."""

import subprocess
import sys

import pytest

CODE = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError("No module named " + name, name=name)
sys.meta_path.insert(0, Missing())
sys.path.insert(0, {root!r})
import __spark_entry__ as e
print(len(e.queries()), sum(q.startswith("op") for q in e.queries()))
"""


def _run(name):
    from pathlib import Path
    return subprocess.run([sys.executable, "-c", CODE.format(name=name, root=str(Path(__file__).parents[1]))], capture_output=True, text=True, timeout=120)


@pytest.mark.parametrize("name", ["emberlog.llm", "corpus_pipeline", "public_tokenizers", "xxhash", "regex"])
def test_log_queries_load_without_the_optional_part(name):
    out = _run(name)
    total, optional = map(int, out.stdout.split())
    assert optional == 0 and total > 50, out.stderr


def test_a_hole_in_the_package_is_an_error():
    assert _run("emberlog.plans.first_seen").returncode != 0
