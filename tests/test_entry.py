"""What the driver imports, with and without the optional parts."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.join(os.path.dirname(os.path.abspath(__file__)), "..")


def imported(prepare):
    code = f"import sys\n{prepare}\nimport __spark_entry__ as e\nprint(len(e.queries()), 'turnover_metrics' in e.oracle_sql())"
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)


@pytest.mark.parametrize("absent", ["zstandard", "ahocorasick", "public_tokenizers"])
def test_without_a_package_of_the_text_operators(absent):
    from saldo.catalog.queries import QUERIES

    done = imported(f"sys.modules[{absent!r}] = None")
    assert done.stdout.split() == [str(len(QUERIES)), "True"], done.stderr
    assert not os.path.isdir(os.path.join(ROOT, "saldo", "llm")) or f"the package {absent} is missing" in done.stderr


def test_faults_inside_are_not_hidden():
    if not os.path.isdir(os.path.join(ROOT, "saldo", "llm")):
        pytest.skip("the text operators are not there")
    done = imported("import saldo.llm.quality as q; del q.quality")
    assert done.returncode and "cannot import name 'quality'" in done.stderr
