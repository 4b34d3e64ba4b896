import subprocess
import sys
from pathlib import Path

import pytest
from compare import connect, differences

import __spark_entry__ as registered
from tidemark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) == []


def test_every_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(registered.queries())


def test_the_rest_works_without_the_text_operators(tmp_path):
    """As if the folders and the pipeline had been deleted."""
    repo = Path(registered.__file__).parent
    hide = "import sys; sys.modules['corpus_pipeline'] = None; sys.modules['tidemark.llm'] = None; "
    code = hide + "import __spark_entry__ as e; assert len(e.queries()) >= 47 and not any(q.startswith('op') for q in e.queries())"
    assert subprocess.run([sys.executable, "-c", code], cwd=repo, capture_output=True, check=False).returncode == 0
