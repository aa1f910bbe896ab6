"""Physical plans of all registered batch queries."""

import pytest

import __spark_entry__ as contract
from workload.queries import QUERIES
from tests.conftest import plan_of

BATCH = sorted(name for name in QUERIES if not name.startswith("stream_"))


@pytest.mark.parametrize("name", BATCH)
def test_no_nested_loop_product_or_python(spark, sf_dir, name):
    plan = plan_of(contract.queries()[name](spark, sf_dir))
    for operator in ("NestedLoop", "CartesianProduct", "PythonUDF", "ArrowEval", "MapInPandas"):
        assert operator not in plan


#: Hot keys, runs of the numbering in place, and dictionaries of names; each is counted before or cannot exceed a parameter.
BOUNDED = ("spread.py", "keys.py", "incidents.py")


def test_only_bounded_lists_have_a_broadcast_hint():
    import pathlib

    for path in pathlib.Path("fleetscope").rglob("*.py"):
        if "llm" in path.parts or path.name in BOUNDED:
            continue
        assert "broadcast(" not in path.read_text()
