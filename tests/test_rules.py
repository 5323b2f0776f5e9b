"""What the package must not do, whatever the data: checked on its source."""

import pathlib
import re

import pytest

PACKAGE = pathlib.Path(__file__).parent.parent / "churnspark"
# The subpackage llm may be absent; tests/llm has the rules for it.
SOURCES = sorted(p for p in PACKAGE.rglob("*.py") if p.relative_to(PACKAGE).parts[0] != "llm")


@pytest.mark.parametrize("pattern", [r"\.localCheckpoint\(", r"\.crossJoin\(", r"\.rdd\b", r"F\.udf\(", r"\.collect\(\)\s*\n?\s*for "])
def test_not_used(pattern):
    assert [p.name for p in SOURCES if re.search(pattern, p.read_text())] == []


def test_broadcast_hints_are_bounded():
    """A plain broadcast hint stands only where the rows are bounded by features or range partitions."""
    plain = {p.name: len(re.findall(r"F\.broadcast\(", p.read_text())) for p in SOURCES}
    assert {k: v for k, v in plain.items() if v} == {"session.py": 1, "ordering.py": 2}


def test_cluster_needs_a_shared_folder(spark):
    from churnspark.session import scratch_path

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Session(), "x")
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
