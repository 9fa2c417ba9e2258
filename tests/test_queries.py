from __future__ import annotations

import pytest
from compare import same

from corpusforge.plans import registry


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, tables, name):
    df = registry.queries()[name](spark, tables)
    sql = registry.oracle_sql().get(name)
    if sql:
        assert same(df, sql, tables) == ""
    else:
        assert df.count() > 0 and df.columns


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_library_without_llm():
    """Nothing outside the llm subpackage imports it."""
    import re
    from pathlib import Path

    root = Path(registry.__file__).resolve().parent.parent
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert not re.search(r"(from|import)\s+corpusforge\.llm|from corpusforge import llm", path.read_text())
