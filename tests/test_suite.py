"""The declared data tests find planted violations and name them."""

from __future__ import annotations

import pytest

from tidemark.plans import suite


def test_planted_violations(spark, rows):
    df = spark.createDataFrame([("basic", None), ("other", "x"), (None, "y")], "export_type string, file_name string")
    declared = suite.Declared(("export_type", "file_name"), {"export_type": suite.EXPORT_TYPES})
    assert rows(suite.table_tests(df, declared)) == [("accepted_values", "export_type", 1), ("not_null", "export_type", 1), ("not_null", "file_name", 1)]


def test_failing_layer_names_its_columns(spark, monkeypatch):
    monkeypatch.setitem(suite.LAYERS, "small", {"t": suite.Declared(("a",)), "u": suite.Declared(("b",))})
    tables = {"t": spark.range(2).selectExpr("id as a"), "u": spark.range(2).selectExpr("nullif(id, 1) as b")}
    with pytest.raises(ValueError, match=r"small: u\.b not_null: 1$"):
        suite.require_layer("small", tables.__getitem__)
    suite.require_layer("small", lambda _: spark.range(2).selectExpr("id as a", "id as b"))
