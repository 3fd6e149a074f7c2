import importlib

import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    importlib.import_module("bench")


def test_core_does_not_need_the_other_subpackage(monkeypatch):
    real = importlib.import_module

    def missing(name, *a):
        if name.startswith("folioframe.llm"):
            raise ModuleNotFoundError(name, name="folioframe.llm")
        return real(name, *a)

    monkeypatch.setattr(entry.importlib, "import_module", missing)
    assert "p1_found" in entry.queries() and "p2_found" not in entry.queries() and "p5_forms" not in entry.oracle_sql()


def test_flagship(spark):
    if not importlib.import_module("os").path.isdir(SMALL):
        pytest.skip("no test data")
    assert entry.entry(spark).count() > 0
