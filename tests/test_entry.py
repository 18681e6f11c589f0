"""The entry without its optional part."""

import builtins
import importlib

import pytest

import __spark_entry__ as contract
from landledger.sample_queries import QUERIES


@pytest.mark.parametrize("absent", ["landledger.llm", "corpus_pipeline", "ahocorasick", "xxhash", "zstandard"])
def test_warehouse_queries_stay_without_a_library(monkeypatch, absent):
    real = builtins.__import__

    def without(name, *args, **kwargs):
        if name == absent or name.startswith(("landledger.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(f"No module named {absent!r}", name=absent)
        return real(name, *args, **kwargs)
    with monkeypatch.context() as patched:
        patched.setattr(builtins, "__import__", without)
        with pytest.warns(UserWarning, match=absent):
            importlib.reload(contract)
        assert set(contract.queries()) == set(QUERIES) == set(contract.oracle_sql())
    importlib.reload(contract)
    assert set(QUERIES) <= set(contract.queries())
