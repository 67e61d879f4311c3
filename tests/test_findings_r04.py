"""Findings of round 4: a table's failure is told."""

import pytest
from test_scale import DIR

from lingualake.operators import database as DB
from lingualake.plans import registry


@pytest.fixture
def failing(monkeypatch):
    """One table's job fails, as on a full disk."""
    long_form = DB.long_form

    def fails(name, *args, **rules):
        if name == "catalog_texts":
            raise OSError("No space left on device")
        return long_form(name, *args, **rules)

    monkeypatch.setattr(DB, "long_form", fails)


@pytest.mark.parametrize("name", ["database_changes", "backfill_report", "database_strings", "tables_with_source"])
def test_a_failed_table_is_no_result(spark, failing, name):
    """the other tables' rows were given as the database's."""
    with pytest.raises(RuntimeError, match="catalog_texts: No space left"):
        registry.ENTRIES[name][0](spark, DIR).collect()


def test_a_failed_table_is_logged(spark, failing):
    """the run goes on and names it, and it has no change sets."""
    log = {r["table"]: r["status"] for r in registry.ENTRIES["backfill_run"][0](spark, DIR).collect()}
    assert log == {"catalog": "completed", "imported": "completed", "catalog_texts": "failed"}
    with pytest.raises(RuntimeError, match="catalog_texts"):
        DB.change_sets(registry._database(spark, DIR), "catalog_texts")
