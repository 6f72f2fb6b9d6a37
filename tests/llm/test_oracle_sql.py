"""Twins in SQL are SQL."""

from __future__ import annotations

import __spark_entry__


def test_every_twin_is_a_string():
    assert all(isinstance(sql, str) for sql in __spark_entry__.oracle_sql().values())
