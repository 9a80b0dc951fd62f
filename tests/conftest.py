"""Shared session and helpers."""

from __future__ import annotations

import datetime
import math
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from footfall.session import local_session  # noqa: E402

RAW = "seq bigint, event_timestamp timestamp, source_type string, key string, value string, ttl bigint"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "footfall-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw_of(spark):
    """Feed rows from ``(source_type, key, value[, ttl])`` in order of arrival."""

    def make(events, start=datetime.datetime(2024, 1, 1)):
        rows = [
            (i, start + datetime.timedelta(seconds=i), e[0], e[1], e[2], e[3] if len(e) > 3 else None)
            for i, e in enumerate(events)
        ]
        return spark.createDataFrame(rows, RAW)

    return make


def text_of(value) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def bag(rows, columns):
    """Rows as a sorted list of comparable texts."""
    return sorted(tuple(text_of(r[c]) for c in columns) for r in rows)
