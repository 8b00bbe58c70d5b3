from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerfeat.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session


def rows_of(df, *order):
    """Rows as tuples in a stable order, doubles rounded."""
    def plain(v):
        return round(v, 9) + 0.0 if isinstance(v, float) else v
    out = [tuple(plain(v) for v in r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))
