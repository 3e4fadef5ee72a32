import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from fieldsignal.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("8", 4)


def by_row(df, *columns):
    """Values of the columns in series and row order, as plain lists."""
    rows = df.orderBy("series_id", "row_idx").select(*columns).collect()
    return [row[0] if len(columns) == 1 else tuple(row) for row in rows]
