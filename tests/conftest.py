import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from linesmith.session import clear_scratch, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=4)
    yield session
    clear_scratch(session)
    session.stop()


def rows(df, *order):
    """Rows as sorted plain tuples."""
    return sorted((tuple(r) for r in (df.select(*order) if order else df).collect()), key=repr)
