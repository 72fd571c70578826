import io
import sys
from contextlib import redirect_stdout
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, spark__sql__maxMetadataStringLength="10000")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def plan():
    """The physical plan of a frame as text."""

    def explained(df):
        text = io.StringIO()
        with redirect_stdout(text):
            df.explain()
        return text.getvalue()

    return explained
