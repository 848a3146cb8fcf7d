import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from chunkwright.session import get_spark


@pytest.fixture(scope="session")
def spark():
    session = get_spark("8", "6g")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
