import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from creditloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("creditloom-tests", f"local[{os.environ.get('TEST_CPUS', '8')}]", spark__sql__shuffle__partitions="8",
                            spark__ui__enabled="false", spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
