import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from registrum.session import build, ship

    s = build(
        "tests", "local[4]", spark__driver__memory="4g", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('shared')}", spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    yield s
    s.stop()
