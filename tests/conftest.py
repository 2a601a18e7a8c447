import os

import pytest

from orderlake import session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    built = session.build(
        f"local[{os.environ.get('TEST_CPUS', '4')}]",
        "orderlake-tests",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(folder / "warehouse"),
    )
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()


@pytest.fixture
def sf_dir():
    return SF_DIR
