from __future__ import annotations

import pytest

from rainlane.session import local_session


def pytest_addoption(parser):
    parser.addoption(
        "--captured",
        default=None,
        help="folder with captured inputs: raw/api/*.json and raw/mysql/*.csv",
    )
    parser.addoption("--tables", default="/root/testdata/sf0.001", help="folder of sample tables")


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "rainlane-tests")


@pytest.fixture(scope="session")
def tables(request):
    return request.config.getoption("--tables")
