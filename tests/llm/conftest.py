import os
import random

import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    return FOLDER


@pytest.fixture
def rng():
    return random.Random(5)
