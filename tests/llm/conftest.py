import os

import pytest

ROOT = "/root/testdata/sf0.001"


@pytest.fixture
def root():
    if not os.path.isdir(ROOT):
        pytest.skip("no test tables here")
    return ROOT


@pytest.fixture
def listed():
    return lambda df, *columns: sorted(tuple(r[c] for c in columns or df.columns) for r in df.collect())
