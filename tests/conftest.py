import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from clanweave.session import local_session

    s = local_session("4", 4, "tests")
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture
def rows():
    def collect(df, *cols):
        return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))

    return collect
