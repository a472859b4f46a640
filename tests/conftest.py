import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark import build_session

    session = build_session(
        "tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session", autouse=True)
def shared_lake():
    """Queries that read the corrected lake of one folder share it: it takes two cycles to make."""
    from tidemark.plans import catalog

    made, build = {}, catalog.corrected_lake

    def once(t):
        if t.folder not in made:
            made[t.folder] = build(t)
        return made[t.folder]

    catalog.corrected_lake = once
    yield
    catalog.corrected_lake = build


@pytest.fixture
def lake(tmp_path):
    return str(tmp_path)


def rows(df, *order):
    """Rows as dicts, in the given order."""
    return [r.asDict(recursive=True) for r in (df.orderBy(*order) if order else df).collect()]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
