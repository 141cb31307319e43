import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
DATA = os.environ.get("CORPUSLOOM_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from corpusloom.runtime import local_session

    session = local_session(4, shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def oracle():
    """Answers SQL over the test tables."""
    duckdb = pytest.importorskip("duckdb")
    if not Path(DATA).exists():
        pytest.skip("no test tables here")
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for path in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")

    def ask(sql):
        cursor = connection.execute(sql)
        return [c[0] for c in cursor.description], cursor.fetchall()

    return ask


@pytest.fixture(scope="session")
def same_as_sql(spark, oracle):
    """Checks a query against its SQL, columns by name and rows in any order."""

    def check(query, sql):
        df = query(spark, DATA)
        names, wanted = oracle(sql)
        assert sorted(df.columns) == sorted(names)
        assert canonical(df.columns, df.collect()) == canonical(names, wanted)

    return check


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(x):
        if isinstance(x, float):
            return None if x != x else round(x, 9) + 0.0
        if isinstance(x, (list, tuple)):
            return tuple(plain(y) for y in x)
        return x

    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)
