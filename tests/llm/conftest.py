import pathlib
import sys

import duckdb
import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def oracle():
    connection = duckdb.connect()
    for path in sorted(pathlib.Path("/root/testdata/sf0.01").glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection
