import os

import pytest

from fleetscope.schemas import table_schema
from fleetscope.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__checkpoint__dir="file:" + str(tmp_path_factory.mktemp("checkpoints")),
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def rows(spark):
    """Builds a frame of a declared table (or of a DDL schema) from tuples.

    Rows of a table whose last column is the server may leave it out.
    """

    def build(name_or_ddl, *values):
        if " " in name_or_ddl:
            return spark.createDataFrame(list(values), name_or_ddl)
        schema = table_schema(name_or_ddl)
        short = len(schema) - 1 if schema.names[-1] == "server" else None
        values = [(*v, "S") if len(v) == short else v for v in values]
        return spark.createDataFrame(values, schema)

    return build


def as_dicts(df, *order):
    if order:
        df = df.orderBy(*order)
    return [row.asDict(recursive=True) for row in df.collect()]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
