import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from crestline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """``frame("a int, b string", (1, "x"), ...)``; dates and instants may be given as text."""

    def make(ddl, *rows):
        wanted = spark.createDataFrame([], ddl).schema
        plain = ", ".join(
            f"`{f.name}` {'string' if f.dataType.typeName() in ('date', 'timestamp') else f.dataType.simpleString()}"
            for f in wanted
        )
        df = spark.createDataFrame(list(rows), plain)
        return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in wanted])

    return make


@pytest.fixture
def rows():
    """Collected rows as sorted tuples."""

    def collect(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r])

    return collect
