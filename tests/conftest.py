import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for folder in (ROOT, os.path.join(ROOT, "tools")):
    sys.path.insert(0, folder)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lapframe.session import build_session

    session = build_session(
        "lapframe-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows and a DDL schema to a DataFrame; texts that look like times become timestamps."""

    def make(rows, ddl):
        target = spark.createDataFrame([], ddl).schema
        loose = ", ".join(
            f"`{f.name}` {'string' if f.dataType.typeName() == 'timestamp' else f.dataType.simpleString()}"
            for f in target.fields
        )
        df = spark.createDataFrame(rows, loose)
        return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in target.fields])

    return make
