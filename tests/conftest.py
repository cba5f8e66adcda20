import datetime
from decimal import Decimal

import pytest

from basketry import schemas
from basketry.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Rows of an input table; dates as ISO text, numbers converted to the column type."""

    def convert(value, kind):
        if value is None:
            return None
        if kind == schemas.DATE:
            return datetime.date.fromisoformat(value)
        if kind in (schemas.PRICE, schemas.UNITS):
            return Decimal(str(value))
        return value

    def build(table, *rows):
        schema = schemas.TABLES[table]
        kinds = [field.dataType for field in schema.fields]
        converted = [
            tuple(convert(v, k) for v, k in zip(row, kinds, strict=True)) for row in rows
        ]
        return spark.createDataFrame(converted, schema)

    return build
