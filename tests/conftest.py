import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from duebook.session import local_session  # noqa: E402
from duebook.sources.vault import SCHEMAS, from_frames, schema_of  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, app="duebook-tests")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """Build a source table from dicts; missing columns are null."""
    from pyspark.sql import functions as F

    def make(name, *rows):
        schema = schema_of(name)
        texts = [tuple(None if r.get(f.name) is None else str(r[f.name]) for f in schema.fields) for r in rows]
        columns = ", ".join(f"`{f.name}` string" for f in schema.fields)
        df = spark.createDataFrame(texts, columns)
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])

    return make


@pytest.fixture
def vault(spark, table):
    """A vault of small tables; tables not given are empty."""

    def make(**tables):
        frames = {name: table(name, *tables.get(name, [])) for name in SCHEMAS}
        return from_frames(spark, frames)

    return make


@pytest.fixture
def rows():
    """Rows as sorted tuples of texts."""

    def key(row):
        return [(v is None, v or "") for v in row]

    return lambda df, *columns: sorted(
        (tuple(None if v is None else str(v) for v in r) for r in (df.select(*columns) if columns else df).collect()), key=key
    )
