import pytest
from pyspark.sql import functions as F
from rows import odd_rows

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """The rows above with columns whose names the operators use themselves."""
    df = spark.createDataFrame(odd_rows(), SHAPE)
    extra = "row key node size words line lines label rank copies component score kept tid did rid language position h1 count".split()
    return df.withColumns({n: F.lit("extra") for n in extra}).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SHAPE)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def folder(spark, tmp_path_factory):
    """Writes tables to a folder as a query reads them."""

    def write(**frames):
        path = str(tmp_path_factory.mktemp("tables"))
        for name, df in frames.items():
            df.write.parquet(f"{path}/{name}.parquet")
        return path

    return write
