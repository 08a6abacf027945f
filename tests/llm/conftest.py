import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def shared(spark, tmp_path_factory):
    """Intermediate tables of the tests; a cluster names its own folder."""
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))


@pytest.fixture()
def docs(spark, shared):
    """Makes documents from (id, text) or (id, text, source)."""

    def make(*rows, **more):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", None if r[1] is None else len(r[1])) for r in rows]
        out = spark.createDataFrame(full, DOCS)
        return out.withColumns({name: F.lit(value) for name, value in more.items()})

    return make


@pytest.fixture(scope="session")
def sample(spark, shared):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
