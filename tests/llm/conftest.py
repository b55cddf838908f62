import pytest


@pytest.fixture
def from_files(spark, tmp_path):
    """Rows as a table read from several parquet files."""

    def written(rows, schema, files=3):
        path = str(tmp_path / f"t{len(list(tmp_path.iterdir()))}")
        spark.createDataFrame(rows, schema).repartition(files).write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    return written
