import pytest


@pytest.fixture
def docs(spark):
    def make(rows, parts=3):
        """``(doc_id, text)`` rows, or longer ones with an ``extra`` column."""
        wide = [(*row, None) if len(row) == 2 else row for row in rows]
        return spark.createDataFrame(wide, "doc_id BIGINT, text STRING, row STRING").repartition(parts)

    return make


@pytest.fixture
def on(monkeypatch):
    """Runs a query of a module on frames instead of files."""

    def run(module, spark, **frames):
        monkeypatch.setattr(module, "table", lambda s, d, name: frames[name])
        return module.query(spark, "")

    return run


def in_batches(spark, rows):
    """Small Arrow batches, so that a partition has several."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


@pytest.fixture
def small_batches(spark):
    in_batches(spark, 3)
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
