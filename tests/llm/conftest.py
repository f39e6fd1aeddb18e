import pytest

from rowgate.llm.frames import ship

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def package_on_executors(spark):
    ship(spark)


@pytest.fixture
def docs(spark):
    """(doc_id, text) or longer tuples as documents."""

    def build(rows, extra=""):
        full = [(*row, "en", "s", len(row[1] or ""))[:5] if len(row) < 5 else row for row in rows]
        return spark.createDataFrame(full, DOCS + extra)

    return build


@pytest.fixture
def stored(spark, tmp_path):
    """Frames as the tables of a folder."""

    def store(**frames):
        for name, frame in frames.items():
            frame.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return store
