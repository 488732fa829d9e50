import pytest
from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, "one two three four five six seven eight nine ten eleven. " * 2 + "Mail jo@ex-a.org now."),
    (1, "one two three four five six seven eight nine ten eleven. " * 2 + "Mail jo@ex-a.org now."),
    (2, None), (3, ""), (4, " \n\t "), (None, "a text without an id, call +1 (017) 555-7713 today."),
    (None, None), (5, "x" * 60_000), (6, "word " * 30_000), (7, "1" * 30_000 + "@" * 3000),
    (8, "Ünï cödé   \x1c 😀 <|endoftext|> $$$ ||| ###\n\n" * 3), (9, "+1 " + " " * 20_000 + "2"),
]


@pytest.fixture(scope="session")
def documents(spark):
    """Make a documents table, with columns whose names the operators use themselves."""

    def make(rows):
        frame = spark.createDataFrame(
            [(i, t, None, None, None if t is None else len(t)) for i, t in rows], DOCUMENTS
        )
        for name in ("row", "kept", "shard", "band", "rep", "link", "members", "length", "hit", "spans"):
            frame = frame.withColumn(name, F.lit("taken"))
        return frame

    return make


@pytest.fixture(scope="session")
def odd(documents):
    return documents(ODD)


@pytest.fixture(scope="session")
def none(documents, spark):
    return documents([(0, "gone")]).where("doc_id > 0")


def rows_of(frame, *names):
    return sorted((tuple(r) for r in frame.select(*names).collect()), key=repr)
