import pytest

ODD = "doc_id long, text string, lang string, source string, n_chars long, score double, shard int, epoch string, digest string, r long"


def odd_rows():
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids, and columns named like the operators' own."""
    words = " ".join(f"w{i % 977}x{i}" for i in range(40_000))
    near = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty " * 3
    tail = ("en", "src1", 3, 0.5, 9, "e", "d", 7)
    none = (None,) * 8
    return [
        (1, None, *tail),
        (2, "", *none),
        (3, " \n\t ", *tail),
        (4, words, *tail),
        (5, words, *none),
        (6, near + "end", *tail),
        (7, near + "stop", *tail),
        (7, near + "stop", *tail),
        (None, near + "end", *tail),
        (None, None, *none),
        (8, "a", *tail),
        (8, "b é ü", *tail),
        (9, "x" * 300_000, *tail),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], ODD)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
