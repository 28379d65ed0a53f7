import random
import zlib

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept boolean, size long, "
          "key string, row string, n string, digest string, shared string, root string, place string, label int")


def remainder(doc_id, m):
    return -1 if doc_id is None else zlib.crc32(str(doc_id).encode()) % m


def sentence(seed, n, words=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(words)}" for _ in range(n))


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), True, 3, "k", "r", "n", "d", "s", "t",
            "p", 1)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank, short and very long texts, exact
    and near copies, rows told twice, ids told twice, and clashing names."""
    base = sentence(1, 120)
    near = base.split()
    near[60] = "changed"
    long = sentence(2, 30_000, 5000)
    return [
        row(1, base), row(2, base), row(2, base), row(3, " ".join(near), "fr", "b"), row(4, base.upper(), None, None),
        row(5, None), row(6, ""), row(7, " \t\n\x0b\r\x0c "), row(8, "one two"), row(9, "One  TWO\n"), row(10, long),
        row(11, long + " end"), row(None, sentence(3, 80), None, None), row(None, None, None, None),
        row(12, "a\n\nb\n\na\n"), row(12, sentence(4, 60), "de", "c"), row(13, "é ß 漢字 \U0001F600 \xa0x", "de", "c"),
        row(14, "!!! 123 %%%", "de", "c"), row(15, (sentence(5, 12) + "\n") * 12), row(16, sentence(6, 55) + "\n" + base),
        (17, sentence(7, 70)) + (None,) * 13]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (1, 0, 0), (3, 1, None), (8, 0, 1), (15, 0, 0), (16, 1, 0), (17, None, 0), (99, 1, 0),
         (None, 1, 1)], "doc_id long, quality int, toxic int")
