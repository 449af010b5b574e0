import random

import pytest

#: Columns that operators use inside, as extra columns of the input.
CLASHES = {
    c: c
    for c in "key size shard slot n h fp tile node root copies target passes threshold kept score left spans t1 t2 k1 k2 vec next_text piece length rank pieces places text_hash source_size n_words bucket".split()
}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(n))


def hard_rows():
    """Nulls, empty and blank texts, repeated rows, ties, a long text, copies, shared passages."""
    rng = random.Random(5)
    passage, line = sentence(rng, 60), sentence(rng, 25)
    rows = [(i, sentence(rng, rng.randint(1, 150)), "en", f"s{i % 5}", 1) for i in range(40)]
    rows += [(100 + i, f"{sentence(rng, 30)} {passage} {sentence(rng, 30)}", "en", "hot", 1) for i in range(12)]
    rows += [(200 + i, rows[3][1], "en", "hot", 1) for i in range(6)]  # copies
    rows += [(300, "La " * 300, "fr", "s1", 1), (301, "ab cd " * 90, "fr", "s1", 1), (302, "\n".join([line] * 9), "fr", None, 1)]
    rows += [(303, "Ünïcödé ñandú. Straße größer\nzweite Zeile! " * 12, "de", None, 1), (304, "a b c \x1c d\x0be\x85f", "xx", "s2", 1)]
    rows += [(400, None, None, None, None), (401, "", "en", "s1", 0), (402, " \t\n ", "en", "s1", 4), (403, "one", "en", "z", 3), (404, "x y", "en", "z", 3)]
    rows += [(500, sentence(rng, 20_000), "en", "long", 1)]
    rows += [rows[5], rows[5], (None, "no id " + sentence(rng, 50), "en", "s1", 1), (None, None, "en", "s1", 1), (7, "another text under an id that is taken", "en", "s2", 1)]
    rows += [(600, rows[8][1].upper(), "en", "s3", 1), (601, rows[8][1] + " tail", "en", "s3", 1)]
    return rows


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    from demandlake.llm.scratch import importable

    return importable(spark)


@pytest.fixture(scope="session")
def rows():
    return hard_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    from pyspark.sql import functions as F

    plain = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return plain.withColumns({c: F.lit(v) for c, v in CLASHES.items()})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
