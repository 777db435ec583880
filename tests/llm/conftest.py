import random

import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    *[T.StructField(n, T.StringType()) for n in ("score", "fp", "component_id", "_k1", "_n", "id", "digest", "c0", "f0", "kept", "tokens", "pass", "block")]])


def rows(n_long=6000):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, base = say(45), say(120)
    texts = [None, "", " \n\t ", "###", "one", "One two", "one  two", base, base, base.replace(" ", "\n"), base + " end",
             say(30) + " " + passage + " " + say(30), passage, say(10) + " " + passage, passage + " " + passage, say(25),
             " ".join(["same"] * 50), "a b c d e f g h\n" * 6, "x@y.zz mail, call +1 (212) 555-0199 or 10.0.0.1 card 4111 1111 1111 1111 end",
             "1.2.3.4.5.6.7.8 999.1.1.1 a@b@c.d +12 4111111111111112 0000000000000000", "9" * 3000, "a@" * 500, "é" * 300 + " İ. ß 中文 🙂   x",
             say(n_long), "<|endoftext|> and <|ENDOFTEXT|>.", "word joined\x1cby other\x85blanks " + say(22), "tab\tand\x0bfeed\x0c " + say(21)]
    made = [(i * 7, t, ["en", "de", None][i % 3], ["web", "books", None][i % 3], None if i % 5 == 0 else len(t or "")) for i, t in enumerate(texts)]
    made += [made[7], made[7], (None, base, None, None, None), (None, None, "en", "web", 0), (3, say(40), "fr", "web", 0), (3, say(41), "es", "web", 0), (3, passage, "fr", "one", 0)]
    return [(*r, *["x"] * (len(SCHEMA) - 5)) for r in made]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows and ids, clashing extra columns."""
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()
