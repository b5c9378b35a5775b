import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use inside or return
        *(T.StructField(name, T.StringType()) for name in ("_id", "_text", "_key", "node", "keep", "component_id", "count")),
    ]
)

ENGLISH = "the house of a man was near that old river and it is said by all who were there on the day".split()
GERMAN = "das haus und der mann sind nicht auf dem weg zu einem alten fluss der von hier ist mit den kindern".split()


def prose(seed, n, words=ENGLISH):
    """Sentences of mostly distinct words."""
    rnd = random.Random(seed)
    out = []
    for k in range(n):
        word = rnd.choice(words) if rnd.random() < 0.4 else "".join(rnd.choice("bdfglmnprst") + rnd.choice("aeiou") for _ in range(rnd.randint(1, 4)))
        out.append(word + "." if k % 11 == 10 else word)
    return " ".join(out) + "."


def odd_rows():
    """Nulls, empty and very long texts, ties, copies and repeated rows."""
    long_text = prose(1, 30_000)
    copy = prose(2, 120)
    near = copy.split()
    near[60] = "changed"
    texts = [
        (1, None), (2, ""), (3, "   \n\t "), (4, "!!! 123 ???"), (5, long_text), (6, copy), (7, copy), (7, copy),
        (8, " ".join(near)), (9, "one two"), (10, "One  TWO"), (11, prose(3, 200, GERMAN)), (None, prose(4, 50)), (None, None),
        (12, "x" * 5000), (13, "İΣ 漢字 \u0301a <|endoftext|> b\x00c \x1c\x85 1²"), (14, "a\n\n\nb  c\t d"), (15, prose(5, 90) + "\n" + prose(6, 90)),
        (16, "buy " * 300), (17, "word\n" * 40),
    ]
    return [(i, t, None if k % 5 == 0 else "de" if i == 11 else "en", None if k % 4 == 0 else "src0", None, "x", "y", None, "3", "no", "9", "c") for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def frame(spark, rows):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, lang)``."""
    return spark.createDataFrame([(*r, None)[:3] for r in rows], "doc_id long, text string, lang string")
