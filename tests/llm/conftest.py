from __future__ import annotations

import random

import pytest

WORDS = "river stone apple winter garden music paper window silver forest cloud market table letter summer candle bridge shadow corner island".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + (f"{rng.randrange(50)}" if rng.random() < 0.4 else "") for _ in range(n))


@pytest.fixture(scope="session")
def rows() -> list[tuple]:
    """Documents with nulls, empty and long texts, ties, repeated rows and shared lines."""
    shared = "\tRead MORE here \r"
    made = [(i, "\n".join([prose(i, 40), shared if i % 2 else prose(1000 + i, 5), prose(500 + i, 30)])) for i in range(40)]
    made += [(100 + i, prose(7, 60)) for i in range(12)]  # exact copies
    made += [(120 + i, prose(8, 300) + (f" tail{i}" if i else "")) for i in range(6)]  # near copies
    made += [(200, None), (201, ""), (202, " \t\n\x0b\x0c\r "), (203, "\n\n\n"), (None, "no id here at all"), (None, None)]
    made += [(205, "Ünï ÉCOLE École école"), (206, "naïve 中文 字 text  double  space "), (207, "| | ### $$$ <b> && !!")]
    made += [(208, prose(9, 20_000)), (209, "a b a b a b a b"), (209, "a b a b a b a b"), (210, "a b c d"), (211, "a b a b")]
    made += [(212, "odd\x1cspace and breaks \x85 end"), (213, "don't I'll <|endoftext|> 's 12 345")]
    return made


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with more columns, some of which have names that operators use inside or differ in case only."""
    wide = [(i, t, "en", "src", None if t is None else len(t), 1, "x", 2.0) for i, t in rows]
    return spark.createDataFrame(wide, "doc_id long, text string, lang string, source string, n_chars long, n_words int, TEXT2 string, _k double").withColumnRenamed("TEXT2", "fp")


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
