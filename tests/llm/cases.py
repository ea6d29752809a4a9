"""Small document tables with every odd case: nulls, empty and long texts, repeated rows, clashing columns."""

import random

from pyspark.sql import types as T

# Columns whose names the operators use themselves.
CLASHING = ("row", "score", "text_key", "fingerprint", "leaks", "n_words", "ids", "shard", "mentions", "words", "at")
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()),
        *(T.StructField(name, T.StringType()) for name in CLASHING),
    ]
)


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "é", "Tu") for b in ("ra", "se", "no") for c in ("", "n", "ß")]
    words = [rng.choice(vocabulary) + (rng.choice([".", ",", "\n", ""]) if rng.random() < 0.2 else "") for _ in range(n)]
    return " ".join(words)


def odd_rows(extra: list[tuple[int | None, str | None, str | None]] = ()) -> list[tuple]:
    """(doc_id, text, source) rows, the extra ones first."""
    long = prose(7, 30_000)
    rows = [
        *extra,
        (100, prose(1, 80), "a"),
        (101, prose(1, 80), "a"),  # a copy
        (102, prose(2, 300), "b"),
        (102, prose(2, 300), "b"),  # a repeated row
        (103, None, "a"),
        (104, "", None),
        (105, " \t\n\r\x0b\x0c ", "b"),
        (106, long, "a"),
        (107, long + " end", "b"),
        (None, prose(3, 70), "a"),
        (None, None, None),
        (108, "one", "a"),
        (109, "日本語 テキスト 中文 \x00 \U0001f600 á    x", "b"),
        (110, "\n\n\n", "a"),
        (111, "same same same same same same", "a"),
    ]
    return rows


def table(spark, rows, n: int = 3):
    clash = tuple(f"own {name}" for name in CLASHING)
    return spark.createDataFrame([(*row, *clash) for row in rows], SCHEMA).repartition(n)
