"""Small tables with what real ones hold: NULLs, empty and long texts, repeated rows, clashing names."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, score string, row string, id string, label int"


def docs(spark, rows, schema: str = DOCS, parts: int = 3):
    """(doc_id, text) rows with further columns whose names the operators use inside."""
    width = len(schema.split(", ")) - 2
    return spark.createDataFrame([(*r, *["x"] * (width - 1), 7) if width else r for r in rows], schema).repartition(parts)


def stored(spark, df):
    from rollcall.session import fresh_dir

    path = fresh_dir(spark, "given")
    df.write.parquet(path)
    return spark.read.parquet(path)


def prose(seed: int, words: int, vocabulary: int = 60) -> str:
    chosen = random.Random(seed)
    return " ".join(chosen.choice(("w", "W", "é", "x-")) + str(chosen.randrange(vocabulary)) for _ in range(words))


def awkward() -> list[tuple[int | None, str | None]]:
    long = prose(7, 3_000)
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, prose(1, 80)), (5, prose(1, 80)), (6, prose(1, 78) + " other end"),
        (7, long), (8, "one"), (9, "same " * 400), (9, "same " * 400), (None, prose(1, 80)), (None, None),
        (12, prose(2, 50) + "\n" + prose(3, 40)), (13, prose(4, 20) + "  " + prose(3, 40)), (14, "ONE"), (-5, prose(3, 40)),
    ]
