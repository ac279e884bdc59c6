"""Awkward rows that every operator has to take."""

from __future__ import annotations

LONG = "word " * 30_000 + "end"
CLASH = "id string, uid string, t string, h string, fp string, s string, n string, block string, carried string, i string"
DOCS = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASH}"


def rows(texts: list[tuple]) -> list[tuple]:
    """(doc_id, text) or (doc_id, text, lang) with the other columns filled with values that must not matter."""
    return [(t[0], t[1], t[2] if len(t) > 2 else "en", None, 0, *["x"] * 10) for t in texts]


def docs(spark, texts: list[tuple], partitions: int = 3):
    return spark.createDataFrame(rows(texts), DOCS).repartition(partitions)


AWKWARD = [
    (1, None), (2, ""), (3, "  \n\t \r\n"), (4, LONG), (5, LONG), (6, "One two THREE four five six seven eight nine ten eleven."),
    (6, "One two THREE four five six seven eight nine ten eleven."), (7, "one two three four five six seven eight nine ten eleven."),
    (None, "no id at all"), (8, "Ärger über Öl und\x1cmehr \U0001f600 é"), (9, "a"), (10, "!!! ??? ---"), (11, "\x00\x01 <|endoftext|> x"),
]
