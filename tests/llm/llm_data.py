"""Small tables that every operator must take: nulls, empty and long texts, repeats, extra columns."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, score double, component_id int"
LONG = "lorem ipsum dolor " * 4000 + "=" * 5000


def odd_docs(spark):
    rows = [
        (1, "The cat sat on the mat and looked at the dog", "en", "a"), (2, None, None, None), (3, "", "en", "a"),
        (4, " \n\t ", "de", "b"), (5, LONG, "en", "a"), (5, LONG, "en", "a"), (None, "no id here at all", "en", None),
        (7, "The cat sat on the mat and looked at the dog", "en", "a"), (8, "1234 5678 !!", "en", "b"),
        (9, "Ünï çôdé 中文 🙂 text\x1c\x1dwith signs", None, "b"), (5, "same id, other text", "fr", "b"),
    ]
    return spark.createDataFrame([(*r, 7, "x", 1.5, 3) for r in rows], DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)
