"""Small frames with awkward rows."""

import random

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark: SparkSession, texts, start: int = 0, extra: bool = False) -> DataFrame:
    """``texts``: strings, or (id, string).  ``extra`` adds columns with names that operators use inside."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts, start)]
    rows = [(i, t, "en", f"s{(i or 0) % 3}", len(t or "")) for i, t in rows]
    if not extra:
        return spark.createDataFrame(rows, DOCS)
    more = ("row_no long, recipe string, raw_hash string, keep_id string, n string, digest long, sig string, rate string, "
            "copies string, n_tokens string, p string, score string, features string, label string, words string, "
            "bad_id string, node string, kept string, bins string, row string")
    return spark.createDataFrame([(*r, 5, *["x"] * 4, 7, *["y"] * 14) for r in rows], f"{DOCS}, {more}")


AWKWARD = [None, "", " \t\n", "a", "é", "x" * 30_000, "word " * 6_000, "a\x00b", "tab\tnew\nline", "tab new line", " ", "😀 😀"]


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))
