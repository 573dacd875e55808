"""Rows that every operator must take: nulls, blanks, a very long text, ties, repeated rows, clashing names."""

from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977} and" for i in range(30_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog today.", "en", "a", 50),
    (1, "The quick brown fox jumps over the lazy dog today.", "en", "a", 50),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, " \n\t ", "de", "b", 4),
    (5, "été", "fr", None, 3),
    (6, LONG, "en", "b", len(LONG)),
    (None, "Some words without an id stand here for all to read.", "en", "c", 51),
    (7, "1234 5678 !!!", None, "c", 13),
    (8, "日本語 のテキスト 😀 emoji", "ja", "d", 20),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = "size nth target taken offset slot rank blocks order lang_pred score _found key path text_key pos term bucket star cell n component rep held_out block window doc_key item_id shift row".split()


def documents(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def clashing(frame):
    """The frame with columns whose names operators use within."""
    return frame.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING if c not in frame.columns])


def none_of(spark):
    return spark.createDataFrame([], SCHEMA)
