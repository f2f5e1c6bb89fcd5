"""Documents with everything that may be odd about a table."""

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "score double, kept string, ids string, n_tokens int, size int, fp string, labels string, n_words string, doc string"
)
LONG = "Lorem ipsum dolor sit amet. " * 8000


def row(doc_id, text, lang="en", source="s1"):
    return (doc_id, text, lang, source, len(text or ""), 9.0, "mine", "x", 7, 8, "y", "z", "w", "d")


ROWS = [
    row(1, None), row(2, ""), row(3, " \n\t "), row(4, LONG), row(5, "one two three"), row(5, "one two three"),
    row(5, "another text under the same id"), row(None, "no id at all"), row(None, "no id at all"), row(6, "one two three"),
    row(7, "Ünïcödé 漢字かな кириллица 😀   x", None, None), row(8, LONG, "de", ""), row(9, "a", None, "s2"),
    row(10, "\x00\x1c\x85 odd", "en", None),
]


def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def none(spark):
    return spark.createDataFrame([], SCHEMA)
