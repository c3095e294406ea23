"""Small tables with everything that may go wrong, for the tests of the operators."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns of names that the operators use themselves.
CLASHING = DOCUMENTS + ", size string, key string, n_words string, spans string, ids string, component_id string, copies string, draw string"

PROSE = (
    "the quick brown fox jumps over the lazy dog while seven wizards quietly mix boxing potions near an old harbour "
    "and nobody in the village ever asks what the loud bells announce before the market opens on rainy mornings"
).split()


def prose(start, count):
    """``count`` words, which repeat after a long while only."""
    return " ".join(f"{PROSE[(start + i) % len(PROSE)]}{(start + i) // len(PROSE)}" for i in range(count))


def awkward_rows():
    """Nulls in any column, empty and odd texts, repeated rows and ids, a very long text."""
    long = prose(1000, 30_000)
    texts = [
        None, "", " \n\t ", "one", "one two three", prose(0, 80), prose(0, 80), prose(0, 81), prose(0, 79) + " changed",
        prose(500, 60) + " " + prose(20, 55), "Été à Łódź \U0001f600 " + prose(40, 52), "#$%&* | <> !!", "0123456789" * 10,
        long, "mail a.b@c.example.com or +1 (212) 555-0143, 10.1.2.3", "x" * 5000, prose(500, 60), "a\x1cb c d",
    ]
    rows = [(i, t, ["en", "fr", None][i % 3], [None, "s1", "s2", "s1"][i % 4], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], (None, prose(0, 80), "en", "s1", 1), (None, None, None, None, None), (7, prose(900, 70), None, "s2", None)]
    return rows


def documents(spark, rows=None):
    return spark.createDataFrame(awkward_rows() if rows is None else rows, DOCUMENTS)


def clashing(spark):
    return spark.createDataFrame([(*row, *["?"] * 8) for row in awkward_rows()], CLASHING)


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def rows_of(df):
    """All rows in an order that does not depend on the run."""
    return sorted((tuple(map(repr, r)) for r in df.collect()))


def words(text):
    return WORD.findall(text or "")
