"""Small tables with the rows that are easily forgotten."""

import random

# Columns whose names the operators use inside.
CLASHING = "h1 int, shingle string, label int, block string, part int, n int, rank int, seed int, size int, text_crc32 int"


def documents(spark, rows, extra=True):
    """(doc_id, text) rows as a table with clashing extra columns."""
    schema = "doc_id long, text string" + (f", {CLASHING}" if extra else "")
    more = (1, "x", 2, "y", 3, 4, 5, 6, 7, 8) if extra else ()
    return spark.createDataFrame([(*r, *more) for r in rows], schema)


def prose(seed, words, vocabulary=400):
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(words))


def odd_documents(spark):
    """Nulls, empty and blank texts, a long text, ties and repeated rows."""
    long = prose(1, 60_000)
    return documents(spark, [
        (None, "some text here without an id"), (None, None), (1, None), (2, ""), (3, " \n\t "), (4, "one"),
        (5, prose(2, 80)), (5, prose(2, 80)), (6, prose(2, 80)), (7, long), (8, long), (9, "%%% $$$ 123"),
    ])


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
