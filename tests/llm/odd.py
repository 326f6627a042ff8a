"""Documents with everything that tables may hold, and columns whose names operators might use themselves."""

from __future__ import annotations

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, id long, body string, key string, row long, "
    "found string, fp long, digest string, word string, range long, size long, score double, ids binary, "
    "component string, node long, weight double, rank long, words long, position double, toxic int, host string, "
    "`__key` long, `__copy` int, `__score` double, `__turn` string, `a.b` string, at string, turn int, copy int, texts long"
)
LONG = "Long words make long texts , été \U0001f600 and stops.\n" * 4000

ROWS = [
    (1, None, None, None), (2, "", "en", "b"), (3, " \n\t ", "en", "b"), (4, "one", "en", "b"), (4, "one", "en", "b"),
    (5, LONG, "en", "a"), (6, LONG, "de", None), (None, "a text without id", None, "a"), (7, "one", "fr", ""),
    (8, "You IDIOT, you moron", "en", "a"), (9, "x" * 5000, "en", "a"), (10, "one", None, "c"),
    (11, "a text with an id", "en", "c"), (11, "another text with this id", "en", "c"),
    (2**63 - 10, "the largest id", "en", "c"), (-(2**63) + 5, "the smallest id", "en", "c"), (2**62 + 5, "the largest id", "en", "c"),
]


def odd(spark, rows=ROWS):
    filled = [(*r, 5, 6, "b", "k", 7, "f", 8, "d", "w", 9, 10, 0.5, b"i", "c", 11, 0.25, 12, 13, 0.75, 1, "h",
               14, 15, 0.125, "t", "dotted", "at", 16, 17, 18) for r in rows]
    return spark.createDataFrame(filled, SCHEMA).repartition(3)


#: What `odd` puts into the columns that aren't read.
REST = {"__key": 14, "__copy": 15, "__score": 0.125, "__turn": "t", "a.b": "dotted", "row": 7, "at": "at", "turn": 16, "copy": 17}
