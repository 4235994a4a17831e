"""Documents with every awkward case, for the tests of all corpus operators."""

import random
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
#: Extra columns whose names operators use themselves.
EXTRA = "lang string, source string, n_chars long, key long, size long, target double, row long, n_words long, kept boolean, h long, ids string"
SCHEMA = f"doc_id long, text string, {EXTRA}"


def words_of(text):
    return SPACED.findall((text or "").translate(LOWER))


def prose(seed, n, vocabulary=4000):
    rng = random.Random(seed)
    return " ".join(f"w{int(vocabulary * rng.random() ** 2)}" for _ in range(n))


def texts():
    base, passage = prose(1, 300), prose(2, 80)
    changed = base.split()
    changed[50] = changed[200] = "other"
    return [
        (1, base),
        (2, base),  # an exact copy
        (3, " ".join(changed)),  # a near copy
        (3, " ".join(changed)),  # the same row again
        (4, prose(3, 150) + "\n" + passage + "\n" + prose(4, 120)),
        (5, passage + " " + prose(5, 200)),
        (6, None),
        (7, ""),
        (8, " \n\t "),
        (None, prose(6, 90)),
        (None, prose(6, 90)),
        (None, None),
        (9, "One"),
        (10, "Ärger über 漢字  two  spaces \x1c   end\r\n"),
        (11, prose(7, 30_000)),  # very long
        (12, "same line here\n" * 40),
        (13, "#$% " * 60 + "x" * 5000),
        (14, prose(8, 25)),
        (14, prose(9, 25)),  # another text under the same id
    ]


def frame(spark, rows=None):
    rows = texts() if rows is None else rows
    sources = ["b", "a", None, "c"]
    extra = lambda i: ("en", sources[i % 4], i, 7, -1, 0.5, 3, 99, False, 5, "old")
    return spark.createDataFrame([(*row, *extra(i)) for i, row in enumerate(rows)], SCHEMA)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=repr)
