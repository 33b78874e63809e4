"""Small tables with every odd case: nulls, empty, very long, repeated and tied rows, clashing extra columns."""

import re

from pyspark.sql import functions as F

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    state, out = seed * 7919 + 17, []
    for _ in range(n):
        state = (state * 48271) % 2147483647
        out.append(WORDS[state % len(WORDS)] + str(state % 97 if state % 3 == 0 else ""))
    return " ".join(out)


def rows():
    base = prose(1, 60)
    texts = [
        (1, base),
        (2, base),  # a copy
        (3, base.replace("alpha", "alphaX", 1) + " end"),  # a near copy
        (4, None),
        (5, ""),
        (6, " \n\t\x0b\x0c\r "),
        (7, "one two"),
        (8, "Ünïcödé 日本語 text with spaces İstanbul ſ K \U0001f600 tail"),
        (9, prose(2, 40000)),  # very long
        (10, "x" * 300000),  # one very long word
        (11, prose(3, 80) + "\n" + prose(3, 80)),
        (11, prose(3, 80) + "\n" + prose(3, 80)),  # a repeated row
        (12, prose(4, 50)),
        (12, base),  # an id with two texts, one of them a copy
        (None, base),
        (None, None),
        (-5, prose(5, 70)),
        (13, "line one here now\nline one here now\n\n\nline two\nline one here now"),
        (14, prose(2, 40000)[:200000] + " changed"),
    ]
    out = []
    for k, (i, t) in enumerate(texts):
        out.append((i, t, None if k % 5 == 3 else ["en", "de"][k % 2], None if k % 7 == 2 else f"s{k % 2}", None if t is None else len(t)))
    return out


#: Names that the operators use inside.
CLASHES = "score predicted segment term slots doc row kept bands rep component node a b low high block x g model spans __text spare __kept_id __rows __bad_text __row __term".split()


def odd_documents(spark, extra: bool = True):
    df = spark.createDataFrame(rows(), SCHEMA)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHES}) if extra else df


def documents(spark, texts, first: int = 1):
    return spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts, first)], SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def lower_ascii(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
