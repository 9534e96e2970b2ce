"""Small tables with the awkward cases every operator must stand."""

import random

LONG = " ".join(f"word{i % 977} the{i % 31}" for i in range(30_000))
DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
              # names that operators use for their own columns
              "score double, predicted int, node long, `key` long, length long, host string, _text string, _key long, size long")
VOCAB = ("the of and to in ation ther hat ing ed or an re on at en nd ti es her erst wind stone river cloud "
         "light table under over night").split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(VOCAB) for _ in range(r.randint(1, 3))) for _ in range(n))


def docs_of(spark, rows):
    """rows: (doc_id, text[, lang[, source]])."""
    full = [(*r, *[None] * (4 - len(r)), None if r[1] is None else len(r[1]), 0.5, 1, 7, 7, 7, "h", "t", 7, 7) for r in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


def awkward():
    """Null id, text, language and source; empty, blank and long texts; repeated rows and ids."""
    a = prose(1, 60)
    return [(1, a, "en", "s"), (2, a, "en", "s"), (2, a, "en", "s"), (3, None, "en", "s"), (4, "", None, None), (5, " \t\n", "de", "t"),
            (None, a + " x", "de", "t"), (None, None, None, None), (6, LONG, "de", "t"), (7, LONG + " end", "fr", "u"),
            (8, "12 34 !?", "fr", "u"), (9, prose(2, 60), "fr", "u"), (9, prose(3, 60), "en", None), (10, "Ünï日本𝄞 <|endoftext|> \x1c x", "en", "s")]
