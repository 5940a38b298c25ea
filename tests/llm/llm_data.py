"""Small inputs shared by the tests of the training-data operators."""
import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def words(rng, n, size=400):
    return " ".join("".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(2 + rng.randrange(size) % 9))
                    for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and very long texts, repeated rows and ids, ties."""
    rng = random.Random(7)
    long = words(rng, 20_000)
    same = words(rng, 80)
    rows = [(1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \n\t ", None, "a", 4), (4, long, "en", None, 5),
            (5, same, "en", "a", 1), (5, same, "en", "a", 1), (5, words(rng, 60), "en", "b", 2), (None, same, "de", "a", 3),
            (None, None, None, None, None), (6, "one two", "en", "a", 7), (7, "é ß 漢 \U0001f600 " * 40, "fr", "b", 9),
            (8, same + " more", "en", "a", 1), (9, long, "en", "c", 5)]
    return [(i, t, lang, s, len(t) if n and t else n) for i, t, lang, s, n in rows]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
