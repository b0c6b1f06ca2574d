"""Small corpora with the awkward rows that every operator must take."""
import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "river stone cloud amber winter signal harbour meadow copper lantern thistle granite whistle ember orchard velvet".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing", "ly", str(rng.randrange(99))]) for _ in range(n))


def edited(rng: random.Random, text: str, share: float) -> str:
    w = text.split(" ")
    for k in rng.sample(range(len(w)), int(len(w) * share)):
        w[k] = "changed" + str(rng.randrange(1000))
    return " ".join(w)


def awkward(rng: random.Random) -> list[tuple]:
    """Null in any column, empty and wordless texts, one very long text, repeated rows."""
    long = prose(rng, 30_000)
    rows = [
        (900, None, "en", "s1", 0), (901, "", "en", "s1", 0), (902, "", None, None, None), (903, "!!! ???", "en", "s1", 7), (904, "\n\n", "en", "", 2),
        (905, long, "en", "s1", len(long)), (None, prose(rng, 40), "en", "s1", 1), (None, None, None, None, None),
        (906, "one", "en", "s1", 3), (906, "one", "en", "s1", 3), (907, "ONE", "en", "s2", 3), (908, "ünï çødé " * 3, "fr", "s2", 1),
    ]
    return rows


def corpus(rng: random.Random, n: int = 60) -> list[tuple]:
    rows = []
    for i in range(n):
        text = "\n".join(prose(rng, rng.randrange(3, 60)) for _ in range(rng.randrange(1, 5)))
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
    for k in range(12):  # exact and near copies
        text = rows[k % 4][1]
        rows.append((100 + k, text if k % 2 else edited(rng, text, 0.03), "en", "s0", len(text)))
    return rows + awkward(rng)


def frame(spark, rows, parts: int = 3):
    return spark.createDataFrame(rows, DOCS).repartition(parts)


def clashing(df, *names):
    """The frame with extra columns named like an operator's own."""
    from pyspark.sql import functions as F

    for c in names:
        df = df.withColumn(c, F.lit("clash"))
    return df
