"""Small tables with the awkward rows that every operator must take."""

import random

WORDS = "the of and to tion ble est ing ly er on re th in ou ha nd en at".split()


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(WORDS) for _ in range(draw.randint(1, 3))) for _ in range(n))


def documents(spark, rows, extra: bool = True):
    """rows: (doc_id, text). Further columns carry names that operators use inside."""
    full = [(k, text, "en", "src0", len(text or ""), 1, "x", "y") for k, text in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, shard int, base string, rank string"
    df = spark.createDataFrame(full, schema)
    return df if extra else df.select("doc_id", "text", "lang", "source", "n_chars")


def awkward():
    """Nulls, empty and white texts, repeated rows and ids, ties, a long text, unusual characters."""
    long = prose(9, 6000)
    return [(5, prose(1, 80)), (5, prose(1, 80)), (6, prose(1, 80)), (7, None), (None, prose(2, 70)), (8, ""), (9, " \n\t "),
            (10, long), (11, "Ünïcödé ２ a b　c  d\x1ce\n\n!.. don't \U0001f600. <|endoftext|> ok."), (12, "one two"), (13, "one two"), (14, "x" * 5000)]
