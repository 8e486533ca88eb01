import random

import pytest
from pyspark.sql import functions as F

WORDS = "the of and was with ance tion ment ough ster lor nedi kalo perum stad wick fenn gral tovi mesk".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def docs(spark):
    """Texts of every awkward kind: null, empty, blank, short, copies, near copies, shared passages, very long."""
    long, passage = prose(1, 300), prose(2, 60)
    words = long.split()
    words[150] = "altered"
    rows = [
        (1, long), (2, long), (3, " ".join(words)), (4, prose(3, 50) + " " + passage + " " + prose(4, 50)),
        (5, passage), (6, None), (7, ""), (8, " \t\n"), (9, "One"), (10, "one two"), (11, "ONE TWO"),
        (12, prose(5, 30_000)), (13, "12345 678 !!"), (14, prose(6, 80) + " " + passage), (15, "ÄÖ été ñandú 中文 😀 " + prose(7, 20)),
        (16, "x" * 500), (17, "mail a.b@c.example.org or +1 (555) 010-2222, ip 10.0.0.256 and 10.0.0.25, card 4111 1111 1111 1111"),
        (18, "a b <|endoftext|> c"),
    ]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    # Columns whose names the operators use inside.
    return df.withColumns({"_key": F.lit("k"), "_text": F.lit("t"), "fp": F.lit(1), "id": F.lit(0), "size": F.lit(0)})


@pytest.fixture(scope="session")
def awkward(docs):
    """The same with null and repeated keys and a null language."""
    more = docs.where("doc_id in (1, 9)").withColumn("doc_id", F.lit(None).cast("bigint"))
    return docs.unionByName(docs.where("doc_id in (2, 6, 10)")).unionByName(more).unionByName(
        docs.where("doc_id = 15").withColumn("lang", F.lit(None).cast("string")).withColumn("doc_id", F.lit(19).cast("bigint"))
    )


@pytest.fixture
def texts():
    return lambda df: {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}
