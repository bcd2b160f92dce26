"""Documents with every oddity the operators must bear, and small prose."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
    + [
        T.StructField(name, T.StringType())  # names that the operators use inside
        for name in (
            "copy shuffle_key bits label root doc own_id own_key key words score tails grade digest size shard slot "
            "bucket bucket_in end segment first place tail mix_row mix_cdf source_ item_id host page"
        ).split()
    ]
)
WORDS = [a + b for a in "ba de fi go ku la me no pi ru".split() for b in "st nd l r s mm t x".split()]


def prose(seed: int, n: int) -> str:
    pick = random.Random(seed)
    common = "the of and is to in a that".split()
    return " ".join(pick.choice(common) if pick.random() < 0.3 else pick.choice(WORDS) for _ in range(n))


def rows():
    """(doc_id, text, lang, source): nulls, empties, repeated rows, equal texts, one word, white space, very long texts."""
    out = [(i, prose(i, 60 + i), "en", "a" if i % 3 else "b") for i in range(40)]
    out += [(100, None, None, None), (101, "", "en", "a"), (102, " \t\n ", "xx", "a"), (103, "word", "en", None)]
    out += [(104, prose(1, 60 + 1), "en", "c"), (105, prose(1, 60 + 1), "en", "c")]  # copies of 1
    out += [(106, prose(6, 20_000), "en", "a"), (106, prose(6, 20_000), "en", "a")]  # very long, and a repeated row
    out += [(None, prose(9, 50), "en", "a"), (None, None, None, None), (107, "é ß 漢字 \x00 😀 " * 5, "fr", "a")]
    out += [(108, "same id", "en", "a"), (108, "other text", "en", "a"), (-5, "negative id here", "en", "a")]
    return out


def documents(spark, data=None):
    data = rows() if data is None else data
    extra = len(SCHEMA) - 5
    return spark.createDataFrame([(*r, len(r[1] or ""), *["x"] * extra) for r in data], SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
