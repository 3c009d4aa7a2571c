import random

import pytest
from pyspark.sql import types as T

WORDS = [a + b for a in ("ba", "ke", "li", "mo", "nu", "sha", "tor", "vin", "qu", "ze") for b in ("", "n", "ra", "sti", "do", "gel")]
# columns that an operator's own names could clash with
CLASH = ["_id", "_tag", "anchor", "h", "size", "shard", "slot", "key", "cell", "rep", "n", "label", "block", "score", "held_out", "length", "_part"]
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in CLASH]
)


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


def make(spark, pairs):
    rows = [(i, t, "en", "s", None if t is None else len(t)) + ("x",) * len(CLASH) for i, t in pairs]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def pairs():
    """(doc_id, text) with copies, near copies, shared passages, periodic text,
    nulls, empty and very long texts, repeated rows and a null id."""
    rng = random.Random(5)
    base = [prose(rng, rng.choice([3, 20, 70, 150, 300])) for _ in range(30)]
    passage = prose(rng, 60)
    out = list(enumerate(base))
    for k in range(30, 40):
        out.append((k, base[k % 7]))  # copies
    for k in range(40, 52):  # near copies of one text, further and further away
        w = base[4].split() if len(base[4].split()) > 60 else (base[4] + " " + passage).split()
        for j in range(k - 40):
            w[(j * 13) % len(w)] = f"changed{k}x{j}"
        out.append((k, " ".join(w)))
    for k in range(52, 60):
        out.append((k, prose(rng, 9 + k) + "\n" + passage + "\t" + prose(rng, 30)))
    out += [(60, None), (61, ""), (62, " \t\n "), (63, "Und " * 90), (64, "abc " * 60 + "abd " * 60), (65, "ñandú É Ünder " * 50)]
    out += [(66, prose(rng, 30_000)), (67, base[5].upper()), out[3], out[3], (None, prose(rng, 80)), (68, "中文 " * 40)]
    return out


@pytest.fixture(scope="session")
def docs(spark, pairs):
    return make(spark, pairs).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
