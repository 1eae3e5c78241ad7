import pytest

#: Null and empty texts, one blank, repeated rows and ids, a null id, ties, a very long text.
LONG = "une longue phrase avec des mots " * 4000
ODD = [
    (5, None), (6, ""), (7, " \n\t "), (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
    (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
    (3, "ALPHA beta gamma delta epsilon zeta eta theta iota lambda"), (4, "x"), (8, "x"), (9, LONG),
    (10, LONG + " fin"), (11, "same row"), (11, "same row"), (None, "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
    (12, "emoji 🙂 and é combining, digits 12 34"),
]
#: Extra columns with names that the operators use themselves.
CLASHING = {"node": 1, "key": "k", "n": 2, "rank": 3, "words": "w", "length": 4, "piece": 5, "score": 0.5,
            "lang_pred": "zz", "component_id": 9, "kept": False, "shard": "s", "bytes": 1, "range": 7, "label": "l"}


@pytest.fixture(scope="session")
def spark(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    return spark


@pytest.fixture(scope="session")
def odd(spark):
    schema = "doc_id long, text string, " + ", ".join(
        f"{k} {'string' if isinstance(v, str) else 'boolean' if isinstance(v, bool) else 'double' if isinstance(v, float) else 'int'}"
        for k, v in CLASHING.items())
    return spark.createDataFrame([(*r, *CLASHING.values()) for r in ODD], schema)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
