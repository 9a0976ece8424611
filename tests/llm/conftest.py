import random

import pytest
from pyspark.sql import functions as F

WORDS = "the a of and to in is it for on with as at by from an be this that are".split() + [f"w{i}x" for i in range(400)]


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(rng: random.Random, text: str, share: float) -> str:
    return " ".join(rng.choice(WORDS) if rng.random() < share else w for w in text.split(" "))


@pytest.fixture(scope="session")
def texts():
    """Copies, near copies, shared passages, odd white space, null, empty and very long texts: (doc_id, text)."""
    rng = random.Random(7)
    base = [prose(rng, rng.randint(30, 200)) for _ in range(30)]
    out = list(base)
    out += [rng.choice(base) for _ in range(12)]
    out += [edited(rng, rng.choice(base), rng.choice([0.01, 0.03, 0.05, 0.2])) for _ in range(40)]
    passage = prose(rng, 70)
    out += [f"{prose(rng, 20)} {passage}\n{prose(rng, 20)}" for _ in range(8)]
    out += [prose(rng, 40_000), "ab" * 3000, "ab" * 3000 + " x", "x", "x y", "X  Y\t", "", "   \n", None, "é ÀB ßa. <|endoftext|> 中文 🙂"]
    return list(enumerate(out))


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts as a table, with columns that clash with the operators' own, over several files."""
    df = spark.createDataFrame([(i, t, "en", "s", i) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({"row": F.lit(1), "key": F.lit("k"), "rep": F.lit(0), "digest": F.lit(""), "tag": F.lit(2), "kept": F.lit(True)}).repartition(3, "doc_id")


@pytest.fixture
def stored(spark, tmp_path):
    """Writes a table and reads it back, as operators that need a stable order ask for."""

    def store(df, name="t"):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    return store


@pytest.fixture
def table_of(spark, stored):
    def make(rows, schema="doc_id long, text string", name="t"):
        return stored(spark.createDataFrame(rows, schema), name)

    return make
