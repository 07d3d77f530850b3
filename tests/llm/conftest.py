import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "_key string, run long, score double, `a.b` int")


def sentence(rng, n, words=("the", "of", "anble", "thonor", "ering", "eas", "tion", "wher", "né")):
    return " ".join(rng.choice(words) + rng.choice(("", "s", "ly", "en")) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Texts with nulls, empty, repeated, near-equal, very long and odd ones."""
    rng = random.Random(11)
    shared = sentence(rng, 60)
    base = [sentence(rng, 90) for _ in range(8)]
    near = base[0].split()
    near[40] = "changed"
    out = [*base, base[1], base[1], " ".join(near), None, "", " \n\t ", "one", "two words", "one",
           base[2][:300] + "\n" + shared, shared + "\n" + base[3], sentence(rng, 9000),
           "Teieö " * 400, "x" * 3000, "é" * 300, "１２ ½ ² ¾", "1 2 3\n4 5 6\n1 2 3",
           "a b   c", "<|endoftext|> <s> </s> <unk> ▁▁ a", "\U0001F600 " * 30,
           base[4].upper().replace(" ", "!! "), base[5].replace(" ", " | ")]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts as a document table with repeated and null ids and clashing further columns."""
    rows = []
    for i, t in enumerate(texts):
        source = None if i % 7 == 3 else f"src{i % 3}"
        rows.append((i, t, ("en", "de", None)[i % 3], source, len(t or ""), f"k{i}", i, 0.5, i))
    rows.append(rows[1])
    rows.append((None, texts[4], "en", "src0", 1, None, None, None, None))
    rows.append((None, None, None, None, None, None, None, None, None))
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
