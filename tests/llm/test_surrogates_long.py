"""Personal data in very long texts, and kinds of entities."""

import re

from lodestone.llm import surrogates


def replaced(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["text"] for r in surrogates.with_surrogates(df, "k").orderBy("doc_id").collect()]


def test_long_texts_do_not_overflow(spark):
    names = "Mr. " + "Anna " * 10_000
    shout = "MR. SMITH WENT " + "HOME TODAY " * 5_000
    labels = "x@" + "ab." * 100_000 + "com"
    run = "1 " + "a" * 1_000_000
    dashes = "Mr. A" + "-bc" * 50_000
    dots = "Mr. " + "A." * 50_000
    out = replaced(spark, names, shout, labels, run, dashes, dots)
    assert out[3] == run and len(out) == 6
    assert out[0] != names and out[0].endswith("Anna Anna ")


def mod97(account):
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97


def test_account_numbers(spark):
    old = ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19",
           "DE88 3704 0044 0532 0130 00"]
    new = replaced(spark, *[f"to {a}." for a in old])
    assert new[3] == f"to {old[3]}."
    made = [n[3:-1] for n in new[:3]]
    assert all(a != b and a[:2] == b[:2] and len(a) == len(b) for a, b in zip(old, made))
    assert [c == " " for c in made[0]] == [c == " " for c in old[0]]
    assert made[0].replace(" ", "") == made[1] and all(mod97(m.replace(" ", "")) == 1 for m in made)
    assert re.fullmatch(r"[A-Z]{4}", made[2][5:9])


def test_scripts_and_secrets(spark):
    key = "sk-abcdefgh12345678ijkl"
    out = replaced(spark, "Mr. Γιώργος Παπαδόπουλος", "почта@почта.рф", f'token = "{key}" and {key}')
    assert re.fullmatch(r"Mr\. [Ͱ-Ͽἀ-῿]+ [Ͱ-Ͽἀ-῿]+", out[0])
    assert out[1] != "почта@почта.рф" and out[1].endswith(".рф")
    first, second = re.fullmatch(r'token = "(sk-\w+)" and (sk-\w+)', out[2]).groups()
    assert first == second != key
