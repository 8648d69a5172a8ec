import pytest

HEX = "0123456789abcdef0123456789abcdef"
LONG = " ".join(f"word{i % 311}x{i}" for i in range(6000))
TEXTS = [
    None, "", " ", "\n\t", "one", "one two", "password = hunter22", "x" * 5000, LONG, LONG, LONG + " tail",
    f"key {HEX} and AKIA{'Q7' * 10} token: 'abc_def.ghi' secret=short",
    "line one here\nline one here\n\nanother line", "a b c a b c a b c", "Ünïcödé 日本語 text 😀 \x0b end",
    "The QUICK brown fox jumps over the lazy dog while seven wizards quietly brew potions in the old tower by the sea",
    "the quick brown fox jumps over the lazy dog while seven wizards quietly brew potions in the old tower by the sea",
    "the quick brown fox jumps over the lazy dog while seven wizards quietly brew potions in the old tower by the lake",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, ties, repeated rows and columns with clashing names."""
    rows = [(i, t, None if i % 5 == 0 else f"s{i % 3}", len(t or ""), "x", i) for i, t in enumerate(TEXTS)]
    rows += [rows[3], rows[11], (None, "no id here at all", "s1", 17, None, 1), (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, kept string, n_words long")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
