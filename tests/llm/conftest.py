import random

import pytest

LONG = "lorem ipsum dolor " * 30_000
# Texts that no operator may stumble over, by id; two rows are full copies.
MESSY = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "One two three\nfour five"),
    (5, "One two three\nfour five"), (6, LONG), (7, LONG), (None, "without an id at all"),
    (None, None), (8, "ÉTÉ ß İ Σας 😀 \x00 ́ x"), (9, "x" * 50_000),
]
EXTRA = "id string, label string, key string, row string, hash string, words string, content string, n string"


@pytest.fixture(scope="session")
def messy(spark):
    """The texts with columns whose names operators use inside."""
    rows = [(i, t, *["extra"] * 8) for i, t in MESSY]
    return spark.createDataFrame(rows, f"doc_id bigint, text string, {EXTRA}")


@pytest.fixture
def same_extras(messy):
    def check(result):
        """All rows and columns are there, and the others hold what they held."""
        names = [c for c in messy.columns if c not in ("doc_id", "text")]
        assert set(messy.columns) <= set(result.columns)
        assert result.count() == len(MESSY)
        assert all(r[n] == "extra" for r in result.collect() for n in names)

    return check


def made_words(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choices("abcdeilmnorst", k=r.randrange(2, 8))) for _ in range(n)]


@pytest.fixture
def words():
    """Made-up texts: ``words(seed, n)`` gives a list of n words."""
    return made_words
