import pytest

from paritas.llm.queries import tokenizer_path

TEXTS = [
    (1, "The cat sat on the mat and looked at the dog in the garden."),
    (2, ""),
    (3, None),
    (4, "   \n\t "),
    (5, "The cat sat on the mat and looked at the dog in the garden."),
    (5, "The cat sat on the mat and looked at the dog in the garden."),
    (None, "No id here, token = abcdef0123456789 and nothing else."),
    (7, "word " * 30_000),
    (8, "É ß 文字 🙂 é <|endoftext|> İstanbul Σίσυφος"),
    (9, "x" * 200_000),
]


@pytest.fixture
def odd(spark):
    """Nulls, empty and long texts, repeated rows, clashing extra columns."""
    rows = [(i, t, None, "s", 1, "own", "own", "own", "own", 0) for i, t in TEXTS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, "
              "language string, secrets string, leaks string, quality string, id long")


@pytest.fixture
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def tokenizer():
    return tokenizer_path()
