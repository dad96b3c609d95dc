import pytest


@pytest.fixture(scope="session")
def tokenizer():
    from tessera.llm.queries import tokenizer_path

    return tokenizer_path("byte_bpe_50k.json")


@pytest.fixture()
def odd(spark):
    """Documents with nulls, blanks, repeats, a long text, and columns called as the operators' own."""
    long = "The thing, ondle a123 " * 20_000
    rows = [
        (1, "Plain words here, plain words there.", "en"),
        (2, "", "en"),
        (3, None, "en"),
        (4, " \t\n ", None),
        (5, "Plain words here, plain words there.", "fr"),
        (5, "Plain words here, plain words there.", "fr"),
        (None, "Ünïcödé 中文 \U0001f600 <|endoftext|> it's", "en"),
        (None, None, None),
        (6, long, "de"),
        (7, "x" * 70_000, "de"),
        (8, "12345 !!! ...", "fr"),
    ]
    cols = "doc_id long, text string, lang string, source string, n_chars long, score double, ids string, label string, fp long, n_tokens string, found string, word string"
    return spark.createDataFrame([(i, t, lang, None, None if t is None else len(t), 0.5, "x", "y", 1, "z", "f", "w") for i, t, lang in rows], cols)


@pytest.fixture()
def empty(odd):
    return odd.limit(0)
