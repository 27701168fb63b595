import pytest

LONG = "word " * 200_000 + "end"


@pytest.fixture(scope="session")
def odd(spark):
    """Null and empty texts, white space, repeated rows, a null id, a very long text, and clashing columns."""
    rows = [
        (1, None, "x", 1),
        (2, "", "x", 1),
        (3, " \n\t ", "x", 1),
        (4, "One two three four five six. MIT License\npassword=hunter2222 a@b.cd", "x", 1),
        (4, "One two three four five six. MIT License\npassword=hunter2222 a@b.cd", "x", 1),
        (None, "One two three four five six. MIT License\npassword=hunter2222 a@b.cd", "x", 1),
        (5, LONG, None, None),
        (6, "é Ünï   ſecret \x1c 漢字", "y", 2),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, kept int").selectExpr(
        "doc_id", "text", "lang", "'s' AS source", "kept", "kept AS n_words", "kept AS fp", "kept AS simhash_fp", "kept AS weight", "kept AS masked", "kept AS overlaps", "kept AS host"
    )


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
