"""Small document tables for the operators of the training-data subpackage."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    def build(rows, schema=SCHEMA, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)
    return build


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, one word, control characters, other scripts, and a very long text."""
    return [None, "", " \t\n\x0b\x0c\r ", "word", "a\x0bb\x0cc\rd\te", "漢字 ñandú ß x", "A a  A\n\n A a A", "x" * 5000,
            " ".join(f"w{i % 97}" for i in range(60_000)), "no letters: 123", "1 2 3", "tail "]
