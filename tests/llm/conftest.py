import numpy as np
import pytest

from tests.llm.helpers import prose

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, k string, fp string, u string, v string, line string, "
          "bucket string, node string, root string, size string, target string, row string, key string, kind string, held string, t string, h string")


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table with columns whose names the operators use themselves."""

    def make(rows):
        """rows: (doc_id, text[, lang[, source]])."""
        full = [(*r, *[None] * (4 - len(r))) for r in rows]
        return spark.createDataFrame([(*r, 0 if r[1] is None else len(r[1]), *["x"] * 16) for r in full], SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def weird(docs_of):
    """NULLs, empty and long texts, repeated rows and ties."""
    rng = np.random.default_rng(5)
    a, b = prose(rng, 60), prose(rng, 300)
    rows = [
        (1, None, "en", "a"), (2, "", "en", None), (3, " \t\n\x0b\x0c\r ", None, "b"), (None, a, "en", "a"), (4, a, "en", "a"), (4, a, "en", "a"),
        (5, a + " tail", None, None), (6, prose(rng, 60_000, 5000), "fr", "c"), (7, b, "fr", "b"), (8, b, "fr", "b"), (9, "x", "de", "b"),
        (10, "日本語のテキスト\n" * 30, "ja", "c"), (11, "\x00\x01 nul \x00", "en", "a"), (12, "a" * 5000, "en", "a"), (None, None, None, None),
    ]
    return docs_of(rows), rows
