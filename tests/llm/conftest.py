import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

LONG = " ".join(f"w{i % 997} x{i}" for i in range(30_000))
TEXTS = [
    (0, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu", "s1"),
    (1, "alpha  beta\tgamma delta epsilon zeta eta theta iota kappa lambda mu", "s1"),
    (2, None, "s2"),
    (3, "", None),
    (4, "   \n\t ", "s2"),
    (5, LONG, "s3"),
    (6, LONG + " tail", "s3"),
    (7, "Straße déjà vu 日本語 😀 \u2581mark", None),
    (8, "same", "s1"),
    (8, "same", "s1"),
    (9, "SAME", "s1"),
    (None, "same", "s4"),
]


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, clashing extra columns."""
    rows = [(d, t, s, "en", len(t or ""), "h", 1, 1.5) for d, t, s in TEXTS]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, n_chars bigint, h string, id bigint, score double")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")
