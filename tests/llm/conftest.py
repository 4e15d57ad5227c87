import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF_SMALL = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


@pytest.fixture(scope="session")
def tokenizer():
    from gridcat.llm.common import tokenizer_path
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def prose(seed, n):
    """``n`` made-up words; equal seeds give equal texts."""
    import random

    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(["", "s", "ed", "ing"]) for _ in range(n))


def awkward_docs(spark):
    """Null columns, empty and blank texts, a long text, repeated rows, equal
    keys, and further columns whose names operators use inside."""
    long_text = "\n".join(prose(i, 60) for i in range(400))
    rows = [(1, "", "a", 1), (2, None, None, 2), (3, " \n\t ", "b", 3), (4, long_text, "c", 4), (5, "x" * 200_000, "d", 5),
            (6, prose(6, 50), "e", 6), (6, prose(6, 50), "e", 6), (7, prose(6, 50), "f", 7), (None, prose(8, 30), "g", 8),
            (8, "Ünïcödé — 漢字 🎉\u0085 end\x1c.", None, None), (6, prose(9, 40), "h", 9)]
    return spark.createDataFrame(
        [(d, t, s, n, n, "r", "z") for d, t, s, n in rows],
        "doc_id long, text string, source string, fp int, score int, rule string, host string")
