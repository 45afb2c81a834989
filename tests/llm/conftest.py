import random

import pytest

WORDS = "the of and haus maison calle river stone paper cloud seven light garden winter north".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ing", ","]) for _ in range(n))


@pytest.fixture(scope="session")
def messy_rows():
    """Nulls, empties, one long text, repeated rows, ties, odd white space; (doc_id, text)."""
    rng = random.Random(3)
    rows = [(k, sentence(rng, rng.randrange(1, 60))) for k in range(10, 60)]
    base = sentence(rng, 80)
    rows += [(k, base) for k in (5, 61, 62, 63)]
    words = base.split()
    for k in range(64, 76):
        changed = list(words)
        for _ in range(k % 6):
            changed[rng.randrange(len(changed))] = f"w{rng.randrange(1000)}"
        rows.append((k, " ".join(changed)))
    rows += [(0, ""), (1, None), (2, " "), (3, "\n"), (4, "\t\x0b\x0c\r"), (None, base), (None, None), (None, "x")]
    rows += [(80, "same row"), (80, "same row"), (81, "Same  row"), (82, "same\nrow"), (82, "other text of this id")]
    rows += [(90, sentence(rng, 20000)), (91, "y" * 5000), (92, "é　\x1c\x85 <|endoftext|> z\u0000z 日本")]
    return rows


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    """The rows with other columns, whose names the operators use inside."""
    schema = (
        "doc_id long, text string, score string, label string, text_hash string, fp string, node string, "
        "_doc_id string, key string, kept string"
    )
    return spark.createDataFrame([(*r, *["x"] * 8) for r in messy_rows], schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, score string")
