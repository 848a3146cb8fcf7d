"""Tables with every odd case, shared by the tests of this package."""

import pytest

ODD = "doc_id bigint, text string, lang string, source string, n_chars bigint, runs string, collapsed int, row string, start string, pair int, value string"


@pytest.fixture(scope="session")
def oddities(spark):
    """Nulls, empties, repeated rows and ids, very long texts, white space and bytes of all kinds, clashing columns."""
    block = " ".join(f"w{i}" for i in range(30))
    texts = [
        (1, block), (2, f"x {block} y"), (2, f"x {block} y"), (3, None), (4, ""), (5, " \t\r\n"), (None, block), (None, block), (None, None),
        (6, "a b"), (7, "one two " * 12), (8, "one two " * 12), (9, f"{block}\n{block}"), (10, "word " * 60_000),
        (11, "aa bb  cc <|endoftext|> <s> <0x41> é 漢漢 \U0001f642 a  b\tc\n d"), (12, "under▁score"), (13, "  lead and trail  "),
        (10, f"{block} z {block}"), (20, "a\x00b \x85 c"), (21, "é ﬁ Ａ ‍"),
    ]
    rows = [(i, t, None, "s", None, "r", 1, "x", "y", 2, "v") for i, t in texts]
    return spark.createDataFrame(rows, ODD).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], ODD)
