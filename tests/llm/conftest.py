import pathlib

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not pathlib.Path(SF).is_dir():
        pytest.skip("no test tables")
    return SF


@pytest.fixture(scope="session")
def edge(spark):
    """Documents at the edges: null and repeated ids, null, empty, blank, equal and long texts, and clashing columns."""
    long = " ".join(f"w{i % 977} Und," for i in range(30_000))
    rows = [(3, "one two three four five six seven"), (1, None), (None, "no id"), (2, ""), (5, " \n\t "),
            (4, "one two three four five six seven"), (4, "one two three four five six seven"), (9, long), (8, long),
            (7, "\U0001f600 Été 'tis  a\nb"), (6, "x"), (None, None)]
    extra = [(i, t, "u", 1, 2.0, "s") for i, t in rows]
    return spark.createDataFrame(extra, "doc_id long, text string, unit string, shard int, h double, slot string")


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.limit(0)
