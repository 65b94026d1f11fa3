import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

LONG = " ".join(f"word{i % 977} of{i % 31}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd_rows():
    """Ids and texts with nulls, empty and long texts, ties, repeated rows, copies, shared passages."""
    passage = " ".join(f"shared{i}" for i in range(60))
    base = " ".join(f"near{i}" for i in range(200))
    rows = [(i, f"Line {i}\n  COMMON line \nother {i % 3}\n{passage if i % 4 == 0 else ''} tail{i} end{i}") for i in range(14)]
    rows += [(100, base), (101, base + " more"), (102, base.upper()), (103, base.replace("near50 ", "")), (104, base)]
    rows += [(200, None), (201, ""), (202, " \n\t \n"), (203, "one"), (204, "one"), (205, "one two"), (206, "é ß ñ\x00 \x1f 日本"), (None, passage), (None, "nobody knows"), (None, None)]
    rows += [(300, passage + " extra"), (300, passage + " extra"), (301, "x" * 300), (302, "x" * 170), (303, LONG), (304, LONG[:-9]), (305, "again and again " * 40)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, "doc_id long, text string").repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture(scope="session")
def small_dir(tmp_path_factory, odd, spark):
    """The odd rows as tables."""
    path = tmp_path_factory.mktemp("tables")
    odd.coalesce(2).write.parquet(f"{path}/documents.parquet")
    items = [(1, " ".join(f"Shared{i}" for i in range(10, 30))), (2, "one two"), (3, None), (None, "near1 near2"), (4, "..."), (5, "absent " * 20)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(odd_turns(), "conv_id long, turn long, role string, text string").repartition(3).write.parquet(f"{path}/conversations.parquet")
    return str(path)


def odd_turns():
    """Conversations with copies, common starts, nulls, ties, repeated rows, one long one, ids below 0, no lender."""
    rows = [(c, t, "user" if t % 2 else None, f"turn {t} of {c % 3 if t < 2 else c}") for c in range(60) for t in range(c % 5)]
    rows += [(c, t, "user", f"the same {t}") for c in range(100, 160) for t in range(6)]
    rows += [(200, t, "x", "one long conversation " * (t % 3)) for t in range(700)] + [(201, t, "x", "one long conversation " * (t % 3)) for t in range(699)]
    rows += [(300, None, "a", "b"), (300, None, "b", "a"), (300, 1, "a", "b"), (300, 1, "a", "b"), (300, 1, None, None), (-7, 0, "n", "below"), (-20, 0, "n", "zero"), (None, 0, "no", "id"), (999, 5, "r", " \t\n ")]
    return rows
