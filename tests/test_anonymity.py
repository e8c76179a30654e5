"""Ranges shared by at least k rows."""

import pytest

from txrisk.operators import anonymity

COLUMNS = ["a", "b"]


def test_every_group_has_k_rows_and_holds_its_values(spark):
    """A third of the rows share one value, and some values lie far out."""
    df = spark.range(3000).selectExpr("id", "IF(id % 3 = 0, 7, id * 7919 % 1009) AS a", "IF(id = 5, 1e12D, double(id % 50)) AS b").repartition(5)
    got = anonymity.k_anonymous(df, COLUMNS, 20).cache()
    assert got.columns == ["id", "a_low", "a_high", "b_low", "b_high", "group_size"]
    assert got.count() == df.count() == got.select("id").distinct().count()
    ranges = [c for c in got.columns if c != "id"]
    sizes = got.groupBy(*ranges).count().collect()
    assert len(sizes) > 50
    assert all(r["count"] >= r["group_size"] >= 20 for r in sizes)
    inside = " AND ".join(f"{c} BETWEEN {c}_low AND {c}_high" for c in COLUMNS)
    assert df.join(got, "id").where(f"NOT ({inside})").isEmpty()


def test_one_value_is_one_group(spark):
    df = spark.range(100).selectExpr("id", "1 AS a", "2 AS b")
    assert [tuple(r) for r in anonymity.groups_of(df, COLUMNS, 3).collect()] == [(1, 2, 1, 1, 2, 2, 100)]


@pytest.mark.parametrize("n, left", [(9, 0), (10, 10), (0, 0)])
def test_too_few_rows_and_missing_values_are_counted(spark, n, left):
    whole = spark.range(n).selectExpr("id", "id AS a", "double(id) AS b")
    holes = spark.createDataFrame([(100, None, 1.0), (101, 1, None), (102, 1, float("nan"))], "id long, a long, b double")
    df = whole.unionByName(holes)
    assert anonymity.k_anonymous(df, COLUMNS, 10).count() == left
    assert anonymity.suppressed(df, COLUMNS, 10).first().asDict() == {"rows_in": n + 3, "incomplete": 3, "too_few": n - left}


def test_many_groups_are_joined_without_a_broadcast(spark, monkeypatch):
    df = spark.range(600).selectExpr("id", "id * 31 % 97 AS a", "id % 13 AS b")
    want = sorted(map(tuple, anonymity.k_anonymous(df, COLUMNS, 10).collect()))
    monkeypatch.setattr(anonymity, "MOST_BROADCAST", 0)
    assert sorted(map(tuple, anonymity.k_anonymous(df, COLUMNS, 10).collect())) == want


def test_groups_a_task_can_hold_are_cut_as_in_rounds(spark, monkeypatch):
    """Large groups in rounds, small ones in a task, all in rounds, all in one task: the same ranges, and few rounds."""
    df = spark.range(4000).selectExpr("id", "IF(id % 3 = 0, 7, id * 7919 % 1009) AS a", "CAST(id * 31 % 97 / 4 AS decimal(9, 2)) AS b", "float(id % 5) AS c")
    rounds, kept, seen = [], anonymity._cuts, set()
    monkeypatch.setattr(anonymity, "_cuts", lambda *a: rounds.append(1) or kept(*a))
    for task_rows, most in ((50_000, 0), (500, 5), (0, 20)):
        monkeypatch.setattr(anonymity, "TASK_ROWS", task_rows)
        rounds.clear()
        seen.add(tuple(sorted(map(tuple, anonymity.k_anonymous(df, ["a", "b", "c"], 20, accuracy=100_000).collect()))))
        assert len(rounds) <= most
    assert len(seen) == 1
