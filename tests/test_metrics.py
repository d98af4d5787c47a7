"""Purity: by a plain count of majorities, plus edge cases."""
from phenolens.operators import metrics as me


def cases(spark, table):
    rows = [(c, l) for (c, l, n) in table for _ in range(n)]
    return spark.createDataFrame(rows, "cluster int, label int")


def test_purity_is_the_share_of_majorities(spark):
    tables = [[(0, 7, 4), (0, 8, 9), (1, 7, 6)], [(2, 1, 2), (2, 2, 2), (5, 3, 11), (5, 1, 12), (6, 2, 1)]]
    for t in tables:
        best = {}
        for c, _, n in t:
            best[c] = max(best.get(c, 0), n)
        assert me.purity_value(cases(spark, t)) == sum(best.values()) / sum(n for *_, n in t)


def test_purity_empty_is_null(spark):
    row = me.purity(spark.createDataFrame([], "cluster int, label int")).first()
    assert row["purity"] is None and row["n_rows"] == 0


def test_contingency_counts(spark):
    t = [(1, 2, 3), (1, 3, 1), (2, 2, 2)]
    got = {(r["cluster"], r["label"]): r["n"] for r in me.contingency(cases(spark, t)).collect()}
    assert got == {(1, 2): 3, (1, 3): 1, (2, 2): 2}
