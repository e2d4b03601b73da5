"""Hints of texts in large bands."""


def test_hints_are_joined_once_a_text(spark):
    """The rows that the join on id makes are texts, and not memberships of bands."""
    from shelfmark.llm.near_duplicates import _with_hints

    at = spark.range(42 * 5).selectExpr("id % 42 as band", "id div 42 as id", "9L as n", "id div 42 as component", "id % 42 = 0 as pivot")
    hints = spark.range(5).selectExpr("id", "3 as used", "array(id) as planes", "cast(null as array<long>) as few")
    rows = _with_hints(at, hints)
    plain = at.join(hints, "id").select(rows.columns)
    assert rows.exceptAll(plain).isEmpty() and plain.exceptAll(rows).isEmpty()
    plan = rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert next(i for i, x in enumerate(plan) if "Generate" in x) < next(i for i, x in enumerate(plan) if "Join" in x)
