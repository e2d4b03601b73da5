"""What joins of near-duplicates send through the driver does not grow with the documents."""

import random

from conftest import DOCS, words

from shelfmark.llm import near_duplicates, storage


def _docs(spark):
    rng = random.Random(8)
    texts = [words(rng, 40) for _ in range(30)]
    texts += [t[:-1] + ["end"] for t in texts[:20]] + [texts[25][:-1] + [str(k)] for k in range(50)]
    return storage.keep(spark.createDataFrame([(k, " ".join(t), "en", "a", 1) for k, t in enumerate(texts)], DOCS), "docs")


def _watched(monkeypatch):
    """The tables kept from now on, as (name, plan), and the rows of each explicit broadcast."""
    plans, sent, keep, send = [], [], storage.keep, near_duplicates.F.broadcast

    def watch(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return keep(df, name)

    monkeypatch.setattr(near_duplicates, "keep", watch)
    monkeypatch.setattr(near_duplicates.F, "broadcast", lambda df: (sent.append(df.count()), send(df))[1])
    return plans, sent


def test_large_tables_are_not_sent(spark, monkeypatch):
    docs = _docs(spark)
    plans, sent = _watched(monkeypatch)
    monkeypatch.setattr(storage, "SENT_ROWS", 5, raising=False)
    monkeypatch.setattr(near_duplicates, "HINT_ROWS", 5, raising=False)
    monkeypatch.setattr(near_duplicates, "BROADCAST_IDS", 30)
    component = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(docs, 80).collect()}
    assert component == {k: k - 30 if 30 <= k < 50 else 25 if k >= 50 else k for k in range(100)}
    assert len(sent) > 4 and max(sent) < 60  # a share by hash; 91 candidates in all
    for name in ("band-members", "large-bands"):
        found = [plan for n, plan in plans if n == name]
        assert found and not any("BroadcastHashJoin" in plan for plan in found)


def test_ids_are_sent_in_shares_until_texts_move(spark, monkeypatch):
    docs, ids = _docs(spark), storage.keep(spark.range(0, 100, 2).withColumnRenamed("id", "doc_id"), "ids")
    known = sorted(near_duplicates.with_sets(docs, ids).collect())
    assert [r.doc_id for r in known] == [*range(0, 100, 2)]
    for most, reads in ((20, 3), (2, 1)):
        plans, sent = _watched(monkeypatch)
        monkeypatch.setattr(near_duplicates, "BROADCAST_IDS", most)
        assert sorted(near_duplicates.with_sets(docs, ids).collect()) == known
        assert [n for n, _ in plans] == ["sets"] * reads and (not sent if reads == 1 else sum(sent) == 50 > max(sent))
        assert all(("SortMergeJoin" if reads == 1 else "BroadcastHashJoin") in plan for _, plan in plans)
        monkeypatch.undo()


def test_a_table_is_bounded_by_its_rows(spark):
    ids, rows = storage.keep(spark.range(40), "ids"), spark.range(99)
    joins = {n: rows.join(storage.bounded(ids, n), "id")._jdf.queryExecution().executedPlan().toString() for n in (39, 40)}
    assert "SortMergeJoin" in joins[39] and "BroadcastHashJoin" in joins[40]
