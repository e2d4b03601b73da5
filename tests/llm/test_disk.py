"""What the operators and stages leave on disk while they run."""

import glob
import os
import random

from conftest import DOCS, words
from pyspark.sql import functions as F

import corpus_pipeline
from shelfmark import session
from shelfmark.llm import near_duplicates, storage, substrings


def _docs(spark, n=60):
    rng = random.Random(31)
    passage = " ".join(words(rng, 60))
    texts = [" ".join(words(rng, 50)) + " " + (passage if k % 3 == 0 else "") for k in range(n)]
    texts += [t + " end" for t in texts[:10]]
    return spark.createDataFrame([(k, t, "en", "ab"[k % 2], len(t)) for k, t in enumerate(texts)], DOCS)


def _left(spark, made):
    folders = session._MADE[spark.sparkContext.applicationId]
    return [os.path.basename(p).split("-")[2:-1] for p in folders[made:]]


def test_stages_leave_their_decisions_and_nothing_else(spark):
    docs = storage.keep(_docs(spark), "docs")
    for stage, what in ((corpus_pipeline.drop_near_duplicates, "dropped"), (corpus_pipeline.cut_repeats, "spans"), (corpus_pipeline.mix_sources, "mix")):
        made = len(session._MADE[spark.sparkContext.applicationId])
        out = stage(spark, docs, "")
        left = _left(spark, made)
        assert [what] in left and all(x in ([what], ["ids", "of", "several", "texts"], ["repeated", "ids"], ["mix", "rows"]) for x in left)
        assert 0 < out.count() <= docs.count()


def test_mix_stores_no_text_of_rows_with_an_id(spark):
    docs = storage.keep(_docs(spark).unionByName(spark.createDataFrame([(None, "one two", "en", "a", 7)], DOCS)), "docs")
    made = len(session._MADE[spark.sparkContext.applicationId])
    corpus_pipeline.mix_sources(spark, docs, "")
    (rows,) = [p for p in session._MADE[spark.sparkContext.applicationId][made:] if "mix-rows" in p]
    assert [r.text for r in spark.read.parquet(rows).collect()] == ["one two"]


def test_a_kept_table_leaves_no_shuffle_files(spark):
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in local for f in glob.glob(f"{d}/*/shuffle_*.data")}
    before = files()
    table = storage.keep(spark.range(5000).groupBy((F.col("id") % 50).alias("k")).count(), "counts")
    assert table.count() == 50 and len(table.columns) == 2
    assert not any(os.path.getsize(f) > 100 for f in files() - before if os.path.exists(f))
    assert spark.conf.get(session.SHUFFLE_CLEANUP) == "false"


def test_bands_move_once(spark):
    docs = _docs(spark)
    sketches = storage.keep(near_duplicates.sketched(docs), "sketches")
    seen = []
    keep = near_duplicates.keep
    try:
        near_duplicates.keep = lambda df, name: (seen.append((name, df)), keep(df, name))[1]
        near_duplicates.linked(docs, sketches).collect()
    finally:
        near_duplicates.keep = keep
    assert "bands" not in [name for name, _ in seen]
    (members,) = [df for name, df in seen if name == "band-members"]
    plan = members._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(band") == 1


def test_substrings_compare_a_share_of_the_chunks_at_a_time(spark):
    docs = _docs(spark)
    rows, seen, keep = {}, [], substrings.keep
    try:
        substrings.keep = lambda df, name: (seen.append((name, keep(df, name))), seen[-1][1])[1]
        for passes in (1, 4):
            substrings.PASSES, was = passes, substrings.PASSES
            rows[passes] = sorted(map(tuple, substrings.repeated_spans(docs).collect()))
            substrings.PASSES = was
    finally:
        substrings.keep = keep
    assert rows[1] == rows[4] and rows[1]
    whole, *shares = [df.count() for name, df in seen if name == "again"]
    assert len(shares) == 4 and sum(shares) == whole and max(shares) < 0.5 * whole
    assert not any(name == "repeated-chunks" for name, _ in seen)
