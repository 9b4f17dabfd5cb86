from quakehouse.llm import quality as Q
from quakehouse.llm.queries import QUERIES, table


def test_scores_separate_unseen_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    got = {r.doc_id: r for r in Q.score(docs, Q.fit(docs, labels, labeled=1500, pool=2000)).collect()}
    assert len(got) == docs.count()
    # the labels that training did not use
    from pyspark.sql import functions as F
    used = {r.doc_id for r in labels.orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").limit(1500).collect()}
    rest = [r for r in labels.collect() if r.doc_id not in used]
    good = sorted(got[r.doc_id].quality_score for r in rest if r.quality == 1)
    bad = [got[r.doc_id].quality_score for r in rest if r.quality == 0]
    auc = sum(sum(b < g for g in good) for b in bad) / (len(good) * len(bad))
    kept = sum(got[r.doc_id].kept for r in rest if r.quality == 1) / len(good)
    gone = sum(not got[r.doc_id].kept for r in rest if r.quality == 0) / len(bad)
    print("AUC", auc, "good kept", kept, "bad dropped", gone)
    assert auc > 0.9 and kept > 0.97


def test_edges(spark):
    df = spark.createDataFrame([(1, None, None, None), (2, "", "a", "en"), (None, "x " * 50_000, "a", "en"), (2, "", "a", "en")],
                               "doc_id long, text string, source string, lang string").selectExpr("*", "1 share", "'x' content", "2 __y")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.kept for r in Q.score(df, Q.fit(df, none)).collect()] == [True] * 4
    one = spark.createDataFrame([(1, 1), (2, None), (None, 0), (1, 1)], "doc_id long, quality int")
    assert Q.fit(df, one) == 1.0
    assert Q.score(df.limit(0), 1.0).count() == 0
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    docs = spark.createDataFrame([(i, "fine words here" if i % 2 else "### $$$ !!!", "s", "en") for i in range(90)], "doc_id long, text string, source string, lang string")
    got = {r.doc_id: r.quality_score for r in Q.score(docs, Q.fit(docs, labels)).collect()}
    assert min(got[i] for i in got if i % 2) > max(got[i] for i in got if not i % 2)
    odd = Q.score(df, Q.fit(docs, labels)).collect()
    assert len(odd) == 4
