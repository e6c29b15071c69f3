"""Phrases by automaton equal plain searches, overlaps included."""

import random

import pytest
from pyspark.sql import functions as F

from seriesmill.operators import cleaning as C
from seriesmill.operators import phrases as P
from seriesmill.plans.quotes import WORDS
from seriesmill.sources import tables as S
from seriesmill.streaming import engine as E

SF = "/root/testdata/sf0.001"


def places(text, phrase):
    low, p, out, at = (text or "").lower(), phrase.lower(), [], -1
    while p and (at := low.find(p, at + 1)) >= 0:
        out.append(at)
    return out


def test_overlaps_repeats_and_odd_texts(spark):
    phrases = ["aba", "ab", "ABA", "b a", "é日", "", "zz", "a"]
    rows = [(1, "Ababa b a"), (2, None), (3, ""), (4, "xé日É日"), (4, "zzzz"), (None, "aba"), (5, "q" * 100_000 + "aba")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("extra", F.lit(1))
    got = P.phrase_places(df, phrases, ["doc_id"]).collect()
    want = [(i, p, at, len(p)) for i, t in rows for p in phrases for at in places(t, p)]
    assert sorted(map(str, ((r.doc_id, r.phrase, r.begin, r.length) for r in got))) == sorted(map(str, want))
    alerts = P.phrase_alerts(df, phrases).collect()
    assert sorted(str((r.doc_id, r.text, r.extra, r.matched)) for r in alerts) == sorted(str((i, t, 1, ",".join(p for p in phrases if places(t, p)))) for i, t in rows if any(places(t, p) for p in phrases))
    assert P.phrase_alerts(df, []).count() == 0 and P.phrase_places(df.limit(0), phrases, ["doc_id"]).count() == 0
    with pytest.raises(ValueError, match="in parts"):
        P.phrase_alerts(df, ["x" * (P.MOST_CHARACTERS + 1)])


def test_equal_to_the_expressions_and_on_a_stream(spark):
    docs = S.table(spark, SF, "documents").select("doc_id", "text")
    want = sorted((r.doc_id, r.matched) for r in C.keyword_alerts(docs, WORDS).collect())
    assert want and sorted((r.doc_id, r.matched) for r in P.phrase_alerts(docs, WORDS).collect()) == want
    stream = E.stream_table(spark, f"{SF}/documents.parquet").select("doc_id", "text")
    assert sorted((r.doc_id, r.matched) for r in E.run_to_table(P.phrase_alerts(stream, WORDS), "phrases").collect()) == want


def test_ten_thousand_phrases(spark):
    rng = random.Random(3)
    docs = S.table(spark, SF, "documents").select("doc_id", "text").where("text IS NOT NULL")
    texts = [tuple(r) for r in docs.limit(40).collect()]
    words = [w for _, t in texts for w in t.split()]
    phrases = sorted({" ".join(words[(k := rng.randrange(len(words))) : k + rng.randint(1, 3)]) for _ in range(10_000)} | {f"never{k}" for k in range(3000)})
    some = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = {(r.doc_id, r.phrase): r["count"] for r in P.phrase_places(some, phrases, ["doc_id"]).groupBy("doc_id", "phrase").count().collect()}
    lows = {i: t.lower() for i, t in texts}
    for phrase in rng.sample(phrases, 300):
        for i, t in lows.items():
            assert got.get((i, phrase), 0) == len(places(t, phrase))
