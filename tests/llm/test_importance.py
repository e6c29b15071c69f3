"""Importance resampling: CRCs from prefixes, weights, draws."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from cases import SF, TEXTS, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from seriesmill.llm import importance, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def grams(text, n):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) for i in range(len(w) - n + 1)]


def brute(docs, target, percent, least, longest, buckets, seed):
    """(doc_id, features, weight, score, rank) by hashing every n-gram by itself."""
    feats = [[c % buckets for n in range(1, longest + 1) for c in grams(t, n)] for _, t in docs]
    s, t = Counter(b for f in feats for b in f), Counter(c % buckets for x in target for n in range(1, longest + 1) for c in grams(x, n))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in range(buckets)}
    out = []
    for (doc_id, text), f in zip(docs, feats):
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        out.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    eligible = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(eligible[: percent * len(eligible) // 100]):
        r[4] = k + 1
    return sorted(map(str, (tuple(r[:5]) for r in out)))


def rows_of(df):
    return sorted(str((r.doc_id, r.n_features, r.weight, r.score, r["rank"])) for r in df.collect())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=80)), max_size=6), st.integers(1, 5))
def test_every_gram_comes_from_two_prefixes(some, n):
    crcs, owner = importance.Prefixes(some).grams(n)
    assert list(zip(crcs.tolist(), owner.tolist())) == [(c, d) for d, t in enumerate(some) for c in grams(t, n)]


def test_long_words_and_long_runs():
    rng = random.Random(4)
    text = " ".join("é" * rng.randint(1, 400) for _ in range(3000))
    for n in (1, 2, 900):
        assert importance.Prefixes([text]).grams(n)[0].tolist() == grams(text, n)
    assert importance.shifted(np.array([1, 7], "u4"), np.array([0, 0]))[1] == 7


def test_awkward_documents_equal_brute_force(spark):
    target = ["The lazy dog barks", None, "", "w1x1 w2x2"]
    aim = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id bigint, text string")
    for percent, least, longest, buckets in ((50, 1, 1, 10_000), (100, 2, 3, 97), (30, 1, 2, 100_000)):
        df = importance.resample(documents(spark), aim, percent, least, longest, buckets, 7)
        got = rows_of(df)
        want = brute(TEXTS, target, percent, least, longest, buckets, 7)
        assert len(got) == len(TEXTS)
        # Equal ids with equal scores may change places.
        assert [g.rsplit(",", 1)[0] for g in got] == [w.rsplit(",", 1)[0] for w in want]
        assert sorted(g.rsplit(",", 1)[1] for g in got) == sorted(w.rsplit(",", 1)[1] for w in want)


def test_empty_tables(spark):
    aim = spark.createDataFrame([], "item_id bigint, text string")
    assert importance.resample(documents(spark).where("false"), aim).count() == 0
    out = importance.resample(documents(spark), aim, 0).collect()
    assert len(out) == len(TEXTS) and {r["rank"] for r in out} == {None}


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect()]
    assert rows_of(queries.op13_importance(spark, SF)) == brute(docs, target, 10, 20, 1, 10_000, 2024)
