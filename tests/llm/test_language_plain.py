"""Counts, bit classifiers and loss-weighted decoding recomputed by plain loops, for every document of the query."""

import math
import zlib
from collections import Counter
from itertools import product

import pytest
import regex
from cases import SF

from seriesmill.llm import queries

BUCKETS, WRAP = 1 << 15, 1 << 64


def grams(text):
    letters = [ord(c) if 97 <= ord(c) <= 122 or ord(c) >= 0xAA else 32 for c in text.lower()]
    points = [32]
    for p in [*letters, 32]:
        if p != 32 or points[-1] != 32:
            points.append(p)
    for order in (1, 2, 3, 4):
        for i in range(len(points) - order + 1):
            code = 0
            for p in points[i : i + order]:
                code = (code * 0x100000001B3 + p) % WRAP
            yield (((code ^ code >> 29) * 0xBF58476D1CE4E5B9 + order) % WRAP >> 40) % BUCKETS


def test_query_equals_plain_loops(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]
    held = {d: zlib.crc32(str(d).encode()) % 3 == 1 for d, _, _ in docs}
    counted = {d: Counter(grams(t)) for d, t, _ in docs if t}
    has_letter = {d: bool(t and regex.search(r"\p{L}", t)) for d, t, _ in docs}
    totals = {}
    for d, _, lang in docs:
        if lang is not None and not held[d] and has_letter[d]:
            totals.setdefault(lang, Counter()).update(counted[d])
    languages = sorted(totals)
    n = len(languages)
    assert 2 < n <= 7
    columns = [(1, *c) for c in product((1, -1), repeat=n - 1) if -1 in c]
    rates = [[(totals[x][b] + 0.5) / (totals[x].total() + 0.5 * BUCKETS) for b in range(BUCKETS)] for x in languages]
    weights, trust = [], []
    for sides in columns:
        up, down = ([k for k in range(n) if sides[k] == s] for s in (1, -1))
        w = [math.log(sum(rates[k][b] for k in up) / len(up) / (sum(rates[k][b] for k in down) / len(down))) for b in range(BUCKETS)]
        weights.append(w)
        trust.append(sum(abs(math.fsum(r * v for r, v in zip(rates[k], w))) for k in range(n)) / n)
    got = {r.doc_id: r for r in queries.op5_language(spark, SF).collect()}
    assert len(got) == len(docs)
    for d, _, _ in docs:
        r = got[d]
        assert r.held_out == held[d]
        if not has_letter[d]:
            assert (r.lang_pred, r.score, r.margin, r.ambiguous) == ("und", 0.0, 0.0, False)
            continue
        size = counted[d].total()
        bits = [math.fsum(c * w[b] for b, c in counted[d].items()) / size for w in weights]
        loss = [sum(t * math.log1p(math.exp(-2.0 * sides[k] * v / t)) for sides, v, t in zip(columns, bits, trust)) / sum(trust) for k in range(n)]
        order = sorted(range(n), key=lambda k: loss[k])
        lead = loss[order[1]] - loss[order[0]]
        shares = [math.exp(-8.0 * (x - loss[order[0]])) for x in loss]
        assert r.margin == pytest.approx(lead, abs=1e-9) and r.ambiguous == (lead < 0.02)
        if lead > 1e-9:
            assert r.lang_pred == languages[order[0]]
        assert r.score == pytest.approx(1.0 / sum(shares), abs=1e-9)
