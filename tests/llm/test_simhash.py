"""SimHash links by Golay keys, against loops over all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from cases import SF, TEXTS, documents
from pyspark.sql import functions as F

from seriesmill.llm import golay_simhash as G
from seriesmill.llm import queries


def plain_fingerprint(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """(doc_id, fingerprint, smallest reachable id) by comparing all pairs."""
    fps = [plain_fingerprint(t) for _, t in rows]
    lead = list(range(len(rows)))

    def top(i):
        while lead[i] != i:
            i = lead[i]
        return i

    held = np.array(fps, "u8")
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(held[:i] ^ held[i]) <= 4).tolist():
            lead[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(top(i), []).append(d)
    least = {r: min((x for x in v if x is not None), default=None) for r, v in least.items()}
    return sorted(str((d, f"{f:016x}", least[top(i)])) for i, ((d, _), f) in enumerate(zip(rows, fps)))


def signed(fps):
    return np.array(fps, "u8").view("i8")


def roots_of(spark, fps, group=G.GROUP):
    df = spark.createDataFrame([(int(x),) for x in signed(fps)], "fp bigint")
    found = {r.node: r.root for r in G.link_fingerprints(df, group).collect()}
    groups = {}
    for x in signed(fps).tolist():
        groups.setdefault(found.get(x, x), set()).add(x)
    return sorted(map(sorted, groups.values()))


def plain_groups(fps):
    held, left, out = np.array(fps, "u8"), set(range(len(fps))), []
    while left:
        front, own = [left.pop()], []
        while front:
            i = front.pop()
            own.append(i)
            near = [j for j in np.flatnonzero(np.bitwise_count(held ^ held[i]) <= 4).tolist() if j in left]
            left -= set(near)
            front += near
        out.append(sorted(signed(fps)[own].tolist()))
    return sorted(out)


def family(rng, size, flips):
    """Different fingerprints within so many bits of one centre."""
    centre, out = rng.getrandbits(64), set()
    while len(out) < size:
        x = centre
        for b in rng.sample(range(64), rng.randint(0, flips)):
            x ^= 1 << b
        out.add(x)
    return out


@pytest.mark.parametrize("errors", [1, 2])
def test_words_within_two_bits_share_an_index(errors):
    rng = np.random.default_rng(errors)
    a = rng.integers(0, 1 << 23, 20_000)
    b = a.copy()
    for _ in range(errors):
        b ^= 1 << rng.integers(0, 23, len(a))
    (x, in_x), (y, in_y) = G.indices(a), G.indices(b)
    assert set(in_x.sum(1).tolist()) == {1, 6}
    assert ((x[:, :, None] == y[:, None, :]) & in_x[:, :, None] & in_y[:, None, :]).any((1, 2)).all()


@pytest.mark.parametrize("errors", [0, 1, 2, 3, 4])
def test_fingerprints_within_four_bits_share_a_key(errors):
    rng = random.Random(errors)
    a = [rng.getrandbits(64) for _ in range(3000)]
    b = [x ^ sum(1 << k for k in rng.sample(range(64), errors)) for x in a]
    found = []
    for fps in (a, b):
        own = [set() for _ in fps]
        key, owner = G.keys(np.array(fps, "u8"))
        for k, o in zip(key.tolist(), owner.tolist()):
            assert k not in own[o]
            own[o].add(k)
        found.append(own)
    assert all(x & y for x, y in zip(*found))


def test_every_spread_of_errors_over_the_segments():
    base = 0x0123456789ABCDEF
    places = [0, 5, 21, 22, 30, 42, 43, 50, 63]
    from itertools import combinations

    others = [base ^ sum(1 << p for p in c) for n in range(5) for c in combinations(places, n)]
    key, owner = G.keys(np.array(others, "u8"))
    own = set(G.keys(np.array([base], "u8"))[0].tolist())
    assert {o for k, o in zip(key.tolist(), owner.tolist()) if k in own} == set(range(len(others)))


@pytest.mark.parametrize("group, hot", [(G.GROUP, G.HOT), (8, G.HOT), (8, 3), (1, 1)])
def test_families_of_any_size_equal_all_pairs(spark, monkeypatch, group, hot):
    """With small limits the members of large groups go by the words around them; the result is the same."""
    monkeypatch.setattr(G, "HOT", hot)
    monkeypatch.setattr(G, "ROWS", 300)
    rng = random.Random(group)
    fps = {rng.getrandbits(64) for _ in range(50)} | family(rng, 80, 3) | family(rng, 60, 6) | family(rng, 25, 10) | {0, 1, 2**64 - 1, 31, 2**63}
    fps = sorted(fps)
    assert roots_of(spark, fps, group) == plain_groups(fps)


def test_links_stay_few_in_a_large_group(spark):
    rng = random.Random(2)
    fps = sorted(family(rng, 600, 2))
    df = spark.createDataFrame([(int(x),) for x in signed(fps)], "fp bigint")
    found = G.linked(G.keyed(df)).where("not open")
    per_key = G.keyed(df).groupBy("key").count().agg(F.sum(F.col("count") - 1)).first()[0]
    assert found.count() <= per_key, "fewer links than members of groups, never all pairs"
    assert roots_of(spark, fps) == plain_groups(fps)


def test_awkward_documents(spark):
    got = G.near_duplicates(documents(spark)).collect()
    assert sorted(str((r.doc_id, f"{r.fp % 2**64:016x}", r.component_id)) for r in got) == brute(TEXTS)
    assert G.near_duplicates(documents(spark).where("false")).count() == 0
    only_null = spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id bigint, text string")
    assert [r.component_id for r in G.near_duplicates(only_null).collect()] == [None, None]


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(str(tuple(r)) for r in queries.op12_simhash(spark, SF).collect()) == brute(docs)
