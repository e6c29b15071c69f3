"""One-permutation MinHash recomputed by plain loops: fingerprints, edited texts and likeness of the registered query."""

import hashlib
import re

import xxhash
from cases import SF, TEXTS, documents

from seriesmill.llm import fingerprints, queries


def shingle_hash(words):
    """Hashes of the words, each seeded with the one before it."""
    h = 42
    for w in words:
        h = xxhash.xxh64_intdigest(w.encode(), seed=h)
    return h


def plain(text):
    """The stored low bits of each bin."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
    least = {}
    for i in range(max(1, len(words) - 4)) if words else ():
        h = shingle_hash(words[i : i + 5])
        b, v = h % fingerprints.BINS, h // fingerprints.BINS
        least[b] = min(v, least.get(b, v))
    if not least:
        return []
    out = []
    for b, (start, step) in enumerate(fingerprints.probe_orders()):
        walk = [b, *((start + step * k) % fingerprints.BINS for k in range(fingerprints.BINS))]
        out.append(least[next(w for w in walk if w in least)] % 256)
    return out


def likeness(a, b):
    if not a or not b:
        return float(not a and not b)
    raw = (sum(x == y for x, y in zip(a, b)) / len(a) - 1 / 256) / (1 - 1 / 256)
    return max(0.0, min(1.0, raw))


def test_awkward_texts(spark):
    got = sorted((str(r.doc_id), r.fingerprint) for r in fingerprints.fingerprints(documents(spark)).collect())
    assert got == sorted((str(i), bytes(plain(t)).hex()) for i, t in TEXTS)


def test_query_equals_plain_loops(spark):
    docs = sorted((tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()), reverse=True)
    got = {r.doc_id: r for r in queries.op7_fingerprint(spark, SF).collect()}
    assert len(got) == len(docs)
    for k, (doc_id, text) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1] or ""
        text = text or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, new = plain(text), plain(edited)
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (bytes(own).hex(), bytes(new).hex())
        assert abs(r.near_edited - likeness(own, new)) < 1e-12 and abs(r.near_next - likeness(own, plain(after))) < 1e-12
