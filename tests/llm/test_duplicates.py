"""Links, line templates, repeated runs, fingerprints, neighbours, pipeline."""

import random
from collections import Counter

import numpy as np
import pytest
from cases import SF, TEXTS, documents, linked, repeats, shingles
from pyspark.sql import functions as F

import corpus_pipeline
from seriesmill.llm import fingerprints, language_id, line_templates, ngram_join, queries, substring_dedup, vantage
from seriesmill.llm.components import components


def words(rng, n):
    return [rng.choice("abcdefghij") + str(rng.randrange(60)) for _ in range(n)]


def near_copies(seed=3, groups=12, most=14):
    """Groups of edited copies with a shared passage, exact copies and loners."""
    rng = random.Random(seed)
    passage, rows = words(rng, 30), []
    for g in range(groups):
        base = words(rng, rng.randint(3, 120))
        for _ in range(rng.randint(1, most)):
            one = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                one[rng.randrange(len(one))] = words(rng, 1)[0]
            rows.append(" ".join(one + passage * (rng.random() < 0.3)).title())
    rows += rows[:9] + [" ".join(passage)] * 4
    rng.shuffle(rows)
    return list(enumerate(rows, 100))


@pytest.mark.parametrize("limits", [None, dict(SHORT=2, BLOCK=3, FLUSH_VALUES=300, CELL_VALUES=200), dict(SHORT=4, BLOCK=2, FLUSH_VALUES=10**6, LEAST_BITS=20)])
def test_links_equal_all_pairs(spark, monkeypatch, limits):
    for k, v in (limits or {}).items():
        monkeypatch.setattr(ngram_join, k, v)
    rows = near_copies()
    out = ngram_join.near_duplicates(documents(spark, rows).repartition(3))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=str) == linked(rows)


def grown_copies(seed=5, groups=10):
    """Groups of three and more: a text, the text with one word changed, and texts with words appended, put before or inserted."""
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = words(rng, rng.randint(60, 140))
        changed = list(base)
        changed[rng.randrange(len(base))] = "changed"
        k, most = rng.randrange(len(base)), len(base) // 10
        group = [base, changed, base + words(rng, most), words(rng, most) + base, base[:k] + words(rng, most // 2) + base[k:]]
        rows += [" ".join(one) for one in group[: rng.randint(3, 5)]]
    rng.shuffle(rows)
    return list(enumerate(rows, 100))


@pytest.mark.parametrize("limits", [{}, dict(SHORT=2, BLOCK=3, FLUSH_VALUES=300, CELL_VALUES=200)])
def test_links_of_grown_copies_equal_all_pairs(spark, monkeypatch, limits):
    for k, v in limits.items():
        monkeypatch.setattr(ngram_join, k, v)
    rows = grown_copies()
    # The case of one group: a set that grew has its own shingles first and misses most lists of the others.
    base = [f"v{i}" for i in range(104)]
    rows += [(1, " ".join(base)), (2, " ".join(["other"] + base[1:])), (3, " ".join(base + [f"z{i}" for i in range(10)]))]
    out = ngram_join.near_duplicates(documents(spark, rows).repartition(3))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=str) == linked(rows)


def test_links_of_awkward_documents(spark):
    out = ngram_join.near_duplicates(documents(spark)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str) == linked(TEXTS)
    assert ngram_join.near_duplicates(documents(spark).where("false")).count() == 0
    kept = ngram_join.one_of_each(documents(spark))
    assert kept.columns == documents(spark).columns
    groups = Counter(r.component for r in ngram_join.near_duplicates(documents(spark)).collect() if r.component)
    assert kept.count() == len(groups) + sum(1 for _, t in TEXTS if not shingles(t))


def test_divide_skip_equals_intersections():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 90, rng.integers(1, 80)).astype("u8")) for _ in range(60)]
    sizes = np.array([len(s) for s in sets])
    lists = ngram_join.DivideSkip(sets, sizes)
    for q in sets:
        want = [k for k, s in enumerate(sets) if 100 * (i := len(np.intersect1d(q, s))) >= 80 * (len(q) + len(s) - i)]
        assert lists.search(q, len(q)).tolist() == want


def test_merged_lists_reach_the_overlap():
    me, lists = (10, b"a"), [[(10, b"a"), (10, b"b"), (12, b"c")], [(10, b"a"), (10, b"b")], [(9, b"z"), (10, b"b")]]
    assert ngram_join.merge_lists(me, lists, 6) == [b"b"]
    assert ngram_join.merge_lists(me, lists, 5) == []


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (103, 101), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {100: 100, 101: 100, 103: 100}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_templates_generalise_and_drop(spark):
    rows = []
    for i in range(14):
        rows.append((i, f"User joe{i} logged in at 12:{i:02d} from gate {'ABCDEFGHIJKLMN'[i]} today\nown line {chr(97 + i) * 5} of document\nAll rights reserved by us"))
    rows += [(50, "All rights reserved by us\nfirst"), (51, None), (52, ""), (None, "All rights reserved by us\nlast"), (53, "\n\n"), (1, rows[1][1])]
    docs = documents(spark, rows)
    dropped = line_templates.dropped_lines(docs)
    got = {(r.doc_id, r.line_no) for r in dropped.collect()}
    assert got == {(i, k) for i in range(1, 14) for k in (0, 2)} | {(50, 0), (None, 0)}
    left = line_templates.without_lines(docs, dropped)
    assert left.columns == docs.columns and left.count() == len(rows)
    texts = {r.doc_id: r.text for r in left.collect()}
    assert texts[0] == rows[0][1] and texts[3] == "own line ddddd of document" and texts[50] == "first" and texts[51] is None and texts[53] == "\n\n"
    assert line_templates.dropped_lines(docs.where("false")).count() == 0


def test_notices_of_several_lines_go(spark, tmp_path):
    """By the query and the stage: three lines in the middle, at the start and at the end of otherwise different documents."""
    notice = {w: [f"{w} notice", f"{w} parts may not be copied by anyone", f"{w} rights are all reserved"] for w in ("middle", "start", "end")}
    name = lambda i, k: "".join(chr(97 + int(d)) for d in f"{i:02d}{k}")
    rows = []
    for i in range(36):
        own, where = [f"{name(i, k)} own text" for k in range(2)], ("middle", "start", "end")[i % 3]
        lines = {"middle": [own[0], *notice[where], own[1]], "start": notice[where] + own, "end": own + notice[where]}[where]
        rows.append((i, "\n".join(lines)))
    docs = documents(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    first = {"middle": 1, "start": 0, "end": 2}
    want = {(i, first[w] + k) for i in range(3, 36) for w in [("middle", "start", "end")[i % 3]] for k in range(3)}
    got = queries.QUERIES["op6_line_templates"](spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.line_no) for r in got} == want
    left = {r.doc_id: r.text for r in corpus_pipeline.drop_recurring_lines(spark, docs, "").collect()}
    assert left == {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in want) for i, t in rows}


def brute_templates(rows, min_docs):
    """The same tree over all lines in one loop."""
    import re

    lines = []
    for doc_id, text in rows:
        own = text.split("\n") if text is not None else []
        for k, line in enumerate(own):
            tokens = [line_templates.FIELD if re.search("[0-9]", t) else t for t in line.split()]
            if tokens:
                lines.append((doc_id, text, k, tokens, (own[k - 1] if k else None, own[k + 1] if k + 1 < len(own) else None)))
    leaves, place = {}, {}
    for tokens in sorted({tuple(x[3]) for x in lines}, key=lambda t: " ".join(t).encode()):
        leaf = leaves.setdefault((len(tokens), tokens[:3]), line_templates.Leaf())
        place[tokens] = (len(tokens), tokens[:3], leaf.place(list(tokens)))
    docs, around, first = {}, {}, {}
    for doc_id, text, _, tokens, near in lines:
        t = place[tuple(tokens)]
        docs.setdefault(t, set()).add(text)
        around.setdefault(t, set()).add(near)
        first[t] = min(first.get(t, doc_id), doc_id)
    return {(d, k) for d, _, k, tokens, _ in lines if len(docs[t := place[tuple(tokens)]]) >= min_docs <= len(around[t]) and d != first[t]}


def test_templates_equal_one_loop(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute_templates(rows, 4)
    got = {(r.doc_id, r.line_no) for r in line_templates.dropped_lines(docs, min_docs=4).collect()}
    assert got == want and want


def test_runs_equal_one_loop(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    runs = substring_dedup.repeated_runs(docs, 8)
    assert sorted((r.doc_id, r.start, r.length, r.n_units, r.n_words) for r in runs.collect()) == repeats(rows, 8)


def test_passages_inside_lines_are_cut(spark):
    rng = random.Random(1)
    sentence = lambda: " ".join(words(rng, 9)).capitalize() + ". "
    passage = "".join(sentence() for _ in range(7))
    rows = [(i, " ".join(words(rng, 20)) + " " + (passage if i % 3 == 0 else "") + " ".join(words(rng, 20))) for i in range(12)]
    rows += [(20, None), (21, ""), (22, "..."), (None, passage), (23, rows[1][1]), (23, rows[1][1]), (1, rows[1][1])]
    docs = documents(spark, rows)
    runs = substring_dedup.repeated_runs(docs)
    flagged = Counter(r.doc_id for r in runs.collect())
    assert flagged == {3: 1, 6: 1, 9: 1, None: 1, 23: 2, 1: 1}
    left = substring_dedup.without_runs(docs, runs)
    assert left.columns == docs.columns and left.count() == len(rows)
    texts = [(r.doc_id, r.text) for r in left.collect()]
    assert sorted(len(t) for d, t in texts if d == 1) == [0, len(rows[1][1])] and (20, None) in texts and (22, "...") in texts
    assert [t for d, t in texts if d == 0] == [rows[0][1]] and all(len(t) < 200 for d, t in texts if d in (3, 6, 9))
    assert substring_dedup.repeated_runs(docs.where("false")).count() == 0


def test_passages_are_found_anywhere(spark):
    """Passages in the middle of sentences, in rows of a table and in Japanese are cut out; other text stays word for word."""
    rng = random.Random(5)
    prose = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) > 4000").limit(120).collect()]
    rows, planted, k = [], {}, 0
    for size in (55, 60, 100):
        for text in prose:
            told = [w for w in text.split(" ") if w]
            at = rng.randrange(len(told) - size)
            passage = f"{' '.join(told[at : at + size])}"
            for _ in range(2):
                rows.append((k, f"{' '.join(words(rng, 14))} {passage} {' '.join(words(rng, 14))}"))
                k += 1
            planted[k - 1] = (size, passage)
    table = " | ".join(words(rng, 60))
    japanese = "".join(rng.choice("あいうえおかきくけこさしすせそ日本語文章処理、。") for _ in range(500))
    rows += [(k, f"head {table} tail"), (k + 1, f"other start {table} | end"), (k + 2, f"これは{japanese}です"), (k + 3, f"また{japanese}でした")]
    runs = substring_dedup.repeated_runs(documents(spark, rows)).collect()
    got = {}
    for r in runs:
        got.setdefault(r.doc_id, []).append((r.start, r.start + r.length))
    assert {k + 1, k + 3} <= set(got) and not {k, k + 2} & set(got)
    for size, least in ((55, 0.95), (60, 0.97), (100, 0.98)):
        ids = [i for i, (s, _) in planted.items() if s == size]
        assert sum(i in got for i in ids) / len(ids) >= least
    for i, text in rows:
        if i in planted:
            inside = text.index(planted[i][1])
            assert all(inside - 1 <= a and b <= inside + len(planted[i][1]) + 1 for a, b in got.get(i, []) if i % 2)
    assert sorted((r.doc_id, r.start, r.length, r.n_units, r.n_words) for r in runs) == repeats(rows, substring_dedup.MIN_WORDS)


@pytest.mark.parametrize("text", ["", " ", "...", "a\u00a0b\u3000c" * 40, "x" * 5000, "日本語の文章" * 30, "One two three. " * 9, "\x1c\x85 a", "w " * 3000])
def test_units_tile_their_text(text):
    found = [m[0] for m in substring_dedup.UNIT.finditer(text)]
    assert "".join(found) == text
    places = substring_dedup.places_of(text)
    assert all(w < substring_dedup.MIN_WORDS and v < substring_dedup.MIN_WORDS for _, _, w, v, _ in places)


def test_fingerprints_estimate_the_similarity(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 40)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    got = {r.doc_id: r for r in fingerprints.with_edits(docs).collect()}
    errors = []
    for k, (doc_id, text) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + nxt[:half]
        assert got[doc_id].edited == edited and got[doc_id].n_chars == len(text)
        a, b = shingles(text), shingles(edited)
        errors.append(got[doc_id].near_edited - len(a & b) / max(1, len(a | b)))
    assert np.sqrt(np.mean(np.square(errors))) < 0.06 and abs(np.mean(errors)) < 0.02


def test_fingerprints_of_awkward_documents(spark):
    rows = fingerprints.with_edits(documents(spark)).collect()
    assert len(rows) == len(TEXTS)
    plain = fingerprints.fingerprints(documents(spark)).collect()
    by_text = {}
    for (doc_id, text), r in zip(TEXTS, plain):
        assert r.doc_id == doc_id
        by_text.setdefault(text or "", set()).add(r.fingerprint)
        assert len(r.fingerprint) == (0 if not (text or "").split() else 2 * fingerprints.BINS)
    assert all(len(v) == 1 for v in by_text.values())
    assert fingerprints.with_edits(documents(spark).where("false")).count() == 0


def test_every_walk_visits_all_bins():
    for start, step in fingerprints.probe_orders():
        assert len({(start + step * k) % fingerprints.BINS for k in range(fingerprints.BINS)}) == fingerprints.BINS


def brute_nearest(ids, points, query, k):
    d = np.sqrt(((points - points[query]) ** 2).sum(1))
    order = [j for j in np.lexsort((ids, d)) if ids[j] != ids[query]][:k]
    return [(int(ids[j]), float(d[j])) for j in order]


def test_relax_one_is_exact(spark):
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal(size=(400, 6)), np.repeat(rng.normal(size=(1, 6)), 150, 0)])
    ids = rng.permutation(len(points))
    table = spark.createDataFrame([(int(i), [float(x) for x in p]) for i, p in zip(ids, points)], "vec_id bigint, embedding array<double>")
    index = vantage.build_index(vantage.vectors(table, "vec_id", "embedding"), shard_rows=120, leaf=8)
    asked = vantage.vectors(table.where("vec_id % 7 = 0"), "vec_id", "embedding")
    got = {}
    for r in vantage.search(index, asked, 5, 1.0, query_rows=20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for q in np.flatnonzero(ids % 7 == 0):
        want = brute_nearest(ids, points, q, 5)
        assert [v for v, _ in got[ids[q]]] == [v for v, _ in want]
        assert np.allclose([s for _, s in got[ids[q]]], [s for _, s in want], rtol=0, atol=1e-12)


def test_recall_with_production_parameters(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    ids, points = np.array([r.vec_id for r in docs]), np.array([r.embedding for r in docs], float)
    found = {}
    for r in queries.QUERIES["op3_vantage"](spark, "/root/testdata/sf0.1").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    hits = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        want = {v for v, _ in brute_nearest(ids, points, q, 10)}
        hits, total = hits + len(want & set(found[ids[q]])), total + len(want)
    assert hits / total >= 0.9


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (None, [1.0, 0.5]), (7, [1.0, 0.5]), (7, [1.0, 0.5]), (8, [1.0, 2.0, 3.0]), (0, [9.0, 9.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit("x")).withColumn("shard", F.lit(1))
    got = vantage.nearest(table, table.where("vec_id = 0 and embedding[0] = 1.0"), 10).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 7, 0.5), (0, 2, 7, 0.5)]
    assert vantage.nearest(table.where("false"), table.where("false")).count() == 0


def test_pipeline_stages_equal_plain_versions(spark):
    """Each stage against a loop over its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(documents(spark, [(9001, None), (9002, "12 !!"), (9003, "")]).select("doc_id", "text", "lang", "source", "n_chars"))
    columns = docs.columns
    texts = lambda df: {r.doc_id: r.text for r in df.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_join", "substring_dedup", "packing"]

    one = stages["language_id"](spark, docs, SF)
    assert one.columns == columns and set(texts(docs)) - set(texts(one)) == {9001, 9002, 9003}

    two = stages["line_dedup"](spark, one, SF)
    gone = brute_templates(list(texts(one).items()), line_templates.MIN_DOCS)
    want = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in texts(one).items()}
    assert two.columns == columns and texts(two) == {i: t for i, t in want.items() if t.strip(" \t\r\n")}

    three = stages["ngram_join"](spark, two, SF)
    groups = {c for _, _, c in linked(list(texts(two).items()))}
    assert three.columns == columns and set(texts(three)) == groups

    four = stages["substring_dedup"](spark, three, SF)
    want = dict(texts(three))
    for doc_id, start, length, *_ in reversed(repeats(list(want.items()), substring_dedup.MIN_WORDS)):
        want[doc_id] = want[doc_id][:start] + want[doc_id][start + length :]
    assert four.columns == columns and texts(four) == {i: t for i, t in want.items() if t.strip(" \t\r\n")}
    assert all(r.n_chars == len(r.text) for r in four.collect())

    five = stages["packing"](spark, four, SF)
    assert {r.doc_id for r in five.collect()} == set(texts(four))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), SF).count() == 0


def test_ambiguous_flags():
    model = language_id.fit_counts(["a", "b"], [np.bincount(language_id.gram_buckets("aaa bbb"), minlength=language_id.BUCKETS)] * 2)
    assert model.predict("aaa")[3]


def test_repeated_queries_are_asked_once(spark):
    """A query row that occurs twice has ten different neighbours, one id with two vectors has them for each."""
    rng = np.random.default_rng(12)
    points = rng.normal(0, 1, (50, 6))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(points)]
    other = (0, [float(x) for x in rng.normal(0, 1, 6)])
    table = spark.createDataFrame(rows + [rows[0], other], "vec_id bigint, embedding array<double>").repartition(3)
    got = vantage.nearest(table, table.where("vec_id in (0, 7)"), 10).collect()
    want = []
    for i, v in (rows[0], other, rows[7]):
        held = [(float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), j) for j, w in [*rows, rows[0], other] if j != i]
        want += [(i, k + 1, j) for k, (_, j) in enumerate(sorted(held)[:10])]
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == sorted(want)
