"""Alignment of two tokenizers against the libraries and plain loops."""

import hashlib
import json
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from cases import SF, TEXTS, documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seriesmill.llm import queries, token_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TOKENS = Tokenizer.from_file(A)
TOKENS.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=B)
ODD = ["", " ", "  a", "a  b ", "▁a", "x ▁", "日本\n語𝄞", "\x00a", "<s>hi</s><|endoftext|>", "á \t", "\n\nx", "   " * 40, "a" * 300, " \n \n", "😀😀 é́", "\x7f\xad", "don't We'LL 12 3456"]


def letters():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}


LETTERS = letters()
NAMES = {i: t for t, i in json.load(open(A))["model"]["vocab"].items()}


def bytes_b(i):
    if PIECES.is_byte(i):
        return bytes([int(PIECES.id_to_piece(i)[3:5], 16)])
    return PIECES.id_to_piece(i).replace("▁", " ").encode()


def groups_of(text):
    """The groups of one text as (A ids, B ids), walking both sides token by token."""
    if not text:
        return []
    a, b = TOKENS.encode(" " + text, add_special_tokens=False).ids, PIECES.encode(text)
    sa, sb = [bytes(LETTERS[c] for c in NAMES[i]) for i in a], [bytes_b(i) for i in b]
    if not b"".join(sa) == b"".join(sb) == (" " + text).encode():
        return []
    out, i, j = [], 0, 0
    while i < len(a):
        i0, j0, x, y = i, j, len(sa[i]), len(sb[j])
        i, j = i + 1, j + 1
        while x != y:
            if x < y:
                x, i = x + len(sa[i]), i + 1
            else:
                y, j = y + len(sb[j]), j + 1
        out.append((a[i0:i], b[j0:j]))
    return out


def brute(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, digest) of each text."""
    all_groups = [groups_of(t) for t in texts]
    counts = Counter((a[-1], b[-1]) for gs in all_groups for a, b in gs)
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for gs in all_groups:
        line = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in gs)
        links = [(a[-1], b[-1]) for a, b in gs]
        out.append((sum(len(a) for a, _ in gs), sum(len(b) for _, b in gs), len(gs), len(links), sum(counts[x] == best[x[1]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(line.encode()).hexdigest() if gs else ""))
    return out


@pytest.fixture(scope="module")
def codes():
    return token_alignment.Codes(A, B)


def result(df, codes):
    digest = F.when(F.col("groups") != "", F.sha2("groups", 256)).otherwise("")
    found = df.withColumn("groups_sha256", digest).cache()
    out = token_alignment.with_links(found, token_alignment.pair_counts(found, codes), codes)
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in out.collect()), key=str)


def test_odd_texts_equal_the_libraries(spark, codes):
    rng = random.Random(9)
    texts = ODD + ["".join(rng.choice("abc  \n▁é日😀theing.,") if rng.random() < 0.9 else rng.choice(["<0x41>", "ation", " the", "\t\t"]) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = sorted(((k, *row) for k, row in enumerate(brute(texts))), key=str)
    assert result(token_alignment.aligned_tokens(df, codes), codes) == want


def test_awkward_documents(spark, codes):
    found = token_alignment.aligned_tokens(documents(spark), codes)
    assert result(found, codes) == sorted(((i, *row) for (i, _), row in zip(TEXTS, brute([t for _, t in TEXTS]))), key=str)
    empty = token_alignment.aligned_tokens(documents(spark).where("false"), codes)
    assert result(empty, codes) == []


def test_identical_tokens_take_the_fast_path(spark, codes):
    df = spark.createDataFrame([(1, "the man and the dog went home"), (2, "日本 \n\n unbelievably 1234")], "doc_id bigint, text string")
    found = token_alignment.aligned_tokens(df, codes).collect()
    assert found[0].other == b"" and len(found[0].own) == 2 * found[0].n_groups
    assert found[1].other != b""
    pairs = token_alignment.pair_counts(spark.createDataFrame(found), codes).collect()
    assert len({(r.a_id, r.b_id) for r in pairs}) == len(pairs)
    assert sum(r.n for r in pairs) == sum(r.n_groups for r in found)


def test_linked_tokens_are_suffixes_of_each_other(codes):
    left, right = token_alignment.byte_surfaces(codes.data_a), token_alignment.piece_surfaces(codes.data_b)
    pairs = {(a[-1], b[-1]) for t in ODD for a, b in groups_of(t)}
    assert all(left[a].endswith(right[b]) or right[b].endswith(left[a]) for a, b in pairs)
    assert len(pairs) < codes.most_pairs < 1_000_000


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = sorted(((i, *row) for (i, _), row in zip(docs, brute([t for _, t in docs]))), key=str)
    got = queries.op11_alignment(spark, SF).collect()
    assert sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got), key=str) == want
