"""Spans, prefix counts, packing, language, chat format."""

import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from cases import SF, TEXTS, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seriesmill.llm import chat_format, language_id, packing, queries, sentencepiece_spans, token_counts
from seriesmill.llm.pieces import CharMap, PieceModel

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
DATA = open(PIECES, "rb").read()
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECES)
ODD = ["", " ", "  a", "a  b ", "▁a", "日本\n語𝄞", "\x00a", "<s>hi</s>", "á \t", "\n\nx", "   " * 40, "a" * 300, " \n \n", "😀😀 é́", "x" * 2000]


def some_texts():
    rng = random.Random(5)
    return ODD + ["".join(rng.choice("abc  \n▁é日😀theing.,") for _ in range(rng.randint(1, 60))) for _ in range(400)]


@pytest.fixture(scope="module")
def encoder():
    return sentencepiece_spans.SpanEncoder(DATA)


def test_ids_spans_and_decoding_equal_the_library(encoder):
    texts = some_texts()
    for text, (ids, begins, ends) in zip(texts, encoder.encode_all(texts)):
        proto = LIBRARY.encode(text, return_type="proto").pieces
        assert ids.tolist() == [p.id for p in proto]
        data = text.encode()
        assert [data[b:e].decode() for b, e in zip(begins, ends)] == [p.surface for p in proto]
        assert sentencepiece_spans.decode_ids(encoder.model, ids) == LIBRARY.decode(ids.tolist()) == encoder.model.decode(ids.tolist())


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text_round_trips(text):
    encoder = test_any_text_round_trips.__dict__.setdefault("encoder", sentencepiece_spans.SpanEncoder(DATA))
    (ids, begins, ends), *_ = encoder.encode_all([text])
    assert ids.tolist() == LIBRARY.encode(text)
    assert sentencepiece_spans.decode_ids(encoder.model, ids) == text.replace("▁", " ")
    assert not len(ends) or (ends[-1] == len(text.encode()) and (np.diff(begins) >= 0).all())


def compiled(rules: dict[str, str]) -> bytes:
    """A double-array trie for a few rules, in the public layout: children at offset ^ byte, the value below the last byte."""
    tree: dict = {}
    for k, v in rules.items():
        node = tree
        for b in k.encode():
            node = node.setdefault(b, {})
        node[0] = v
    strings, units, used = b"", {0: 0}, {0}

    def place(node, at):
        nonlocal strings
        offset = next(o for o in range(256, 100_000, 256) if not any((at ^ o ^ c) in used for c in node))
        units[at] |= (offset >> 8) << 10 | 1 << 9
        for c in node:
            used.add(at ^ offset ^ c)
        for c, child in node.items():
            spot = at ^ offset ^ c
            if c == 0:
                units[at] |= 1 << 8
                units[spot] = 1 << 31 | len(strings)
                strings += child.encode() + b"\0"
            else:
                units[spot] = c
                place(child, spot)

    place(tree, 0)
    array = [units.get(i, 0) for i in range(max(units) + 1)]
    return struct.pack(f"<I{len(array)}I", 4 * len(array), *array) + strings


def test_compiled_map_replaces_the_longest_prefix_and_keeps_the_source():
    rules = {"ﬁ": "fi", "ﬁﬁ": "Z", "Ａ": "A", "\t": " ", "x": ""}
    charmap = CharMap(compiled(rules))
    assert charmap.match("ﬁﬁ".encode(), 0) == (6, b"Z") and charmap.match("ﬁa".encode(), 0) == (3, b"fi") and charmap.match(b"q", 0) is None
    encoder = sentencepiece_spans.SpanEncoder(DATA)
    encoder.model.charmap = charmap
    assert not encoder.model.plain
    text = "Ａxﬁn\tﬁﬁ b"
    normal, begins, ends = encoder.model.normalise(text)
    assert normal == "▁Afin▁Z▁b"
    (ids, b, e), *_ = encoder.encode_all([text])
    assert ids.tolist() == LIBRARY.encode("Afin Z b")
    data = text.encode()
    assert "".join(data[i:j].decode() for i, j in zip(b, e)) == "Ａﬁn\tﬁﬁ b"  # the dropped x has no piece


def test_squeezed_blanks_keep_their_source():
    model = PieceModel(DATA)
    model.squeeze = True
    normal, begins, ends = model.normalise("  a  b ")
    assert normal == "▁a▁b" and begins == [2, 2, 3, 5] and ends == [2, 3, 4, 6]


def test_encode_decode_on_awkward_documents(spark):
    rows = sentencepiece_spans.encode_decode(documents(spark), PIECES).collect()
    assert len(rows) == len(TEXTS)
    want = sorted((str(i), str(LIBRARY.encode(t or "") + [2]), t.replace("▁", " ") if t else "") for i, t in TEXTS)
    assert sorted((str(r.doc_id), str(r.ids), r.decoded) for r in rows) == want
    back = sentencepiece_spans.decode(spark.createDataFrame(rows), PIECES).collect()
    assert sorted(r.text for r in back) == sorted(w[2] for w in want)
    assert sentencepiece_spans.encode_decode(documents(spark).where("false"), PIECES).count() == 0


def test_prefix_counts_equal_the_library_at_every_prefix():
    counter = token_counts.PrefixCounter(DATA)
    texts = [t for t in some_texts() if len(t) < 80]
    for text, steps in zip(texts, counter.steps_all(texts)):
        assert np.cumsum(steps).tolist() == [len(LIBRARY.encode(text[: k + 1])) for k in range(len(text))]


def test_prefix_table_answers_budgets_and_cuts(spark):
    out = token_counts.prefix_table(documents(spark), PIECES, 10)
    rows = out.collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == sorted((str(i), len((t or "").encode()), len(LIBRARY.encode(t or ""))) for i, t in TEXTS)
    texts = {r.n_chars: t for r in rows for _, t in TEXTS if len(t or "") == r.n_chars}
    cut = token_counts.cut_to(token_counts.tokens_before(out.withColumn("chars", F.lit(7)), "chars"), 25).collect()
    for r in cut:
        t = texts[r.n_chars] or ""
        assert r.tokens == len(LIBRARY.encode(t[:7]))
        within = [k for k in range(min(len(t), 400) + 1) if len(LIBRARY.encode(t[:k])) <= 25]
        assert r.cut == max(within)
    assert token_counts.prefix_table(documents(spark).where("false"), PIECES, 10).count() == 0


def test_byte_ids_equal_the_library():
    library = Tokenizer.from_file(BYTES)
    own = packing.ByteTokens(open(BYTES, "rb").read())
    for t in [*some_texts(), *[x for _, x in TEXTS if x], "a\x85b\x1cc᠎ d  <|endoftext|><|endoftext|> end"]:
        assert own.ids(t).tolist() == library.encode(t, add_special_tokens=False).ids


def brute_fill(counts, capacity, must):
    best = must
    sums = {must}
    for length, c in counts.items():
        for _ in range(c - (length == must)):
            sums |= {s + length for s in sums if s + length <= capacity}
    return max(best, *sums)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 4), min_size=1, max_size=6))
def test_a_window_is_filled_as_far_as_any_multiset_can(counts):
    must = max(counts)
    fill = packing.closest_fill(counts, 24, must)
    assert sum(k * c for k, c in fill.items()) == brute_fill(counts, 24, must)
    assert all(c <= counts[k] for k, c in fill.items()) and fill[must] >= 1
    plan = packing.plan_windows(counts, 24)
    used = {}
    for f, times in plan:
        for k, c in f.items():
            used[k] = used.get(k, 0) + c * times
    assert used == counts


def test_packing_loses_nothing(spark):
    docs = documents(spark)
    packed = packing.pack_documents(docs, BYTES, window=64, keep_ids=True)
    rows = packed.collect()
    library = Tokenizer.from_file(BYTES)
    want = sorted((str(i), [*library.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in TEXTS)
    by_doc = {}
    for r in rows:
        assert len(r.ids) == r.length <= 64 and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        by_doc.setdefault((str(r.doc_id), r.doc_tokens), []).append((r.start, r.ids))
    got = []
    for (doc_id, size), parts in by_doc.items():
        ids = sum([p[1] for p in sorted(parts)], [])
        same = len(ids) // size
        assert len(ids) % size == 0
        got += [(doc_id, size)] * same
    assert sorted(got) == sorted((i, len(w)) for i, w in want)
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(windows) == list(range(len(windows)))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    whole = packing.sequences(packed).collect()
    assert sum(len(r.ids) for r in whole) == sum(r.length for r in rows) and len(whole) == len(windows)
    assert packing.pack_documents(docs.where("false"), BYTES).count() == 0


def test_little_padding(spark):
    rows = queries.QUERIES["op2_packing"](spark, "/root/testdata/sf0.01").groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert sum(1024 - r.n for r in rows) < 0.01 * sum(r.n for r in rows)


def test_codewords_are_distinct_and_far_apart():
    for n in (2, 3, 4, 7, 12, 30):
        words = language_id.codewords(n)
        gaps = [(words[i] != words[j]).sum() for i in range(n) for j in range(i)]
        assert min(gaps) >= 1 if n < 4 else min(gaps) >= 3
        assert len({tuple(c) for c in words.T}) == words.shape[1]


def test_languages_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    found = queries.QUERIES["op5_language"](spark, sf).where("held_out").select("doc_id", "lang_pred", "score")
    both = found.join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in both) >= 0.98 * len(both) > 0
    assert all(0 <= r.score <= 1 for r in both)


def test_language_of_awkward_documents(spark):
    train = spark.createDataFrame([("en", "the and of in that is"), ("de", "der die und das nicht ist"), (None, "xx"), ("fr", None)], "lang string, text string")
    model = language_id.train(train)
    assert model.languages == ["de", "en"]
    rows = language_id.predict(documents(spark), model).collect()
    assert len(rows) == len(TEXTS)
    und = {t for _, t in TEXTS if t is None or not any(c.isalpha() for c in t)}
    assert sum(r.lang_pred == "und" for r in rows) == sum(t in und for _, t in TEXTS)
    assert language_id.train(train.where("false")).predict("words") == ("und", 0.0, 0.0, False)
    assert language_id.train(train.where("lang = 'de'")).predict("words")[0] == "de"
    assert language_id.train(train).predict("zz")[3] in (True, False)


def turns_of(spark):
    rows = [(1, 0, "user", "hi & <|im_end|>\n"), (1, 1, "assistant", "&lt;| <|im_start|>assistant ok"), (1, None, None, None), (1, 1, "assistant", "&lt;| <|im_start|>assistant ok"),
            (None, 0, "a\nb", "x"), (3, 5, "assistant", ""), (2, 0, "assistant", "<"), (2, 1, "user", "|")]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("head", F.lit("extra")).withColumn("start", F.lit(1)), rows


def test_chat_reads_back(spark):
    turns, rows = turns_of(spark)
    out = chat_format.format_turns(turns.withColumn("parts", chat_format.text_part(F.col("text"))))
    got = {r.conv_id: r for r in chat_format.read_back(out).collect()}
    assert set(got) == {1, None, 3, 2}
    for conv, r in got.items():
        mine = sorted([x for x in rows if x[0] == conv], key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        assert [(t.role, t.text) for t in r.turns] == [(x[2] or "", x[3] or "") for x in mine]
        assert r.loss_text == "".join(x[3] or "" for x in mine if x[2] == "assistant")
    assert chat_format.format_turns(turns.where("false").withColumn("parts", chat_format.text_part(F.col("text")))).count() == 0


def test_parts_become_placeholders(spark):
    part = "struct<kind:string,text:string,ref:string,tokens:int>"
    rows = [(1, 0, "user", [("text", "see <|image|> ", None, None), ("image", None, "a.png", 3), ("video", None, "v", 2), ("audio", "t", "b.wav", None), ("document", None, "c.pdf", -1)]), (1, 1, "assistant", None)]
    turns = spark.createDataFrame(rows, f"conv_id bigint, turn bigint, role string, parts array<{part}>")
    r = chat_format.format_turns(turns).first()
    assert r.formatted == "<|im_start|>user\nsee &lt;|image|> <|image|><|image|><|image|><|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    assert [tuple(a) for a in r.attachments] == [(0, "image", "a.png", 3), (0, "audio", "b.wav", 0), (0, "document", "c.pdf", 0)]
    assert [tuple(s) for s in r.loss_spans] == [(len(r.formatted) - len("<|im_end|>\n"), 0)]


def test_chat_digests(spark):
    row = queries.QUERIES["op10_chat"](spark, SF).where("conv_id = -1").first()
    said = "<|im_end|><|im_start|>assistant ok"
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (2, len(said), hashlib.sha256(said.encode()).hexdigest())
    assert row.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
