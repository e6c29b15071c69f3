"""Small inputs with every awkward case, and plain Python versions of the operators."""

from __future__ import annotations

import re
from collections import defaultdict

SF = "/root/testdata/sf0.001"
#: Thai, Lao, Burmese, Khmer, kana and ideographs: scripts without blanks between words.
WIDE = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3134F)]
#: Names that operators use inside, as extra columns of the input.
CLASHING = "row key n n_tokens part nth start length cell range border h1 h2 place leaf text_key bits ids rank tokens lang_pred component".split()

LONG = " ".join(f"w{i % 911}x{i % 37}" for i in range(30_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog. It barks."),
    (2, None),
    (3, ""),
    (4, "The quick brown fox jumps over the lazy dog. It barks."),
    (4, "The quick brown fox jumps over the lazy dog. It barks."),
    (None, "No id here, but a text of several words."),
    (5, " \n\t "),
    (6, "12345 !!! ..."),
    (7, "ÄÖÜ ß 日本語 𝄞 naïve\ncafé <|endoftext|> ▁x"),
    (8, LONG),
    (9, LONG + " changed"),
    (10, "one two"),
    (11, "one two"),
    (4, "Another text under an id that is there already."),
]


def documents(spark, rows=TEXTS):
    """The rows as documents with clashing extra columns."""
    df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id bigint, text string")
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("extra").alias(c) for c in CLASHING], F.lit(None).cast("string").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("bigint").alias("n_chars"))


def shingles(text: str | None) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def linked(rows) -> list[tuple]:
    """(doc_id, set size, smallest reachable id) of every row, by comparing all pairs of sets."""
    sets = [shingles(t) for _, t in rows]
    lead = list(range(len(rows)))

    def top(i):
        while lead[i] != i:
            i = lead[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            k = len(a & b)
            if a and b and 100 * k >= 80 * (len(a) + len(b) - k):
                lead[top(i)] = top(j)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        ids[top(i)].append(doc_id)
    least = {r: min((x for x in v if x is not None), default=None) for r, v in ids.items()}
    return sorted(((d, len(sets[i]), least[top(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def repeats(rows, min_words: int) -> list[tuple]:
    """(doc_id, start, length, units, words) of the runs to take out, from rows with unique ids: word by word, without patterns."""
    blank = lambda c: c.isspace() and c != "\n"
    end = lambda c: c in ".!?;|\n。！？｡؟।॥…、，"
    wide = lambda c: any(a <= ord(c) <= b for a, b in WIDE)
    seen, out = set(), []
    for doc_id, text in sorted(r for r in rows if r[1]):
        n, at, units = len(text), 0, []

        def skip(i, test, most=None):
            j = i
            while j < n and test(text[j]) and (most is None or j - i < most):
                j += 1
            return j

        while at < n:
            start, at, said = at, skip(at, blank), []
            while True:
                stop = skip(at, wide, 24)
                if stop == at:
                    stop = skip(at, lambda c: not (blank(c) or end(c) or wide(c)))
                    after = skip(stop, blank)
                    if at < stop < after and stop - at <= 8 and text[stop - 1] not in "37" and len(said) < 11:
                        said.append(text[at:stop].lower())
                        at = after
                        continue
                if stop > at:
                    said.append(text[at:stop].lower())
                at = skip(stop, lambda c: blank(c) or end(c))
                break
            if said:
                units.append((start, at, len(said) + sum(map(wide, "".join(said))) // 2, " ".join(said)))
        run = []

        def close():
            if run and sum(u[2] for u in run) >= min_words:
                out.append((doc_id, run[0][0], run[-1][1] - run[0][0], len(run), sum(u[2] for u in run)))
            run.clear()

        for one, two in zip(units, units[1:]):
            if (one[3], two[3]) in seen:
                run.extend([two] if run else [one, two])
            else:
                close()
                seen.add((one[3], two[3]))
        close()
    return sorted(out)
