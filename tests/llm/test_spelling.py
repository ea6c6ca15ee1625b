import random
import re
import zlib
from collections import Counter

import pytest

from clausework.llm import spelling
from clausework.llm.cluster import prepared


def brute(docs):
    counts = Counter()
    for doc, text, *_ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    out, forms = {}, {}
    for w, n in words.items():
        of = [x for x in words if near(w, x)]
        best = min(of, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] < 5 * n:
            best = None
        forms[w] = best
        out[w] = [n, len(of), words.get(best)]
    rows = []
    for w, (n, k, m) in out.items():
        root = w
        while forms[root]:
            root = forms[root]
        rows.append((w, forms[w], root, n, k, m))
    return sorted(rows)


def groups(spark, docs):
    frame = prepared(spark).createDataFrame(docs, "doc_id long, text string, word string, n int")
    return sorted(tuple(r) for r in spelling.spelling_groups(frame).collect())


def test_equals_brute_force(spark):
    r = random.Random(4)
    stems = ["letter", "aaaaaaa", "größeren", "wörterbuch", "abcdefgh", "ÀÉÎÕÜß"]
    words = set(stems)
    for w in list(stems):
        for _ in range(40):
            i, c = r.randrange(len(w) + 1), r.choice("abcdeéü")
            words.add(r.choice([w[:i] + c + w[i:], w[:i] + c + w[i + 1 :], w[:i] + w[i + 1 :]]))
    words = sorted(words)
    weights = [1000 if w in stems else r.choice([1, 3, 20, 100]) for w in words]
    docs = [(i, " ".join(x.upper() if r.random() < 0.1 else x for x in r.choices(words, weights, k=r.choice([0, 5, 400]))) + r.choice(["", " 12_a-b", "\n×÷ſ"]), "w", 1) for i in range(60)]
    docs += [(None, "letter " * 30, None, None), (3, None, None, None), (4, "", None, None), docs[0], docs[0]]
    got = groups(spark, docs)
    assert got == brute(docs) and sum(x[1] is not None for x in got) > 20 and any(x[1] != x[2] for x in got if x[1])


def test_chain_ties_and_repeats(spark):
    chain = ["lettera", "letterab", "letterabc", "letterabcd"]
    docs = [(i, " ".join([w] * 5 ** (k + 1)), None, None) for k, w in enumerate(chain) for i in [k]]
    docs += [(10, "baaaaaa " * 40 + "caaaaaa " * 40 + "aaaaaaa " * 5, None, None)]
    assert groups(spark, docs) == brute(docs)


def test_very_long_words_and_texts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE_CHARS", 50)
    docs = [(1, ("x" * 30_000 + " ") * 6 + ("x" * 29_999 + " ") * 40, None, None), (2, "Hallöchen, " * 500, None, None)]
    got = groups(spark, docs)
    assert got == [("hallöchen", None, "hallöchen", 500, 0, None), ("x" * 29_999, None, "x" * 29_999, 40, 1, None), ("x" * 30_000, "x" * 29_999, "x" * 29_999, 6, 1, 40)]


@pytest.mark.parametrize("docs", [[], [(None, None, None, None)], [(1, "few words here", "x", 2)]])
def test_empty(spark, docs):
    assert groups(spark, docs) == []
