import hashlib
import random

from pyspark.sql import functions as F

from clausework.llm import simhash as S

SCHEMA = "doc_id long, text string"


def edited(rows):
    """doc_id to (n_chars, edited text) for unique ids."""
    order = sorted(rows)
    out = {}
    for i, (d, t) in enumerate(order):
        t, follows = t or "", order[(i + 1) % len(order)][1] or ""
        k = len(t) // 4
        out[d] = (len(t), t[: len(t) - k] + follows[:k])
    return out


def test_edits_follow_the_next_document_over_all_ranges(spark):
    rng = random.Random(2)
    rows = [(i * 7 - 50, rng.choice([None, "", "é" * rng.randint(1, 9), " ".join(rng.choice(["alpha", "beta", "gamma", "öl"]) for _ in range(rng.randint(1, 60)))])) for i in range(60)]
    expected = edited(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for range_rows in (8192, 7, 1):
        got = {r.doc_id: r for r in S.edited_fingerprints(df, range_rows).collect()}
        assert {d: (r.n_chars, r.edited_sha256) for d, r in got.items()} == {d: (n, hashlib.sha256(t.encode()).hexdigest()) for d, (n, t) in expected.items()}
        order = sorted(expected)
        for i, d in enumerate(order):
            a, b = int(got[d].fingerprint, 16), int(got[order[(i + 1) % len(order)]].fingerprint, 16)
            assert got[d].near_next == 1 - bin(a ^ b).count("1") / 64
            assert got[d].near_edited == 1 - bin(a ^ int(got[d].edited_fingerprint, 16)).count("1") / 64


def test_equal_texts_agree_and_likeness_follows_the_texts(spark):
    rng = random.Random(4)
    voc = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 10))) for _ in range(2000)]
    rows = [(i, " ".join(rng.choice(voc) for _ in range(300))) for i in range(40)] + [(40, "same words here"), (41, "same words here")]
    got = {r.doc_id: r for r in S.edited_fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[40].fingerprint == got[41].fingerprint
    assert sum(got[i].near_edited > got[i].near_next for i in range(40)) >= 38


def test_nulls_repeats_and_empty(spark):
    rows = [(None, "one two three four"), (None, None), (1, "aaaa bbbb"), (1, "aaaa bbbb"), (1, "cccc dddd")]
    got = S.edited_fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 5
    loose = [r for r in got if r.doc_id is None and r.n_chars == 18]
    assert loose[0].edited_sha256 == hashlib.sha256(b"one two three ").hexdigest()
    assert S.edited_fingerprints(spark.createDataFrame([], SCHEMA)).collect() == []
    one = S.edited_fingerprints(spark.createDataFrame([(9, "abcdefgh")], SCHEMA)).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and one[0].near_next == 1.0


def test_block_tables_find_every_fingerprint_within_the_radius(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(30)]
    known = list(base)
    for b in base:
        for k in (1, 2, 3, 4, 5):
            x = b
            for bit in rng.sample(range(64), k):
                x ^= 1 << bit
            known.append(x)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    known += [base[0] ^ (1 << i) ^ (1 << j) for i in range(50, 64) for j in range(40, 50)]  # many in few blocks
    wanted, all_ = spark.createDataFrame([(signed(b),) for b in base], "fp long"), spark.createDataFrame([(signed(k),) for k in known], "fp long")
    expected = sorted({(signed(a), signed(b), bin(a ^ b).count("1")) for a in base for b in known if bin(a ^ b).count("1") <= 3})
    for crowd in (S.CROWD, 20, 1, 0):  # keys as they are, some refined, and all
        assert sorted(tuple(p) for p in S.near_fingerprints(wanted, all_, 3, crowd).collect()) == expected  # each pair once
    everyone = sorted({(signed(a), signed(b)) for a in known for b in known if bin(a ^ b).count("1") <= 2})
    assert sorted((p.fp, p.near) for p in S.near_fingerprints(all_, all_, 2, 10).collect()) == everyone


def test_documents_within_the_radius_against_brute_force(spark):
    rng = random.Random(23)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 12))) for _ in range(300)]
    rows = []
    for d in range(40):
        base = [rng.choice(words) for _ in range(120)]
        rows += [(d * 10 + k, " ".join(base + ["a", "an", "or", "by"][:k])) for k in range(rng.randint(1, 4))]
    rows += [(2000, rows[5][1]), (2001, rows[5][1]), (2002, None), (2003, " "), (None, "only without an id here"), (None, rows[9][1])]
    got = S.edited_fingerprints(spark.createDataFrame(rows, SCHEMA), 50, radius=3).collect()
    assert len(got) == len(rows)
    least = {}
    for r in got:
        least.setdefault(int(r.fingerprint, 16), []).append(r.doc_id)
    for r in got:
        fp = int(r.fingerprint, 16)
        near = [x for x in least if bin(x ^ fp).count("1") <= 3]
        ids = [d for x in near for d in least[x] if d is not None]
        assert (r.n_near, r.least_near) == (len(near) - 1, min(ids, default=None))
    assert any(r.n_near for r in got)
    assert S.edited_fingerprints(spark.createDataFrame([], SCHEMA), radius=3).collect() == []


def test_no_python_in_the_plan(spark):
    df = S.edited_fingerprints(spark.createDataFrame([(1, "a b"), (2, "c")], SCHEMA), radius=3).withColumn("x", F.lit(1))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_ids_that_doubles_cannot_hold(spark):
    for least in (2**60 + 1, -(2**62) + 1):
        rows = [(least + i * 3, f"text{i} of document {i * i} ends here") for i in range(50)]
        expected = edited(rows)
        got = {r.doc_id: r for r in S.edited_fingerprints(spark.createDataFrame(rows, SCHEMA).repartition(4), 7).collect()}
        assert {d: (r.n_chars, r.edited_sha256) for d, r in got.items()} == {d: (n, hashlib.sha256(t.encode()).hexdigest()) for d, (n, t) in expected.items()}
        order = sorted(expected)
        for i, d in enumerate(order):
            a, b = int(got[d].fingerprint, 16), int(got[order[(i + 1) % len(order)]].fingerprint, 16)
            assert got[d].near_next == 1 - bin(a ^ b).count("1") / 64


def test_votes_against_brute_force(spark):
    """Each word's hash votes with the square of its length less two (at most ten) on every bit; a tie is no bit. Long and repeated texts too."""
    import re

    import xxhash

    rng = random.Random(17)
    words = ["".join(rng.choice("abcdéß Ж"[:7]) for _ in range(rng.randint(1, 15))).replace(" ", "x") for _ in range(80)]
    texts = [" ".join(rng.choice(words) for _ in range(n)) for n in (0, 1, 2, 3, 10, 200)] + ["Abc abc\tABC\x0bx", "y " * 50_000, "long" * 20_000, None]
    rows = [(i, t, "more") for i, t in enumerate(texts)] + [(len(texts), texts[4], "more")]

    def plain(text):
        sums = [0] * 64
        for w in re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower()):
            h, n = xxhash.xxh64(w.encode(), seed=42).intdigest(), max(1, (min(len(w), 12) - 2) ** 2)
            for b in range(64):
                sums[b] += n if h >> b & 1 else -n
        return f"{sum(1 << b for b in range(64) if sums[b] > 0):016x}"

    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    got = {r.doc_id: r for r in S.edited_fingerprints(df, range_rows=3).collect()}
    for i, t, _ in rows:
        assert got[i].fingerprint == plain(t), t[:40]
        following = rows[(i + 1) % len(rows)][1] or ""
        cut = len(t or "") // 4
        edited = (t or "")[: len(t or "") - cut] + following[:cut]
        assert got[i].edited_fingerprint == plain(edited) and got[i].n_chars == len(t or "")
