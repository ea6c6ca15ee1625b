import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from clausework.llm import prefixtrie, scan
from clausework.llm.cluster import prepared

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), T.StructField("d", T.StringType()), T.StructField("m", T.LongType())])


def brute(rows):
    convs = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            convs[conv].append(((turn is not None, turn or 0), (role or "").encode(), (text or "").encode()))
    for turns in convs.values():
        turns.sort()
    plain = {c: [t[1:] for t in turns] for c, turns in convs.items()}
    built = {}
    for c, own in plain.items():
        base, h = c - int(abs(c) % 5) * (1 if c > 0 else -1), zlib.crc32(str(c).encode()) % 9
        built[c] = plain.get(base, [])[:h] + own[h:]
    members = defaultdict(set)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        saved[node] = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0) + sum(saved[x] for x in children[node])
    out = []
    for node, of in members.items():
        ends = ",".join(str(c) for c in sorted(of) if len(built[c]) == len(node))
        out.append((min(of), len(node), min(members[node[:-1]]) if node else None, len(of), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def trie(spark, rows):
    frame = prepared(spark).createDataFrame(rows, SCHEMA)
    return sorted((tuple(r) for r in prefixtrie.conversation_trie(frame).collect()), key=lambda r: r[:2])


def some(seed, n, words=3):
    r = random.Random(seed)
    rows = []
    for c in range(-7, n):
        for t in range(r.choice([1, 2, 3, 4, 9, 12])):
            rows.append((c, r.choice([t, t, t, None, 2]), r.choice(["user", "assistant", None]), r.choice(["a", "aé", None, "b" * 50][:words]), "x", 1))
    for c in (10, 11, 12, 13, 14, 20, 21):
        rows += [(c, 100 + t, "user", f"turn {t}", None, None) for t in range(40)]
    rows += rows[:5] + [(None, 1, "user", "nobody", None, None)]
    return rows


@pytest.mark.parametrize("hot", [None, 3])
def test_equals_brute_force(spark, monkeypatch, hot):
    if hot:  # joins by hot keys instead of whole broadcasts
        monkeypatch.setattr(scan, "HOT_ROWS", hot)
        monkeypatch.setattr(scan, "maybe_broadcast", lambda df, *_: df)
    rows = some(1, 60)
    assert trie(spark, rows) == brute(rows)


def test_one_long_conversation_over_all_ranges(spark):
    rows = [(5, t, "user", f"t{t}", None, None) for t in range(3000)] + [(6, t, "user", f"t{t}", None, None) for t in range(2990)] + [(2, 0, "user", "t0", None, None)]
    assert trie(spark, rows) == brute(rows)


def test_many_copies_and_a_short_list_part(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "PART_IDS", 7)
    rows = [(5 * c, t, "user", "same", None, None) for c in range(200) for t in range(2)] + some(3, 20)
    assert trie(spark, rows) == brute(rows)


def test_absent_bases_and_turnless(spark):
    rows = [(c, 0, "user", "only", None, None) for c in range(1, 40) if c % 5]
    got = trie(spark, rows)
    assert got == brute(rows) and any(r[1] == 0 for r in got)


def test_empty_table_and_no_ids(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 1, "user", "x", None, None)]) == []
