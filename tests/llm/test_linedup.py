from clausework.llm import linedup as L

SCHEMA = "doc_id long, source string, text string"


def brute(rows, min_sites):
    spread, least = {}, {}
    for d, s, t in rows:
        for line in (t or "").split("\n"):
            line = line.strip(" \t\r\x0b\x0c")
            if line:
                spread.setdefault(line, set()).add(s or "")
                least[line] = min(least.get(line, 1 << 62), -(1 << 63) if d is None else d)
    out = []
    for d, _, t in rows:
        if t is None:
            out.append((d, None, 0, 0))
            continue
        lines = t.split("\n")
        kept = []
        for x in lines:
            body = x.strip(" \t\r\x0b\x0c")
            if not (body and len(spread[body]) >= min_sites and least[body] != (-(1 << 63) if d is None else d)):
                kept.append(x)
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    rows = [(i, f"s{i % 23}", f"own {i}\nboiler  \n\tboiler\n\npart {i % 12 if i % 23 < 9 else -i}") for i in range(200)]
    rows += [(500, None, "boiler"), (None, "s1", "boiler\nx"), (501, "s2", None), (502, "s3", ""), (503, "s4", "\n".join(["boiler"] * 4000)), (7, "s7", rows[7][2])]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", n_removed int").repartition(6)
    for least in (2, 9, 10, 24):
        got = L.drop_boilerplate(df, min_sites=least).collect()
        assert sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got), key=str) == brute(rows, least)


def test_sketches_decide_far_lines_and_counts_near_ones(spark):
    rows = [(i, f"s{i}", "far" + ("\nnear" if i < 10 else "") + ("\nbelow" if i < 9 else "")) for i in range(60)]
    got = {r.exact: r.sites for r in L.line_spread(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[True] == 10 and abs(got[False] - 60) <= 3


def test_empty(spark):
    assert L.drop_boilerplate(spark.createDataFrame([], SCHEMA)).collect() == []
