import zlib

import corpus_pipeline as C
from clausework.llm import bpe
from clausework.llm.queries import byte_bpe

SF = "/root/testdata/sf0.001"


def test_stages_keep_their_contract(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    seen = {}
    for name, stage in C.STAGES:
        out = stage(spark, docs, SF)
        if name != "tokens":
            assert out.columns == C.COLUMNS
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs.collect()
    whole = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    kept = {r.doc_id for r in seen["quality"]}
    held = [d for d in labels if zlib.crc32(str(d).encode()) % 3 == 1]
    assert sum((d in kept) == (labels[d] == 1) for d in held) >= 0.9 * len(held)
    assert {r.doc_id for r in seen["lines"]} == kept
    for r in seen["lines"]:
        assert set((r.text or "").split("\n")) <= set(whole[r.doc_id].text.split("\n")) | {""}
    assert {r.doc_id for r in seen["near_duplicates"]} <= kept
    copies = {}
    for r in seen["mix"]:
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert set(copies) <= {r.doc_id for r in seen["near_duplicates"]} and max(copies.values()) <= 2
    c = bpe.codec(*byte_bpe())
    texts = {r.doc_id: r.text for r in seen["mix"]}
    assert len(seen["tokens"]) == len(seen["mix"])
    for r in seen["tokens"][:40]:
        assert c.decode(list(r.token_ids)) == (texts[r.doc_id] or "").encode()


def test_run_applies_the_stages_and_empty_tables_pass(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, "en", None, None), (None, "a b c d e f", "en", "s", 11), (2, "", None, "s", 0), (2, "", None, "s", 0)]
    for name, data in (("some", rows), ("none", [])):
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.createDataFrame([(2, 1)] if data else [], "doc_id long, quality int").write.parquet(str(tmp_path / name / "labels.parquet"))
        got = C.run(spark, str(tmp_path / name)).collect()
        assert (len(got) > 0) == bool(data)


def test_run_equals_plain_versions_of_its_stages(spark, tmp_path):
    """run() over a table with copies, repeated rows, nulls, long texts and further columns, against one plain version of each stage."""
    import math
    import random
    from collections import Counter

    import duckdb
    import numpy as np
    import pandas as pd
    from tiktoken.load import load_tiktoken_bpe

    from clausework.llm import nbsvm, queries

    from . import test_linedup, test_ngram_jaccard

    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    rows = []
    for i in range(150):
        text = prose(rng.randint(3, 120))
        if i % 7 == 3:
            text = " ".join(w.upper() + "!!!" for w in text.split())
        rows.append([i, text + ("\nall rights reserved\n" if i % 3 else "") + prose(4), "en", f"s{i % 13}", 0])
    for i in range(0, 40, 5):
        rows.append([200 + i, rows[i][1] + " tail", "de", "s1", 0])
    rows += [[300, None, "en", "s1", None], [None, prose(30), None, None, 5], [301, "", "fr", "s2", 0], [302, prose(20_000), "en", "s3", 1]] + [[303, "x y z " + vocabulary[0], "en", "s4", 9]] * 3
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(*r, "more", 1.0) for r in rows], schema + ", score string, size double").write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(r[0], int("!!!" not in (r[1] or ""))) for r in rows if r[0] is not None and r[0] < 150]
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    known.write.parquet(str(tmp_path / "labels.parquet"))
    got = C.run(spark, str(tmp_path)).collect()

    # quality: the fitted weights summed over each text's features
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    weights, bias = nbsvm.train_quality(docs, known.where(~nbsvm.held_out()))
    w, kept = np.frombuffer(weights, np.float32).astype(float), []
    for r in rows:
        data = np.frombuffer((r[1] or "").encode(), np.uint8)
        f, _ = nbsvm.features(data, np.array([0, len(data)]))
        if bias + sum(w[x] for x in f) / math.sqrt(max(1, len(f))) >= 0:
            kept.append(r)
    assert {r[0] for r in rows} - {r[0] for r in kept} >= {i for i, q in labels if not q}
    # lines
    lined = test_linedup.brute([(r[0], r[3], r[1]) for r in kept], 10)
    assert sum(x[3] for x in lined) > 50
    texts = Counter((x[0], x[1]) for x in lined)
    source = {r[0]: r[3] for r in kept}
    # near duplicates: the least document of each component stays
    component = test_ngram_jaccard.brute([(d, t) for d, t in texts if d is not None])
    left = [(d, t, source[d]) for (d, t), n in texts.items() for _ in range(n) if d is None or component[d][1] == d]
    assert len(left) < len(kept) - 5
    # mix, by the operator's SQL
    documents = pd.DataFrame({"doc_id": pd.array([d for d, _, _ in left], "Int64"), "text": [t for _, t, _ in left], "source": [s for _, _, s in left]})  # noqa: F841
    copies = Counter()
    for d, n in duckdb.sql(queries.MIX_SQL).df()[["doc_id", "copies"]].itertuples(index=False):
        copies[None if pd.isna(d) else int(d)] += int(n)
    assert Counter(r.doc_id for r in got) == +copies
    # tokens: merges of the lowest rank, one at a time
    path, pattern = byte_bpe()
    ranks = load_tiktoken_bpe(path)
    text_of = {d: t for d, t, _ in left}

    def plain(text):
        import regex

        out = []
        for piece in regex.findall(pattern, text or ""):
            parts = [bytes([b]) for b in piece.encode()]
            while len(parts) > 1:
                rank, at = min((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
                if rank == 1 << 60:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            out += [ranks[p] for p in parts]
        return out

    for r in got:
        if r.doc_id != 302:
            assert list(r.token_ids) == plain(text_of[r.doc_id])
        assert bpe.codec(path, pattern).decode(list(r.token_ids)) == (text_of[r.doc_id] or "").encode()
