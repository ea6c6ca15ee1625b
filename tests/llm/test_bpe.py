import hashlib

import public_tokenizers as P

from clausework.llm import bpe

SCHEMA = "doc_id long, text string"
FILE, PATTERN = P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN


def test_pieces_join_and_do_not_change_ids():
    c = bpe.codec(FILE, PATTERN)
    for text in ("a b  c\n\nd 's 12,5 — ü x \t y" * 40, " " * 300, "x" * 500, "né " * 200 + "\n" * 50 + "end", "a b c\x1cd e"):
        for size in (1, 7, 64):
            parts = list(bpe.pieces(text, size))
            assert "".join(parts) == text
            assert [i for p in parts for i in c.encoding.encode_ordinary(p)] == c.encoding.encode_ordinary(text)


def test_round_trip_digests_and_edges(spark):
    texts = ["Zu und. Dieüauß der.", None, "", "<|endoftext|> \x00� 😀", "word " * 30_000, "x" * 20_000, "a", "a"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "é", 2)], SCHEMA + ", n_tokens int")
    c = bpe.codec(FILE, PATTERN)
    got = bpe.bpe_digests(df, FILE, PATTERN).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        text = "é" if r.doc_id is None else texts[r.doc_id] or ""
        ids = c.encoding.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    both = bpe.bpe_decode(bpe.bpe_encode(df, FILE, PATTERN), FILE, PATTERN).collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in both)
    assert bpe.bpe_digests(spark.createDataFrame([], SCHEMA), FILE, PATTERN).collect() == []
