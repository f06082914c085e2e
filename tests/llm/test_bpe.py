import hashlib
import random
import time

import public_tokenizers
from pyspark.sql import functions as F

from reportloom.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


def reference(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    ids = [t.encode(x or "", add_special_tokens=False).ids for x in texts]
    return ids, [t.decode(i, skip_special_tokens=False) for i in ids]


def test_joined_chunks_equal_whole_text():
    c = bpe.codec(PATH)
    rng = random.Random(5)
    parts = ["a", "b", " ", "  ", "\n", "\t", " ", "'", "'s", "'re", "'ll", "9", "12", "!", "?!", "é", "漢", "‍", " the", "ing"]
    for _ in range(1500):
        s = "".join(rng.choice(parts) for _ in range(rng.randint(2, 70)))
        at = sorted(rng.sample(range(1, len(s)), min(len(s) - 1, rng.randint(1, 4)))) if len(s) > 1 else []
        chunks = [s[i:j] for i, j in zip([0, *at], [*at, len(s)], strict=True)]
        assert c.joined(chunks, [c.plain(x) for x in chunks]).tolist() == c.plain(s).tolist(), chunks


def test_unbroken_text_is_linear():
    """Letters without a break, and then some: as fast in chunks as in one go, but for a factor."""
    c = bpe.codec(PATH)
    rng = random.Random(3)
    for text in ("".join(rng.choices("abcdefghij", k=2_000_000)), ("".join(rng.choices("abc", k=30_000)) + " and ,") * 20, "漢字" * 20_000 + "。" + "語" * 40_000, "x" * 60_000 + "!" * 60_000 + " " * 60_000):
        begin = time.perf_counter()
        whole = c.plain(text)
        once = time.perf_counter() - begin
        data = text.encode()
        ends = bpe.cuts(data)
        chunks = [data[i:j].decode() for i, j in zip([0, *ends], ends, strict=False)]
        assert len(text) < 10**6 or len(chunks) > 500
        begin = time.perf_counter()
        ids = [c.plain(x) for x in chunks]
        assert c.joined(chunks, ids).tolist() == whole.tolist()
        assert time.perf_counter() - begin < 4 * once + 1


def test_cuts_follow_content():
    rng = random.Random(1)
    body = "".join(rng.choice("abcdefg hij\n") for _ in range(60_000))
    a, b = bpe.cuts(body.encode()), bpe.cuts(("some other beginning " * 40 + body).encode())
    assert len(a) > 20 and len({len(body) - x for x in a} & {len(body) + 840 - x for x in b}) > len(a) * 0.7
    assert bpe.cuts(b"") == [0] and bpe.cuts("é".encode() * 40_000)[-1] == 80_000
    assert all(x % 2 == 0 for x in bpe.cuts("é".encode() * 40_000))


def test_encode_equals_the_library(spark, monkeypatch):
    rng = random.Random(2)
    words = ["alpha", "beta,", "don't", "we're", "12,000", "naïve", "漢字", "🙂", "\n\n", "x  y", "ing"]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    shared = " ".join(rng.choice(words) for _ in range(2_000))
    texts = [None, "", " ", "\n", "a", long, long, shared + "tail", "head" + shared, "x" * 70_000, "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "\x00\x1c odd", "'" * 50, " " * 3_000 + "end"]
    rows = [(i, t, "k") for i, t in enumerate(texts)] + [(3, "again", "k"), (3, "again", "k"), (None, "no id", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, IDS string")
    monkeypatch.setattr(bpe, "SHARERS", 2)
    monkeypatch.setattr(bpe, "HEAVY", 20)
    df = df.union(spark.createDataFrame([(100 + i, shared + f" number {i}", "x") for i in range(40)], df.schema))
    rows += [(100 + i, shared + f" number {i}", "x") for i in range(40)]
    out = bpe.decode(bpe.encode(df, PATH), PATH)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    got = sorted((str(r.doc_id), r.text or "", bpe.ids_of(r.ids), r.decoded) for r in out.collect())
    ids, back = reference([t for _, t, _ in rows])
    assert got == sorted((str(i), t or "", x, d) for (i, t, _), x, d in zip(rows, ids, back, strict=True))
    assert bpe.encode(df.limit(0), PATH).count() == 0


def test_decode_skips_unknown_ids_and_replaces_broken_bytes(spark):
    import numpy as np

    c = bpe.codec(PATH)
    broken = c.plain("é")[:1] if len(c.plain("é")) > 1 else c.plain("漢")[:1]
    df = spark.createDataFrame([(np.r_[c.plain("ab"), 70_000].astype("<u4").tobytes(),), (broken.astype("<u4").tobytes(),), (None,)], "ids binary")
    assert [r.decoded for r in bpe.decode(df, PATH).collect()][::2] == ["ab", ""]


def test_query_against_the_library(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op1_bpe(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    ids, back = reference([d.text for d in docs])
    import numpy as np

    assert len(got) == len(docs)
    for d, i, b in zip(docs, ids, back, strict=True):
        r = got[d.doc_id]
        assert r.n_tokens == len(i)
        assert r.ids_sha256 == hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(b.encode()).hexdigest()


def test_decoding_in_the_same_pass(spark):
    df = spark.createDataFrame([(1, "one <|endoftext|> two", "old"), (2, None, None), (3, "é" * 5_000, "x")], "doc_id long, text string, back string")
    one = bpe.encode(df, PATH, decoded="back", keep_text=False)
    assert one.columns == ["doc_id", "ids", "back"]
    assert sorted(tuple(r) for r in one.collect()) == sorted(tuple(r) for r in bpe.decode(bpe.encode(df.drop("back"), PATH).drop("text"), PATH, to="back").collect())
