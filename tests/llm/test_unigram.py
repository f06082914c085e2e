import random
import time

import public_tokenizers

from reportloom.llm import queries, unigram

PATH = public_tokenizers.path("piece_bpe_32k.model")


def test_trie_equals_the_plain_recurrence():
    rng = random.Random(4)
    model = unigram.pieces(PATH)
    words = {"".join(rng.choice(["a", "th", "ing", "é", "漢", "Z", "9", ".", "\x00", "🙂", "er"]) for _ in range(rng.randint(1, 14))) for _ in range(3000)} | {"x" * 200, "a"}
    counts = unigram.Counts(model)
    coded = {unigram.SPACE + w.encode() for w in words} | {b"", b"\xff\x80"} - {b""}
    assert counts.of(coded) == {w: model.alone(w) for w in coded}


def test_long_words_are_cut_where_no_piece_crosses(monkeypatch):
    rng = random.Random(6)
    model = unigram.pieces(PATH)
    made = ["".join(rng.choice(parts) for _ in range(400)) for parts in (["漢", "字", "的", "是", "。", "日本", "語"], ["a", "th", "ing", "ation", "é", "x", "9"], ["🙂", "а", "б", "при"])]
    for stretch in (unigram.STRETCH, 100):
        monkeypatch.setattr(unigram, "STRETCH", stretch)
        for w in [*made, "y" * 3_000]:
            w = w.encode()
            cut = model.parts(w)
            assert b"".join(cut) == w
            assert unigram.Counts(model).of({w})[w] == model.alone(w)
        assert len(model.parts(made[0].encode())) > 100


def test_a_megabyte_without_blanks_is_counted_by_parts():
    rng = random.Random(9)
    model = unigram.pieces(PATH)
    word = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(350_000)).encode()
    counts = unigram.Counts(model)
    begin = time.perf_counter()
    n = counts.of({word})[word]
    assert time.perf_counter() - begin < 20 and len(word) // 3 <= n <= len(word)
    assert word not in counts.known and max(map(len, counts.known)) <= unigram.TRIE_BYTES


def test_segmentation_equals_the_library():
    from tokenizers import Tokenizer, models

    model = unigram.pieces(PATH)
    text = {p.decode(): s / unigram.FIXED for p, s in model.log.items() if all(b < 128 for b in p) or p.startswith(unigram.SPACE) and all(b < 128 for b in p[3:])}
    text.setdefault("▁", model.log[unigram.SPACE] / unigram.FIXED)
    t = Tokenizer(models.Unigram([("<unk>", -1e9), *text.items()], 0, False))
    words = ["▁the", "▁internationalisation", "▁aaaaab", "▁Oregon", "▁x1y2", "▁running."]
    assert [len(t.encode(w).ids) for w in words] == [model.alone(w.encode()) for w in words]


def test_counts_of_texts(spark):
    texts = [None, "", " \n\t ", "the end", "the the\nend", "long " * 50_000, "the end"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, N_TOKENS int")
    model = unigram.pieces(PATH)
    out = unigram.count_tokens(df, PATH)
    assert out.columns == ["doc_id", "text", "n_words", "n_tokens"]
    want = [(i, len((t or "").split()), sum(model.alone(unigram.SPACE + w.encode()) for w in set((t or "").split()) for _ in range((t or "").split().count(w)))) for i, t in enumerate(texts)]
    assert sorted((r.doc_id, r.n_words, r.n_tokens) for r in out.collect()) == want
    assert unigram.count_tokens(df.limit(0), PATH).count() == 0


def test_query_equals_the_plain_recurrence(spark):
    sf = "/root/testdata/sf0.001"
    model, known = unigram.pieces(PATH), {}

    def tokens(w):
        if w not in known:
            known[w] = model.alone(unigram.SPACE + w.encode())
        return known[w]

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r.doc_id, len((r.text or "").split()), sum(map(tokens, (r.text or "").split()))) for r in docs)
    assert sorted((r.doc_id, r.n_words, r.n_tokens) for r in queries.op7_token_counts(spark, sf).collect()) == want
