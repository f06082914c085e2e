import random
import re

import numpy as np
import pytest

from reportloom.llm import decontaminate as d


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, width=10):
    """``(n_words, hit words, items)`` of each text by comparing windows at every place."""
    windows = {}
    for item, text in items:
        ws = words_of(text)
        n = min(width, len(ws))
        for i in range(len(ws) - n + 1 if n else 0):
            windows.setdefault(tuple(ws[i : i + n]), set()).add("" if item is None else str(item))
    lengths = {len(w) for w in windows}
    out = []
    for text in docs:
        ws, hit, found = words_of(text), set(), set()
        for n in lengths:
            for i in range(len(ws) - n + 1):
                if own := windows.get(tuple(ws[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= own
        out.append((len(ws), sorted(hit), sorted(found)))
    return out


def check(rows, docs, items, width):
    got = [(r.n_words, sorted(w for s in r.spans for w in range(s["first"], s["last"])), r["items"]) for r in rows]
    assert got == brute(docs, items, width)
    for r, text in zip(rows, docs, strict=True):
        assert r.n_hit == sum(s["last"] - s["first"] for s in r.spans)
        for s in r.spans:  # the code points of a span hold just its words
            assert words_of((text or "")[s["start"] : s["end"]]) == words_of(text)[s["first"] : s["last"]]


def test_suffixes_and_index():
    rng = np.random.default_rng(5)
    for size, symbols in ((1, 2), (30, 3), (400, 4), (3_000, 50)):
        words = rng.integers(0, symbols, size)
        words[-1] = 0
        if size == 400:
            words[:-1] = np.tile(words[:21], 19)
        number = np.where(words == 0, -size + np.arange(size), words)  # separators differ, earlier ones are less
        order = d.suffixes(words)
        assert order.tolist() == sorted(range(size), key=lambda i: number[i:].tolist())
        index = d.FMIndex(words, symbols)
        inside = np.flatnonzero(words[order] > 0)
        assert index.locate(inside).tolist() == order[inside].tolist()
        ends = rng.integers(0, size + 1, 20)
        wanted = rng.integers(0, symbols, 20)
        bwt = words[order - 1]
        assert index.wavelet.rank(wanted, ends)[0].tolist() == [int((bwt[:e] == w).sum()) for e, w in zip(ends, wanted, strict=True)]


@pytest.mark.parametrize("shard", [7, 1 << 19])
def test_random_texts(monkeypatch, shard):
    monkeypatch.setattr(d, "SHARD", shard)
    rng = random.Random(3)
    for width in (2, 4):
        say = lambda n: " ".join(rng.choice(["a", "b", "É1", "z"]) for _ in range(n))  # noqa: E731, B023
        items = [(i, say(rng.randint(1, 8))) for i in range(12)]
        docs = [say(rng.randint(0, 60)).replace("z", rng.choice(["z", "q!"])) for _ in range(60)]
        split = [(str(i), " ".join(words_of(t)).encode()) for i, t in items]
        phrases = d.Phrases(split, width)
        empty = d.pa.array([[]] * len(docs), d._ARROW[2]), d.pa.array([[]] * len(docs), d._ARROW[3])
        columns = d._judged(d.pa.array(docs), *empty, phrases)
        from pyspark.sql import Row

        check([Row(n_words=a, n_hit=b, spans=c, items=e) for a, b, c, e in zip(*(x.to_pylist() for x in columns), strict=True)], docs, items, width)


def test_rows(spark, monkeypatch):
    passage = "The quick, brown fox; jumps over THE lazy dog and then sleeps for two hours"
    texts = ["nothing", None, "", passage, f"é… {passage} and {passage}!", "quick brown " * 3_000 + passage, "Ünder Ä five", "under ä five", *["copy of " + passage] * 3, "the quick brown fox jumps over the lazy dog and"]
    items = [(2, passage), (10, "Before. " + passage), (2, passage), (3, None), (4, ""), (5, "?!"), (6, "Ä five"), (None, "two hours"), (7, "x y z " * 40)]
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(texts)], "doc_id long, text string, Items string, `a.b` int")
    bench = spark.createDataFrame([(*x, "other") for x in items], "item_id long, text string, doc_id string")
    found = d.find(docs, bench)
    assert found.columns == ["doc_id", "text", "a.b", "n_words", "n_hit", "spans", "items"]
    rows = found.orderBy("doc_id").collect()
    check(rows, texts, items, 10)
    clean = [r[0] for r in found.orderBy("doc_id").select(d.cleaned(found)).collect()]
    assert clean[:5] == ["nothing", None, "", "", "é…  and !"] and clean[6] == "Ünder Ä five".replace("Ä five", "")
    assert rows[3].n_hit == 15 and rows[11]["items"] == ["10", "2"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    # a benchmark beyond one broadcast: a pass for each piece adds to the last
    monkeypatch.setattr(d, "PIECE_BYTES", 150)
    monkeypatch.setattr(d, "SEGMENT", 5)
    assert sorted(d.find(docs, bench).collect(), key=str) == sorted(rows, key=str)


def test_empty_tables_and_names(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, body string")
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert [tuple(r) for r in d.find(docs, bench.limit(0), text="body").collect()] == [(1, "a b c", 3, 0, [], [])]
    assert d.find(docs.limit(0), bench, text="body").count() == 0
    assert d.find(docs, bench, text="body", keep_text=False).first().n_hit == 2
    with pytest.raises(ValueError):
        d.find(docs.withColumnRenamed("body", "Items"), bench, text="Items")
