import hashlib
import random

import pytest
from pyspark.sql import functions as F
from test_bpe import reference
from test_classifiers import plain_words, small
from test_jaccard import brute as classes_of
from test_line_dedup import brute as lines_of
from test_mixing import poisson_count

import corpus_pipeline
from reportloom.llm import bpe, common, components, toxicity
from reportloom.llm.common import read_table
from reportloom.llm.queries import LINE_PAGES, LINE_RATIO, MIX_SEED, MIX_TEMPERATURE

SF = "/root/testdata/sf0.01"
STAGES = dict(corpus_pipeline.STAGES)


def test_stages(spark):
    docs = read_table(spark, SF, "documents")
    names, counts = docs.columns, [docs.count()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_join", "mixing", "bpe"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == names
        docs = out.cache()
        counts.append(docs.count())
    labels = read_table(spark, SF, "labels")
    toxic, clean = labels.where("toxic = 1"), labels.where("toxic = 0")
    kept = corpus_pipeline.without_toxic(spark, read_table(spark, SF, "documents"), SF).cache()
    assert kept.join(toxic, "doc_id").count() <= 0.1 * toxic.count()
    assert kept.join(clean, "doc_id").count() >= 0.99 * clean.count()
    assert counts[2] == counts[1] and counts[3] < counts[2]
    last = corpus_pipeline.encoded(spark, docs, SF)
    assert last.count() == counts[4]
    row = last.first()
    assert len(bpe.ids_of(row.ids)) == row.n_tokens
    assert bpe.decode(last.limit(20), corpus_pipeline.vocabulary()).where("decoded <> text").count() == 0


def fixture(spark, path, seed):
    """Documents and labels with toxic words, shared lines, near copies, nulls, repeats and odd columns."""
    rng = random.Random(seed)
    texts, labels = small()
    rows = []
    for i, (_, t) in enumerate(texts):
        body = " ".join(rng.choice(["ash", "birch", "cedar", "dogwood", "elm", "fir", "gum", "hazel"]) + str(rng.randrange(60)) for _ in range(30))
        rows.append((i, f"{t}\nhome about contact\n{body}", ("en", "de")[i % 2], f"s{i % 3}"))
    rows += [(500 + i, rows[7 + 2 * (i % 4)][1] + (" end" if i % 2 else ""), "en", "s1") for i in range(30)]
    rows += [(600, None, "en", "s0"), (601, "", None, None), (602, " \n ", "en", "s1"), (603, "word " * 40_000, "de", None)]
    rows = [(*r, None if r[1] is None else len(r[1]), i, i, i, f"c{i}", i) for i, r in enumerate(rows)]
    fields = "doc_id long, text string, lang string, source string, n_chars long, copy int, toxic int, n_lines int, `a.b` string, carried int"
    docs = spark.createDataFrame([*rows, rows[3], rows[3]], fields).repartition(3)
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(int(i[2:]), q, t) for i, q, t in labels], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return spark.read.parquet(f"{path}/documents.parquet")


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_every_stage_equals_a_plain_version(spark, tmp_path):
    """Each stage is judged on its own input; clashing, dotted and unread columns come through it."""
    docs = fixture(spark, tmp_path, 5)
    names = docs.columns
    rows = collected(docs)
    at = {c: i for i, c in enumerate(names)}

    chain = toxicity.fit(docs, toxicity.categories_of(read_table(spark, str(tmp_path), "labels")), toxicity.CATEGORIES)
    import numpy as np

    def toxic(t):
        held = plain_words(t or "")
        x = np.array([[float(f in held) for f in chain.features]])
        return chain.probabilities(x)[0, 1] >= 0.5

    out = STAGES["toxicity"](spark, docs, str(tmp_path))
    want = [r for r in rows if not toxic(r[1])]
    assert out.columns == names and collected(out) == want and 0 < len(rows) - len(want) < len(rows) / 2

    out = STAGES["line_dedup"](spark, docs, str(tmp_path))
    one = {}
    hosts = [(k, r[at["source"]], r[1]) for k, r in enumerate(rows)]
    # a line goes if it is boilerplate of the source, or of the source in its language
    for part in (lambda r: r[at["source"]], lambda r: (r[at["source"]], r[at["lang"]])):
        for k, _, t, _, _ in lines_of([(k, str(part(r)), r[1]) for k, r in enumerate(rows)], LINE_RATIO, LINE_PAGES, True):
            one.setdefault(int(k), []).append(t)
    def both(k, t):
        if t is None:
            return None
        left = [x.split("\n") for x in one[k]]
        return "\n".join(x for x in t.split("\n") if x.strip(" \t\r") == "" or all(x in y for y in left))

    want = sorted((tuple([r[0], (t := both(k, r[1])), *r[2:4], None if t is None else len(t), *r[5:]]) for k, r in enumerate(rows)), key=str)
    assert out.columns == names and collected(out) == want and any(w[1] != r[1] for w, r in zip(want, rows, strict=True)) and len(hosts) == len(want)

    out = STAGES["ngram_join"](spark, docs, str(tmp_path))
    single = {r[0]: r for r in rows}
    least = classes_of([(k, r[1]) for k, r in single.items()], 5, 80)
    want = sorted((r for k, r in single.items() if least[k][1] == k), key=str)
    assert out.columns == names and collected(out) == want and len(want) < len(single)

    out = STAGES["mixing"](spark, docs, str(tmp_path))
    n = {s: sum(r[at["source"]] == s for r in rows) for s in {r[at["source"]] for r in rows}}
    total = sum(c**MIX_TEMPERATURE for c in n.values())
    want = []
    for r in rows:
        u = int(hashlib.md5(f"{MIX_SEED}:{r[0]}".encode()).hexdigest()[:13], 16) / 2**52
        s = r[at["source"]]
        want += [r] * poisson_count(n[s] ** MIX_TEMPERATURE * len(rows) / total / n[s], u)
    assert out.columns == names and collected(out) == sorted(want, key=str)

    out = STAGES["bpe"](spark, docs, str(tmp_path))
    ids, back = reference([r[1] for r in rows])
    want = {(r[0], r[at["copy"]]): (i, hashlib.sha256(b.encode()).hexdigest()) for r, i, b in zip(rows, ids, back, strict=True)}
    assert out.columns == [*names, "ids", "n_tokens", "decoded_sha256"] and out.count() == len(rows)
    assert all((bpe.ids_of(r["ids"]), r["decoded_sha256"]) == want[r["doc_id"], r["copy"]] and r["n_tokens"] == len(want[r["doc_id"], r["copy"]][0]) for r in out.collect())


def test_runs_of_stages_leave_no_tables(spark, tmp_path):
    docs = fixture(spark, tmp_path, 6)
    root = common.shared_dir(spark).removeprefix("file:").replace("///", "/")
    import os

    held = set(os.listdir(f"{root}/reportloom")) if os.path.isdir(f"{root}/reportloom") else set()
    with common.scratch(spark):
        out = corpus_pipeline.run(spark, str(tmp_path))
        assert 0 < out.count() <= 2 * docs.count()
    left = set(os.listdir(f"{root}/reportloom")) - held
    assert len(left) == 1 and left.pop().startswith("pipeline-mixing-")


@pytest.mark.parametrize("name", list(STAGES))
def test_empty_tables_pass_through(spark, tmp_path, name):
    docs = fixture(spark, tmp_path, 7)
    assert STAGES[name](spark, docs.limit(0), str(tmp_path)).count() == 0


def test_ids_give_back_the_text(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    out = corpus_pipeline.encoded(spark, docs, "/root/testdata/sf0.001")
    assert out.columns == [*docs.columns, "ids", "n_tokens", "decoded_sha256"]
    rows = out.select("text", "decoded_sha256").collect()
    assert len(rows) == docs.count() and all(hashlib.sha256((r.text or "").encode()).hexdigest() == r.decoded_sha256 for r in rows)


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(5, 5), (None, 3), (2, 1), (1, 2)] + [(999, i) for i in range(900, 960)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 40)} | {1: 1, 2: 1} | {i: 900 for i in [999, *range(900, 960)]}
    assert got == want
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hubs_meet_their_minimum_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(components, "HEAVY", 5)
    edges = [(0, i) for i in range(1, 300)] + [(i, 1000 + i) for i in range(1, 300, 3)] + [(5000, i) for i in range(1000, 1300)] + [(7000, 7001)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long").withColumn("c", F.lit(1))).collect()}
    assert set(got.values()) == {0, 7000} and got[7001] == 7000 and got[1299] == 0
