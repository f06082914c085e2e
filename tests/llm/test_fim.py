import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from reportloom.llm import fim


def plain(doc_id, text):
    """The transformation by a token pattern instead of code points."""
    text = text or ""
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, c, d = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(tokens)
    if not text or re.search("<[PSM]>", text) or c % 100 >= 90:
        return n, "plain", None, None, text
    lo, hi = sorted((a % (n + 1), b % (n + 1)))
    p, m, s = ("".join(x) for x in (tokens[:lo], tokens[lo:hi], tokens[hi:]))
    if d % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aZ<>PSM é\n𝒳@[`{", max_size=40), st.integers(0, 10_000))
def test_transform_equals_the_token_pattern(text, doc_id):
    got = fim.transform(text, f"1:{doc_id}")
    assert got == plain(doc_id, text)
    assert fim.restore(got[4], got[1]) == text


def test_rows(spark):
    long = "Mixed 12 ünïcode 𝒳 words\r\n" * 20_000
    rows = [(i, t) for i, t in enumerate(["plain words here", None, "", "a", "<P>x", "no letters: 1 2 3", "<", "é" * 50, long, "same", "same"])]
    rows += [(3, "a"), (3, "a"), (None, "no id"), *[(i, "one two three four") for i in range(100, 160)]]
    df = spark.createDataFrame([(*r, "kept", 7, "x") for r in rows], "doc_id long, text string, `out.put` string, N int, seed_ string")
    got = fim.fill_in_middle(df)
    assert got.columns == ["doc_id", "text", "out.put", "seed_", "n", "form", "prefix_chars", "middle_chars", "output"]
    back = fim.restored(got).collect()
    assert sorted(((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in back), key=str) == sorted(((i, t, *plain(i, t)) for i, t in rows), key=str)
    assert all(r.restored == (r.text or "") and r["out.put"] == "kept" for r in back)
    assert {r.form for r in back} == {"plain", "psm", "spm"}
    assert fim.restored(fim.fill_in_middle(df.limit(0))).count() == 0


def test_restored_of_nulls_and_clashing_names(spark):
    df = spark.createDataFrame([("<P>a<S>c<M>b", "psm", 1), (None, "psm", 2), ("x", None, 3), ("<S>c<P>a<M>b", "spm", 4)], "output string, form string, Restored int")
    assert [r.restored for r in fim.restored(df).collect()] == ["abc", None, None, "abc"]


def test_nothing_is_shuffled(spark, tmp_path):
    spark.createDataFrame([(1, "a b")], "doc_id long, text string").write.parquet(f"{tmp_path}/d")
    plan = fim.restored(fim.fill_in_middle(spark.read.parquet(f"{tmp_path}/d")))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
