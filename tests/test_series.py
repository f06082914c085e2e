import random
import re

from pyspark.sql import functions as F

from reportloom.functions import arrays, text
from reportloom.operators import series
from reportloom.sources import storage

HEAD = "Annual Performance Progress Report\nReporting Year 2021\n"
YEARS = ["2017", "2018", "2019", "2020", "2021"]


def block(number=1, title="Share of cases closed", years=YEARS, body="", period="Data Collection Period: Jul 01\n- Jun 30\n", head="Report Year"):
    return f"KPM #{number}\n{title}\n{period}{head}\n" + "\n".join(years) + f"\n{body}\n"


def run(values=("1", "2", "3", "4", "5"), targets=("9",) * 5, label=None):
    return (f"{label}\n" if label else "") + "Actual\n" + "\n".join(values) + "\nTarget\n" + "\n".join(targets)


def read(spark, texts, layouts=None):
    rows = [(f"d{i}", "Board of X", "2021", "approved", f"u{i}", t, (layouts or {}).get(i)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id string, agency string, reporting_year string, measure_status string, source_url string, text string, layout string")
    s = series.extract(docs)
    found = sorted((r.agency_doc, r.kpm_number, r.block, r.run, r.year_index, r.submeasure, r.year, r.actual, r.target, r.measure_key, r.data_collection_period) for r in s.rows.collect())
    return found, sorted((r.doc_id, r.problem) for r in s.problems.collect())


def test_layouts_of_a_block(spark):
    inline = "KPM# 2 Inline title\nReport Year 2017 2018 2019 2020 2021\nActual No Data 7% 8% 9% 10%\nTarget 1 2 3 4 5\n"
    metric = block(3, head="Metric", body="Metric Value\n" + run())
    labels = block(4, body="\n".join(run(label=f"part {k}") for k in "abcdef"))
    three = block(5, body="\n".join(run() for _ in range(3)))
    rows, problems = read(spark, [HEAD + block(body=run(label="a label")), HEAD + inline, HEAD + metric, HEAD + labels, HEAD + three])
    assert not problems
    assert [r[5:] for r in rows if r[0] == "d0"][0] == ("a label", "2017", "1", "9", "share of cases closed", "Jul 01 - Jun 30")
    assert [(r[6], r[7], r[8], r[9], r[10]) for r in rows if r[0] == "d1"][:2] == [("2017", "No Data", "1", "inline title", None), ("2018", "7%", "2", "inline title", None)]
    assert {r[5] for r in rows if r[0] == "d2"} == {None}
    assert len([r for r in rows if r[0] == "d3"]) == 30
    assert {r[5] for r in rows if r[0] == "d4"} == {"unlabelled run 1", "unlabelled run 2", "unlabelled run 3"}


def test_headings(spark):
    lines = ["KPM #1", "KPM#2 Traffic", "KPM #7PERCENTAGE of", "KPM #2A", "KPM #14 documents how", "KPM# Approved", "KPM #3  "]
    df = spark.createDataFrame([(x,) for x in lines], "s string")
    assert [r[0] for r in df.select(F.col("s").rlike(text.KPM_HEAD)).collect()] == [True, True, True, False, False, False, True]


def test_refusals(spark):
    rows, problems = read(spark, [
        HEAD + "No approved KPMs exist",
        HEAD + "KPM #1\nTitle\nActual 1 2 3\n",
        HEAD + block(body=run(values=("1", "2", "3"))),
        None,
        "",
    ])
    assert rows == []
    assert problems == [("d0", "no 'KPM #n' blocks"), ("d1", "KPM block 1: no Report Year run"), ("d2", "KPM #1: 3 actual(s) vs 5 year(s)"), ("d3", "no snapshot text"), ("d4", "no 'KPM #n' blocks")]


def test_targets_stay_positional_or_go(spark):
    rows, problems = read(spark, [HEAD + block(body=run(targets=("9", "9")))])
    assert not problems and {r[8] for r in rows} == {None} and len(rows) == 5
    alone, problems = read(spark, [HEAD + block(body="Target\n9\n9\n9\n9\n9\n" + run())])
    assert problems == [("d0", "KPM #1/unlabelled run 1: 0 actual(s) vs 5 year(s)")] and len(alone) == 5
    twice, problems = read(spark, [HEAD + block(body="Actual\n1\n2\n3\n4\n5\n" + run() + "\nActual\n6\n7\n8\n9\n10")])
    assert [r[7] for r in twice] == ["1", "2", "3", "4", "5"] * 2 + ["6", "7", "8", "9", "10"] and not problems


def layout(cells, target=None, label=None, years=YEARS):
    row = lambda name, xs: name.ljust(14) + "".join(x.rjust(10) for x in xs)
    return "\n".join(["KPM #1", row("Report Year", years), *([label] if label else []), row("Actual", cells), *([row("Target", target)] if target else [])])


def test_geometry_recovers_what_it_places(spark):
    short = lambda *v: HEAD + block(body=run(values=v))
    texts = [short("73%", "73%", "73%"), short("4.10", "3.90", "3.70", "3.80"), short("90%", "90%"), short("1"), short()]
    layouts = {
        0: layout(["73%", "", "73%", "", "73%"]),
        1: layout(["4.10", "3.90", "3.70", "4", "3.80"]),
        2: layout(["90%", "90%", "90%", "", ""]),
        3: layout(["($14.00)", "", "", "", ""]),
        4: layout(["", "5", "", "", ""]),
    }
    rows, problems = read(spark, texts, layouts)
    seen = {d: [(r[6], r[7]) for r in rows if r[0] == d] for d in ("d0", "d1", "d2", "d3", "d4")}
    assert seen["d0"] == [("2017", "73%"), ("2019", "73%"), ("2021", "73%")]
    assert [v for _, v in seen["d1"]] == ["4.10", "3.90", "3.70", "4", "3.80"]
    assert seen["d2"] == [] and seen["d3"] == [] and seen["d4"] == [("2018", "5")]
    assert [d for d, _ in problems] == ["d2", "d3"]


def test_place_refuses_what_is_unclear():
    at = lambda cells: "Actual" + "".join(c.rjust(10) for c in cells)
    centres = [14.0, 24.0, 34.0]
    place = lambda *one: arrays.placed(*[[x] for x in one])[0]
    assert place(at(["1", "", "3"]), 6, centres, 3) == ["1", None, "3"]
    assert place("Actual       1 2", 6, centres, 3) is None  # two under one year
    assert place("Actual                                            9", 6, centres, 3) is None
    assert place(at(["1", "2", "3", "4"]), 6, centres, 3) is None
    assert place(at(["1"]), 6, [], 3) is None


def test_embeddings(spark):
    df = spark.createDataFrame([(["a"], ["a", "b"]), (["a", "a"], ["a", "a", "a"]), (["x"], ["a"]), ([], ["a"])], "s array<string>, l array<string>")
    assert [r[0] for r in df.select(arrays.embeddings(F.col("s"), F.col("l"))).collect()] == [1, 2, 0, 1]


def test_disagreements(spark):
    rows = [("A", "d1", "2020", "m", None, "2019", "1"), ("A", "d2", "2021", "m", None, "2019", "2"), ("A", "d1", "2020", "n", "s", "2019", "1"), ("A", "d1", "2020", "n", "s", "2019", "3"), ("A", "d2", "2021", "q", None, "2019", "1")]
    df = spark.createDataFrame(rows, "agency string, agency_doc string, reporting_year string, measure_key string, submeasure string, year string, actual string")
    assert [r.measure_key for r in series.restatements(df).collect()] == ["m"]
    assert [r.measure_key for r in series.conflicts(df).collect()] == ["n"]


def test_narrative_actual_and_long_lines(spark):
    body = run(label="x" * 130) + "\nHow Are We Doing\nActual results fell.\n"
    rows, problems = read(spark, [(HEAD + block(body=body)).replace("\n", "\r\n")])
    assert not problems and len(rows) == 5 and rows[0][5] is None


def test_many_lines_are_placed_at_once():
    """A batch gives what its lines give alone, the nearest column by trying all, the left one of two."""
    rng = random.Random(6)
    lines, starts, centres, years = [], [], [], []
    for _ in range(400):
        k = rng.randint(0, 5)
        at = sorted(rng.sample(range(8, 60), k)) if rng.random() < 0.9 else [20.0] * k
        line = list("Actual" + " " * 60)
        for x in rng.sample(range(8, 64), rng.randint(0, 4)):
            line[x] = rng.choice("0123456789")
        lines.append("".join(line) + rng.choice(["", "", "(5)"]))
        starts.append(6)
        centres.append([x + rng.choice([0.0, 0.5]) for x in at] if k and at[0] != at[-1] else [float(x) for x in at])
        years.append(rng.choice([k, k, max(k - 1, 0)]))
    got = arrays.placed(lines, starts, centres, years)
    for line, s, at, n, out in zip(lines, starts, centres, years, got, strict=True):
        values = [(m[0], (m.start() + m.end()) / 2) for m in re.finditer(r"\S+", line) if m.start() >= s]
        pitch = (at[-1] - at[0]) / max(1, len(at) - 1) if at else 0
        want = [None] * n
        near = [min(range(len(at)), key=lambda k: (abs(at[k] - x), k)) for _, x in values] if at else []  # noqa: B023
        far = any(abs(at[k] - x) > 0.6 * pitch for k, (_, x) in zip(near, values, strict=True)) if at else True
        if "(" in line or not 0 < len(values) <= n or pitch <= 0 or far or len(set(near)) < len(near) or max(near) >= n:
            assert out is None
        else:
            for k, (v, _) in zip(near, values, strict=True):
                want[k] = v
            assert out == want
    assert sum(x is not None for x in got) > 20 and arrays.placed([], [], [], []) == []


def test_measures_and_runs_need_no_exchange(spark):
    docs = spark.createDataFrame([("d", "KPM #1 A\nReport Year 2019 2020\nActual 1 2\nTarget 3 4")], "doc_id string, text string")
    with storage.scratch(spark):
        headed = storage.bucketed(series.headers_of(series.blocks_of(series.lines_of(docs))), "headed", storage.buckets(spark), "doc_id")
        for found in (series.measures_of(headed), series.runs_of(headed)):
            assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
        assert [tuple(r) for r in series.runs_of(headed).select("actual", "target").collect()] == [(["1", "2"], ["3", "4"])]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("reportloom_")]


def test_rows_are_not_broadcast(spark):
    """Files of runs are many times smaller than the rows they explode to: joins are dealt out by document."""
    from reportloom.sources import reports

    plan = lambda df: df._jdf.queryExecution().sparkPlan().toString()
    with storage.scratch(spark):
        found = series.extract(reports.reports(spark, "/root/testdata/sf0.001"))
        assert "SortMergeJoin" in plan(found.rows) and "BroadcastHashJoin" not in plan(found.rows)


def test_layout_lines_go_to_python_once(spark):
    docs = spark.createDataFrame([("d", "KPM #1\nReport Year      2019     2020\nA\nActual              7        8\nTarget                       9\nActual 1 2 3"), ("e", "KPM #1\nActual   7   8")], "doc_id string, layout string")
    found = series.layout_runs(docs)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("EvalPython") == 1
    assert [(r.doc_id, r.ordinal, r.a, r.t) for r in found.orderBy("doc_id", "ordinal").collect()] == [("d", 0, ["7", "8"], [None, "9"]), ("d", 1, None, None), ("e", 0, None, None)]
