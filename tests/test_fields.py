from pyspark.sql import functions as F

from reportloom.functions import fields
from reportloom.functions.fields import Fields
from reportloom.operators import graph
from reportloom.sources import frontmatter


def read(block):
    f = Fields(block)
    return f.scalars, f.lists, f.problem


def test_scalars():
    said, lists, problem = read(
        "a: null\nb: ~\nc:\nd: ''\ne: \"\"\nf: 'O''Brien'\ng: \"say \\\"hi\\\" \\u00e9\\n\\x41\\ttab\"\nh: plain # remark\ni: a#b\nj: http://x/y:z\n'k e': 1\n\"l\\tm\": 2\n-n: 3\no : 4\n# remark\np: Null\nq: 'null'"
    )
    assert said == {"a": None, "b": None, "c": None, "d": "", "e": "", "f": "O'Brien", "g": 'say "hi" é\nA\ttab', "h": "plain", "i": "a#b", "j": "http://x/y:z", "k e": "1", "l\tm": "2", "-n": "3", "o": "4", "p": None, "q": "null"}
    assert lists == {} and problem is None


def test_values_over_several_lines():
    said, lists, problem = read(
        "a: one\n  two\n\n  three\nb: 'x\n\n  y''s\n  z'\nc: \"p \\\n    q\\\n    \\ r\"\nd: |\n  keep\n    this\n\n  way\n\ne: >\n  fold\n  these\n\n  not\nf: |-\n  bare\ng: >+\n  all\n\nh: [a, 'b, c', \"d\",\n  e]\ni: last"
    )
    assert said == {"a": "one two\nthree", "b": "x\ny's z", "c": "p q r", "d": "keep\n  this\n\nway\n", "e": "fold these\nnot\n", "f": "bare", "g": "all\n\n", "i": "last"}
    assert lists == {"h": ["a", "b, c", "d", "e"]} and problem is None


def test_lists_and_levels():
    said, lists, problem = read("rel:\n  one: []\n  two:\n  - x\n  - 'y: z'\n  three:\n    - p\n      q\n    -\n  deep:\n    er: 1\ntags:\n- a\n- null\nmap: {m: 1, n: null}\nnone: {}\nrel2:\n  one: 5\ntags: [z]")
    assert said == {"rel.deep.er": "1", "map.m": "1", "map.n": None, "rel2.one": "5"}
    assert lists == {"rel.one": [], "rel.two": ["x", "y: z"], "rel.three": ["p q", None], "tags": ["z"]} and problem is None


def test_what_does_not_read_is_named_and_the_rest_is_read():
    for block, line in (("a: 1\n  b: 2\nc: 3", 2), ("- x\nc: 3", 1), ("a: 'open\nc: 3", 1), ("nonsense\nc: 3", 1), ("a: [x, [y]]\nc: 3", 1), ("a: [x\nc: 3", 1)):
        said, _, problem = read(block)
        assert said["c"] == "3" and problem.endswith(f"in line {line}"), (block, said, problem)
    assert read("") == ({}, {}, None)


def test_written_values_read_back(spark):
    values = [None, "", "plain", "null", "Yes", "~", "a: b", "a #b", "#c", "it's", 'say "hi"', "two\nlines", "tab\tand \\ back", "- x", "[a]", "{b}", " lead", "trail ", "2019", "1.5", "2026-07-31", "@who", "é — ü", "x:", " ", "a\r\nb", "\x00", "%x", "*", "!t", "|", ">", "?", "'", "\x7f\x85"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").coalesce(1)
    both = df.select("i", "v", fields.stated(F.concat(F.lit("before: x\nfield: "), fields.written(F.col("v")), F.lit("\nafter: y"))).alias("s"))
    for r in both.collect():
        assert r.s.fields == {"before": "x", "field": r.v, "after": "y"} and r.s.problem is None, (r.v, r.s)


def test_documents_of_files(spark, tmp_path):
    (tmp_path / "a.md").write_text("---\nid: a\nagency_code: null\nreporting_year: '2019'\nrelationships:\n  related: [b]\n  implements:\n  - c\n  - d\ntags:\n- t\nassessment: green\n---\n\n## Full text\n\nhello\n")
    (tmp_path / "b.md").write_text("no fields")
    docs = {r.path.rsplit("/", 1)[1]: r for r in frontmatter.documents(spark, str(tmp_path)).collect()}
    a, b = docs["a.md"], docs["b.md"]
    assert a.agency_code is None and a.relationships.related == ["b"] and a.relationships.implements == ["c", "d"] and a.relationships.supersedes is None and a.tags == ["t"] and "assessment" in a.field_names
    assert b.id is None and b.relationships.related is None and b.field_names is None
    edges = graph.stated_edges(frontmatter.documents(spark, str(tmp_path))).collect()
    assert sorted(map(tuple, edges)) == [("a", "implements", "c"), ("a", "implements", "d"), ("a", "related", "b")]
    assert len(frontmatter.SCALARS) + 2 == 33
