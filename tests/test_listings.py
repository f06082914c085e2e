import os

from pyspark.sql import functions as F

from reportloom.sources import listings

MANIFEST = """note: 'Of several lines: what
  this is,

  and why.'
coverage:
  years_attempted:
  - '2018'
  - '2019'
  by_year:
    '2018': 2
gaps:
- '2017: none'
- none other
unparsed: []
sources:
"""


def text_of(path):
    if os.path.isfile(path):
        return open(path).read()
    return "".join(open(f"{path}/{p}").read() for p in sorted(os.listdir(path)) if p.startswith("part-"))


def test_a_manifest_is_read_by_several_tasks(spark, tmp_path):
    """Blocks of a few bytes: records and header come out whole wherever a boundary cuts them."""
    body = "".join(f"- id: id-{i:03}\n  title: 'It''s {i},\n    on two lines'\n  agency_code: {'null' if i % 3 else f'C{i}'}\n  tags:\n  - a\n  - b{i}\n  bytes: {i}\n" for i in range(20))
    path = f"{tmp_path}/m.yml"
    open(path, "w").write(MANIFEST + body)
    seen = set()
    for size in (64 << 20, 411, 97):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        parts = listings.pieces(spark, path)
        seen.add(parts.select("block").distinct().count())
        rows = listings.read_items(spark, path).collect()
        rows.sort(key=lambda r: r.place)
        assert [r.fields["id"] for r in rows] == [f"id-{i:03}" for i in range(20)]
        assert all(r.fields["title"] == f"It's {i}, on two lines" and r.fields["agency_code"] == (None if i % 3 else f"C{i}") and r.lists["tags"] == ["a", f"b{i}"] and r.fields["bytes"] == str(i) for i, r in enumerate(rows))
        head = listings.header(parts, "sources").first()
        assert head.text + "\n" == MANIFEST and head.fields["note"] == "Of several lines: what this is,\nand why." and head.lists["gaps"] == ["2017: none", "none other"]
        assert head.fields["coverage.by_year.2018"] == "2" and head.lists["coverage.years_attempted"] == ["2018", "2019"]
        listings.write_listing([head.text, listings.read_items(spark, path).select("place", "text")], f"{tmp_path}/again-{size}")
        assert text_of(f"{tmp_path}/again-{size}") == MANIFEST + body
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")
    assert max(seen) > 15


def test_a_crosswalk_round_trip(spark, tmp_path):
    mapping = spark.createDataFrame([("b-key", "s-b", "alias", "it's: so"), ("a", "s-a", "exact", None), ("yes", "null", "manual", "two\nlines")], "agency_key string, slug string, basis string, note string")
    unmapped = spark.createDataFrame([("gone", "merged: into b")], "agency_key string, reason string")
    facts = {"note": "what: this\nis", "names": ["x: y", "z"], "counts": {"2018": "3"}, "none": []}
    for k in range(2):
        listings.write_crosswalk(mapping, unmapped, f"{tmp_path}/{k}", facts)
        back = listings.read_map(spark, f"{tmp_path}/{k}", "mapping").select("key", *[F.element_at("fields", c).alias(c) for c in ("slug", "basis", "note")])
        assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, mapping.collect()), key=str)
        reasons = listings.read_map(spark, f"{tmp_path}/{k}", "unmapped").collect()
        assert [(r.key, r.fields) for r in reasons] == [("gone", {"reason": "merged: into b"})]
        mapping = back.toDF("agency_key", "slug", "basis", "note")
    assert text_of(f"{tmp_path}/0") == text_of(f"{tmp_path}/1")
    head = listings.header(listings.pieces(spark, f"{tmp_path}/0"), "mapping", "unmapped").first()
    assert head.fields["note"] == "what: this\nis" and head.lists == {"names": ["x: y", "z"], "none": []} and head.fields["counts.2018"] == "3"
    listings.write_crosswalk(mapping, unmapped.limit(0), f"{tmp_path}/2", facts)
    assert listings.read_map(spark, f"{tmp_path}/2", "unmapped").count() == 0 and listings.read_map(spark, f"{tmp_path}/2", "mapping").count() == 3


def test_a_manifest_round_trip(spark, tmp_path):
    columns = ["id", "url", "agency_code", "agency", "reporting_year", "bytes"]
    sources = spark.createDataFrame([("b", "http://x/y:z", None, "Board, of #1", "2019", 5), ("a", "u", "X", "- dash", "2019", None), ("c", "u", "Y", "", None, 7)], "id string, url string, agency_code string, agency string, reporting_year string, bytes long")
    listings.write_manifest(sources, f"{tmp_path}/0", {"note": "n", "gaps": []}, columns)
    rows = listings.read_items(spark, f"{tmp_path}/0")
    back = rows.select("place", *[F.element_at("fields", c).alias(c) for c in columns]).withColumn("bytes", F.col("bytes").cast("long"))
    assert [r.id for r in back.orderBy("place").collect()] == ["b", "a", "c"]
    assert sorted(map(tuple, back.drop("place").collect())) == sorted(map(tuple, sources.select(*columns).collect()))
    listings.write_manifest(back, f"{tmp_path}/1", {"note": "n", "gaps": []}, columns)
    assert text_of(f"{tmp_path}/0") == text_of(f"{tmp_path}/1")
