"""White space functions against Python's over every character that patterns name, and some beside them."""

import itertools
import re
import time

from pyspark.sql import functions as F

from reportloom.functions import arrays, text

WHITES = set("\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0    　") | set(map(chr, range(0x2000, 0x200B)))


def test_white_space_is_what_the_pattern_names(spark):
    pattern = "(?:" + text.WHITE + ")"
    odd = sorted(WHITES | set("a\x00\x1b\x7f​᠎﻿ é😀"))
    assert set(text.WHITES) == WHITES
    rows = [f"{a}{b}x {a}y{b}{a}" for a, b in itertools.product(odd, odd)] + ["", " ", "　", "a", None]
    df = spark.createDataFrame([(r,) for r in rows], "s string")
    plain = F.regexp_replace(F.regexp_replace("s", rf"\A{pattern}+", ""), rf"{pattern}+\z", "")
    same = lambda a, b: F.count_if(a.eqNullSafe(b))
    first = F.coalesce(F.get(text.words("s"), F.lit(0)), F.lit(""))
    got = df.agg(same(text.strip("s"), plain), same(text.tight("s"), F.regexp_replace("s", f"{pattern}+", "")), same(F.coalesce(text.first_word(text.strip("s")), F.lit("")), first)).first()
    assert tuple(got) == (len(rows),) * 3


def test_strip_takes_time_in_proportion_to_the_text(spark):
    """The pattern was tried from each of 200,000 blanks, up to their end."""
    df = spark.createDataFrame([("a" + " " * 200_000 + "b",)], "s string")
    began = time.monotonic()
    assert df.select(F.length(text.strip("s"))).first()[0] == 200_002
    assert time.monotonic() - began < 10


def test_years_of_lines_that_come_again(spark):
    lines = ["Report Year  2019  2020", None, "", "Report Year  2019  2020", "none"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, s string").coalesce(1)
    got = [r[0] for r in df.orderBy("i").select(arrays.year_centres("s")).collect()]
    want = [None if x is None else [(m.start() + m.end()) / 2 for m in re.finditer(text.YEAR, x)] for x in lines]
    assert got == want
