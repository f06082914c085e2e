"""Text functions from Column to Column, all inside the JVM.

Patterns name their white space, since Java, RE2 and Python disagree on what ``\\s`` holds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns, words and limits that results depend on.
WHITE = r"[\s\x0B\x1c-\x1f\x{0085}\x{00A0}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: The characters of :data:`WHITE`.
WHITES = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
STRUCTURAL_WORDS = ["department", "dept", "of", "the", "oregon", "state", "board", "commission", "office", "division", "bureau", "and", "their"]
LINE_ENDS = r"\r\n|[\n\r\x0B\f\x1c-\x1e\x{0085}\x{2028}\x{2029}]"
ANCHORS = ["KPM #", "Report Year", "Actual", "Target", "Data Collection Period"]
KPM_HEAD = r"^KPM ?# ?([0-9]+)(?:[ \t]*$|[ \t]+(?=[A-Z])|(?=[A-Z][a-zA-Z]))"
LAYOUT_HEAD = r"^KPM ?# ?([0-9]+)(?:[ \t]*$|[ \t]+(?=[A-Z])|[ \t]{2,}\S|(?=[A-Z][a-zA-Z]))"
YEAR = r"(?:19|20)[0-9]{2}"
SERIES_HEAD = r"(?i)^(?:Report Year|Metric(?! +Value))"
PERIOD = r"(?i)Data Collection Period[:\s]*(.*)"
STOP = r"(?i)^(How Are We Doing|About the Targets|Factors Affecting)"
NON_VALUE = r"No\s*Data|Not\s*(?:Available|Reported)|N/?A|TBD|Pending|--?|\*"
NUMBER = r"\$?-?[0-9,]+(?:\.[0-9]+)?%?"
VALUE = rf"(?i)^{NUMBER}$|^(?:{NON_VALUE})$"
TOKEN = rf"(?i){NUMBER}|{NON_VALUE}"
ACCOUNTING = rf"\(\s*{NUMBER}\s*\)"
COVER_FURNITURE = r"(?i)https?://|[0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4}|KPM\s*-\s*View\s*Report|Agency\s+Management\s+Report|KPMs?\s+for\s+Reporting\s+Year|^\s*Published\s*:"
COVER_TITLE = r"(?i)annual\s*p?\s*erform"
REPORTING_YEAR = r"(?i)Reporting\s+Year\s*[:\-]?\s*((?:19|20)[0-9]{2})"
REPORTING_YEAR_TIGHT = r"(?i)ReportingYear[:\-]?((?:19|20)[0-9]{2})"
PAGE_NUMBER = r"(?i)^(page\s+)?[0-9]{1,3}(\s*(of|/)\s*[0-9]{1,3})?$"
FILE_PATTERNS = [
    r"(?i)^(APPRProposed|APPR)_([A-Za-z0-9&.-]+)_((?:19|20)[0-9]{2})[-_][0-9]{2}[-_][0-9]{2}\.pdf$",
    r"(?i)^(APPRProposed|APPR)_([A-Za-z0-9&.-]+)_((?:19|20)[0-9]{2})\.pdf$",
    r"(?i)^()([A-Za-z0-9&.-]+)\s+((?:19|20)[0-9]{2})\s+Annual\s+Performance\s+Progress\s+Report.*\.pdf$",
]
FILE_PATTERN_YEAR_FIRST = r"(?i)^Annual\s+Performance\s+Progress\s+Report\s*-\s*((?:19|20)[0-9]{2})\s*\(([^)]+)\)\.pdf$"
YEAR_TOKEN = r"20(?:1[3-9]|2[0-6])"
KEY_CHARS, TEXT_CHARS = 200, 400


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: str | Column) -> Column:
    """Without white space at both ends; a pattern for the end would be tried from each blank of the text."""
    return F.btrim(_c(x), F.lit(WHITES))


def loose(x: str | Column) -> Column:
    """Runs of white space as one blank."""
    return F.regexp_replace(_c(x), rf"{WHITE}+", " ")


def tight(x: str | Column) -> Column:
    """Without any white space."""
    return F.translate(_c(x), WHITES, "")


def normalise_url(x: str | Column) -> Column:
    """Stripped, over https, with its path percent-encoded, its query kept and its fragment dropped."""
    link = F.regexp_replace(strip(x), r"\Ahttp://", "https://")
    whole = r"\A((?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?)([^?#]*)(\?[^#]*)?"
    path = F.url_encode(F.regexp_extract(link, whole, 2))
    # form encoding differs from path encoding in four characters
    for coded, plain in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        path = F.replace(path, F.lit(coded), F.lit(plain))
    query = F.regexp_extract(link, whole, 3)
    return F.concat(F.regexp_extract(link, whole, 1), path, F.when(query == "?", "").otherwise(query))


def slug(x: str | Column) -> Column:
    """A file name as an id of lower-case words joined by hyphens; ``untitled`` if none is left."""
    words = F.regexp_replace(F.lower(F.regexp_replace(_c(x), r"(?i)\.pdf$", "")), "[^a-z0-9]+", "-")
    return F.coalesce(F.nullif(F.btrim(words, F.lit("-")), F.lit("")), F.lit("untitled"))


def entity_key(x: str | Column) -> Column:
    """The words of a name that identify a body, in sorted order, joined by hyphens."""
    words = F.split(F.regexp_replace(F.lower(F.coalesce(_c(x), F.lit(""))), "[^a-z0-9 ]", " "), " +")
    named = F.filter(words, lambda w: (w != "") & ~w.isin(STRUCTURAL_WORDS))
    return F.array_join(F.array_sort(named), "-")


def strip_control(x: str | Column) -> Column:
    return F.regexp_replace(_c(x), r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")


def escape_headings(x: str | Column) -> Column:
    """A blank before lines that look like Markdown headings, and no more than one empty line."""
    spaced = F.regexp_replace(_c(x), r"(?md)^(#{1,6}\s)", " $1")
    return F.regexp_replace(spaced, r"\n{3,}", "\n\n")


def is_page_number(line: str | Column, pages: str | Column) -> Column:
    line = _c(line)
    return line.rlike(PAGE_NUMBER) & (F.length(line) <= 16) & (_c(pages) > 1)


def words(x: str | Column) -> Column:
    """Runs between white space."""
    return F.filter(F.split(_c(x), rf"{WHITE}+"), lambda w: w != "")


def first_word(x: str | Column) -> Column:
    """The first of :func:`words` of a stripped text; empty if it has none."""
    return F.get(F.split(_c(x), rf"{WHITE}+", 2), F.lit(0))


def is_letter_spaced(x: str | Column) -> Column:
    """At least 50 tokens, more than 0.6 of them single characters."""
    tokens = words(x)
    return (F.size(tokens) >= 50) & (F.size(F.filter(tokens, lambda w: F.length(w) == 1)) / F.size(tokens) > 0.6)


def _group(x: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(x, pattern, group), F.lit(""))


def reporting_year(first: str | Column, full: str | Column) -> Column:
    """From page one, else from the first 4000 characters, else from both without white space."""
    head = F.substring(_c(full), 1, 4000)
    return F.coalesce(
        _group(loose(first), REPORTING_YEAR, 1),
        _group(loose(head), REPORTING_YEAR, 1),
        _group(tight(first), REPORTING_YEAR_TIGHT, 1),
        _group(tight(head), REPORTING_YEAR_TIGHT, 1),
    )


def is_cover_name(line: Column) -> Column:
    """Whether a line of page one can be the name of the body that reports."""
    return (F.length(line) > 3) & ~line.rlike(REPORTING_YEAR) & ~line.rlike(COVER_TITLE) & ~line.rlike(COVER_FURNITURE)


def agency(first: str | Column, listed: str | Column) -> Column:
    """``struct(agency, agency_source)``: the first name on page one, else the listed one."""
    names = F.filter(F.transform(F.split(_c(first), LINE_ENDS), lambda x: strip(loose(x))), is_cover_name)
    found = F.get(names, F.lit(0))
    listed = F.nullif(_c(listed), F.lit(""))
    source = F.when(found.isNotNull(), "document").when(listed.isNotNull(), "socrata").otherwise("unknown")
    return F.struct(F.coalesce(found, listed, F.lit("")).alias("agency"), source.alias("agency_source"))


def unescape(x: str | Column) -> Column:
    """Percent escapes decoded; a percent sign that begins none, and plus signs, stay."""
    sound = F.regexp_replace(_c(x), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(F.replace(sound, F.lit("+"), F.lit("%2B")))


def parse_filename(x: str | Column) -> Column:
    """``struct(agency_code, reporting_year, year_source, measure_status)`` of a file name.

    Percent escapes are decoded first.  Four conventions in order; without one, a name that holds exactly one distinct year token gives
    that year, and anything else is left null.
    """
    name = unescape(x)
    proposed = lambda s: F.when(F.lower(s) == "apprproposed", "proposed").otherwise("approved")
    made = lambda code, year, source, status: F.struct(code.alias("agency_code"), year.alias("reporting_year"), source.alias("year_source"), status.alias("measure_status"))
    none, text = F.lit(None).cast("string"), F.lit("filename")
    years = F.array_distinct(F.regexp_extract_all(name, F.lit(YEAR_TOKEN), 0))
    status = F.when(F.contains(F.replace(F.lower(name), F.lit(" "), F.lit("")), F.lit("apprproposed")), "proposed").otherwise("approved")
    out = F.when(F.size(years) == 1, made(none, F.get(years, F.lit(0)), F.lit("filename-scan"), status)).otherwise(made(none, none, none, status))
    p = FILE_PATTERN_YEAR_FIRST
    out = F.when(name.rlike(p), made(F.upper(F.regexp_extract(name, p, 2)), F.regexp_extract(name, p, 1), text, F.lit("approved"))).otherwise(out)
    for p in reversed(FILE_PATTERNS):
        out = F.when(name.rlike(p), made(F.upper(F.regexp_extract(name, p, 2)), F.regexp_extract(name, p, 3), text, proposed(F.regexp_extract(name, p, 1)))).otherwise(out)
    return out


def id_of_file(x: str | Column) -> Column:
    x = _c(x)
    return F.when(F.lower(x).endswith(".pdf"), F.substring(x, F.lit(1), F.length(x) - 4)).otherwise(x)


def measure_key(x: str | Column) -> Column:
    """What identifies a measure over reports: its words, never its number."""
    return F.btrim(F.regexp_replace(F.lower(_c(x)), "[^a-z0-9]+", " "), F.lit(" "))


def is_value(x: str | Column) -> Column:
    return _c(x).rlike(VALUE)


def value_tokens(x: str | Column) -> Column:
    return F.regexp_extract_all(_c(x), F.lit(TOKEN), 0)


def is_series_head(x: str | Column) -> Column:
    return _c(x).rlike(SERIES_HEAD)


def is_layout_series_head(x: str | Column) -> Column:
    near = F.lower(tight(F.substring(_c(x), 1, 20)))
    return is_series_head(x) | near.rlike("^(?:reportyear|metric(?!value))")


def citation(code: str | Column, agency_name: str | Column, year: str | Column) -> Column:
    short = F.upper(F.substring(slug(agency_name), 1, 24))
    return F.concat_ws(" ", F.lit("APPR"), F.coalesce(F.nullif(_c(code), F.lit("")), short), _c(year))


def missing_anchors(x: str | Column) -> Column:
    near, dense = loose(x), tight(x)
    wanted = F.array(*[F.lit(a) for a in ANCHORS])
    return F.filter(wanted, lambda a: ~F.contains(near, a) & ~F.contains(dense, F.replace(a, F.lit(" "), F.lit(""))))


def fold_quotes(x: str | Column) -> Column:
    return F.translate(_c(x), "‘’“”", "''\"\"")


def content_hash(x: str | Column) -> Column:
    """SHA-256 of texts from 200 characters on with quotes and white space folded; else of the bytes."""
    x = _c(x)
    return F.when(F.length(x) >= 200, F.sha2(F.btrim(loose(fold_quotes(x)), F.lit(" ")).cast("binary"), 256)).otherwise(F.sha2(x.cast("binary"), 256))


def section(x: str | Column, title: str) -> Column:
    """The body of a Markdown section up to the next of its level."""
    return F.regexp_extract(_c(x), rf"(?msd)^## {title}[ \t]*$(.*?)(?=^## |\z)", 1)


def percent(x: Column) -> Column:
    """A share as a whole percentage, half to even."""
    return F.concat(F.bround(x * 100, 0).cast("int").cast("string"), F.lit("%"))


def escape_pipes(x: str | Column) -> Column:
    return F.replace(_c(x), F.lit("|"), F.lit("\\|"))
