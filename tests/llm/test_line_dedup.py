from collections import defaultdict

import pytest

from reportloom.llm import line_dedup


def brute(rows, ratio, least, distinct):
    pages = defaultdict(list)
    for _, host, t in rows:
        pages[host].append(t or "")
    known = set()
    for host, texts in pages.items():
        texts = set(texts) if distinct else texts
        count = defaultdict(int)
        for t in texts:
            for x in {x.strip(" \t\r") for x in t.split("\n")} - {""}:
                count[x] += 1
        known |= {(host, x) for x, n in count.items() if n >= least and n > ratio * len(texts)}
    out = []
    for i, host, t in rows:
        lines = [] if t is None else t.split("\n")
        left = [x for x in lines if x.strip(" \t\r") == "" or (host, x.strip(" \t\r")) not in known]
        out.append((str(i), host, None if t is None else "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("limit", "least", "distinct"), [(line_dedup.BROADCAST_LINES, 2, False), (0, 5, True)])
def test_lines_of_a_site(spark, monkeypatch, limit, least, distinct):
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", limit)
    rows = [(i, "h", f"menu\nown {i}\n\n  menu \t\nfooter {i % 30}\n") for i in range(60)]
    rows += [(100 + i, "one", "same page\nsame line") for i in range(50)] + [(200, "one", "same line"), (201, "two", "alone"), (202, "three", "x\ny"), (203, "three", "x")]
    rows += [(300, None, "menu"), (301, None, None), (302, "h", ""), (303, "h", "\r\nmenu\r\nlast"), (303, "h", "\r\nmenu\r\nlast"), (None, "small", "menu"), (304, "h", "x" * 100_000 + "\nmenu")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, source string, text string, N_LINES string")
    out = line_dedup.drop_lines(df, ratio=0.1, least=least, distinct=distinct)
    assert out.columns == ["doc_id", "source", "text", "n_lines", "n_dropped"]
    got = sorted((("None" if r.doc_id is None else str(r.doc_id), r.source, r.text, r.n_lines, r.n_dropped) for r in out.collect()), key=str)
    assert got == brute(rows, 0.1, least, distinct)
    by_id = {r[0]: r for r in got}
    assert by_id["100"][2] == ("same page\nsame line" if distinct else "") and by_id["201"][2] == "alone" and by_id["203"][2] == ("x" if distinct else "")
    assert line_dedup.drop_lines(df.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [line_dedup.BROADCAST_LINES, 0])
def test_lines_of_a_section(spark, monkeypatch, limit):
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", limit)
    rows = [(i, "h", "en", f"own {i}\nmenu") for i in range(200)] + [(200 + i, "h", "fr", f"à moi {i}\nplan du site") for i in range(8)]
    rows += [(300, "h", "en", "plan du site"), (301, "h", None, "menu"), (302, None, "fr", "plan du site"), (303, "h", "fr", None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string")
    plain = {r.doc_id: r.text for r in line_dedup.drop_lines(df, ratio=0.05, least=5).collect()}
    out = {r.doc_id: r for r in line_dedup.drop_lines(df, ratio=0.05, least=5, section="lang").collect()}
    assert plain[200] == "à moi 0\nplan du site" and out[200].text == "à moi 0" and out[200].n_dropped == 1
    assert all(out[i].text == f"own {i}" for i in range(200)) and all(out[200 + i].text == f"à moi {i}" for i in range(8))
    assert [out[i].text for i in (300, 301, 302, 303)] == ["plan du site", "", "plan du site", None] and len(out) == len(rows)
