import difflib
import random

from reportloom.functions import matching
from reportloom.operators import entities

WORDS = "agriculture accountancy forestry parole supervision lottery marine medical examiners veterans affairs water resources watershed enhancement youth authority teacher standards practices tourism transportation treasury revenue psychiatric review public utility".split()


def names(n, seed):
    """Slugs of words, of which every third is another one with letters changed."""
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        s = list("-".join(rng.sample(WORDS, rng.randint(1, 4))) if len(out) % 3 or not out else rng.choice(out))
        for _ in range(rng.randint(0, 3)):
            s[rng.randrange(len(s))] = rng.choice("abcdefghijklmnopqrstuvwxyz-é")
        out.append("".join(s))
    return out


def nearest(keys, slugs, cutoff=0.6):
    out = {}
    for k in set(keys):
        m = difflib.SequenceMatcher(None, "", k)
        top = (cutoff, "")
        for s in slugs:
            m.set_seq1(s)
            top = max(top, (m.ratio(), s))
        if top[1]:
            out[k] = (top[1], round(top[0], 6))
    return out


def frames(spark, keys, slugs):
    return spark.createDataFrame([(k,) for k in keys], "agency_key string"), spark.createDataFrame([(s,) for s in slugs], "slug string")


def test_bounds_hold_for_every_text():
    slugs = [*names(120, 1), "a", "é", "x" * 300, "water" * 60]
    held = matching.Held(slugs)
    for key in [*names(40, 2), "a", "z", "q" * 64, "water" * 12, "water" * 13, "watr" * 70]:
        bounds = held.bounds(key, 0.0)
        for bound, slug in zip(bounds, slugs, strict=True):
            assert bound >= difflib.SequenceMatcher(None, slug, key).ratio()


def test_nearest_slugs_are_difflibs_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(entities, "BLOCK", 20)
    slugs = [*names(150, 3), "x" * 250, "water" * 60, "a"]
    keys = [*names(120, 4), *slugs[:5], "x" * 240 + "yy", "watr" * 70, "a", "no such thing at all, nowhere", "q" * 70]
    for cutoff in (0.6, 0.9):
        rows = entities.suggestions(*frames(spark, keys, slugs), cutoff).collect()
        assert {r.agency_key: (r.slug, r.likeness) for r in rows} == nearest(keys, slugs, cutoff) and len(rows) == len({r.agency_key for r in rows})


def test_nulls_repeats_ties_and_empty_tables(spark):
    got = entities.suggestions(*frames(spark, ["abcd", "abcd", None, "", "zz"], ["abcx", "abcy", "abcy", None, ""])).collect()
    assert [(r.agency_key, r.slug, r.likeness) for r in got] == [("abcd", "abcy", 0.75)]
    assert entities.suggestions(*frames(spark, [], ["a"])).count() == entities.suggestions(*frames(spark, ["a"], [])).count() == 0
    every = entities.suggestions(*frames(spark, ["ab", "zz"], ["ab"]), counted=True).collect()
    assert sorted((r.agency_key, r.slug) for r in every) == [("ab", "ab"), ("zz", None)]


def test_few_pairs_are_compared(spark):
    slugs, keys = sorted(set(names(2_000, 5))), sorted(set(names(1_000, 6)))
    rows = entities.suggestions(*frames(spark, keys, slugs), counted=True).collect()
    assert len(rows) == len(keys)
    assert sum(r.compared for r in rows) < 0.05 * len(keys) * len(slugs)
    some = random.Random(7).sample(keys, 40)
    want = nearest(some, slugs)
    assert {r.agency_key: (r.slug, r.likeness) for r in rows if r.agency_key in some and r.slug} == want
