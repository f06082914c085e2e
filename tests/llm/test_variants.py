import random
import re
import zlib
from collections import Counter

from reportloom.llm import variants as v


def edited(a, b):
    """Whether one inserted, deleted or replaced code point makes ``b`` of ``a``."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :]


def brute(docs, typos=None, length=5, count=3):
    n = Counter()
    for id, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if id is None else id}:{w}".encode())
            if typos and h % typos == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= length and c >= count}
    form, out = {}, []
    for w, c in n.items():
        near = [x for x in n if edited(w, x)]
        best = min(near, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * c else None
        out.append((w, c, len(near)))
    root = lambda w: w if form[w] is None else root(form[w])
    return sorted((w, c, k, form[w], form[w] and n[form[w]], root(w)) for w, c, k in out)


def test_keys_of_long_words():
    rng = random.Random(1)
    for n in (1, 2, 63, 64, 65, 66, 67, 200):
        for alphabet in ("ab", "a", "abcdé"):
            w = "".join(rng.choice(alphabet) for _ in range(n))
            cut = {w[:i] + w[i + 1 :] for i in range(n)}
            own = list(v.deletions(w))
            assert len(own) == len(set(own)) == 1 + len(cut)
            # a deletion's key is the key of the word that it leaves
            assert set(own[1:]) == {next(iter(v.deletions(x))) if x else "" for x in cut}


def test_variants_equal_all_pairs(spark):
    rng = random.Random(2)
    stems = ["".join(rng.choice("abcé÷Ä") for _ in range(rng.randint(4, 7))) for _ in range(60)]
    long = "".join(rng.choice("xyé") for _ in range(130))
    edge = "".join(rng.choice("xyz") for _ in range(65))
    words = []
    for stem in [*stems, long, edge, "a" * 70, "a" * 64]:
        for _ in range(4):
            i, c = rng.randrange(len(stem)), rng.choice("abcé")
            words += [rng.choice([stem, stem[:i] + stem[i + 1 :], stem[:i] + c + stem[i:], stem[:i] + c + stem[i + 1 :]])] * rng.choice([1, 3, 3, 6, 7, 14, 30, 70])
    rng.shuffle(words)
    docs = [(i % 40, " ".join(words[i::400])) for i in range(400)] + [(None, "eight Eight EIGHT ünder"), (7, None), (8, ""), (9, "1 2 . 3"), (9, "ÉTUDES " * 4), (9, "étudeS " * 9)]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, word string, N int")
    for typos in (None, 3):
        assert sorted(map(tuple, v.variants(df, typos=typos).collect())) == brute(docs, typos)
    assert v.variants(df.limit(0)).collect() == []


def test_chain_of_forms(spark):
    """Forms of forms, which rounds of joins follow to their end."""
    chain = ["a" * k + "b" * (20 - k) for k in range(12)]
    links = spark.createDataFrame(list(zip(chain, chain[1:], strict=False)) + [("x", "y")], "word string, form string")
    assert sorted(map(tuple, v.rooted(links).collect())) == sorted([(w, chain[-1]) for w in chain[:-1]] + [("x", "y")])
    assert v.rooted(links.limit(0)).collect() == []


def test_a_very_long_run(spark):
    text = "".join(random.Random(4).choice("acgt") for _ in range(60_000))
    docs = [(1, f"{text} {text} {text}"), (2, f"{text[1:]} " * 6), (3, f"{text[:-1]}é " * 3)]
    got = {r.word: r for r in v.variants(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[text].n_near == 2 and got[text].form == text[1:] and got[text[:-1] + "é"].root == text[1:]
