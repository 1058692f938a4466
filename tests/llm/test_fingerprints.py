import hashlib
import random

from slotcast.llm import fingerprints as fp


def test_spans_and_extensions():
    rng = random.Random(2)
    a = "".join(rng.choice("ab") for _ in range(300))
    b = a[50:200] + "c" + a[:80]
    x, y = fp.PrefixHashes(a), fp.PrefixHashes(b)
    for _ in range(300):
        i, j, n = rng.randint(0, 250), rng.randint(0, 180), rng.randint(0, 40)
        same = a[i : i + n] == b[j : j + n]
        assert (x.spans(i, i + n) == y.spans(j, j + n)) == same
    for i, j in [(50, 0), (0, 151), (10, 10), (299, 0), (300, 0)]:
        n = 0
        while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
            n += 1
        assert x.common(i, y, j) == n


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    texts = [x or "" for _, x in rows]
    for i, (k, _) in enumerate(rows):
        x, following = texts[i], texts[(i + 1) % len(rows)]
        changed = x[: len(x) - len(x) // 4] + following[: len(x) // 4]
        marks = [fp.fingerprint(fp.PrefixHashes(t)) for t in (x, changed, following)]
        yield (
            *(k, len(x), hashlib.sha256(changed.encode()).hexdigest(), marks[0], marks[1]),
            *(fp.likeness(marks[0], marks[1]), fp.likeness(marks[0], marks[2])),
        )


def test_like_brute_force(spark):
    rng = random.Random(4)
    rows = [(i * 7 - 50, "".join(rng.choice("abcdé 😀") for _ in range(rng.choice([0, 1, 3, 50, 400])))) for i in range(90)]
    rows += [(None, "zz"), (None, None), (13, ""), (13, "abc"), (13, "abc"), (2**62, "q" * 5000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS bucket", "2 AS place")
    got = sorted((tuple(r)[:7] for r in fp.fingerprints(df).collect()), key=str)
    assert got == sorted(expected(rows), key=str)


def test_one_and_none(spark):
    df = spark.createDataFrame([(1, "alone")], "doc_id long, text string")
    assert fp.fingerprints(df).first()["near_next"] == 1.0
    assert fp.fingerprints(df.limit(0)).count() == 0


def test_likeness_follows_edits():
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefghij ") for _ in range(4000))
    other = "".join(rng.choice("abcdefghij ") for _ in range(4000))
    mark = fp.fingerprint(fp.PrefixHashes(text))
    assert fp.likeness(mark, fp.fingerprint(fp.PrefixHashes(fp.edited(text, other)))) > 0.4
    assert fp.likeness(mark, fp.fingerprint(fp.PrefixHashes(other))) < 0.1


def test_likeness_across_the_border_of_short_texts():
    rng = random.Random(8)
    text = "".join(rng.choice("abcdefghij ") for _ in range(70))
    mark = lambda t: fp.fingerprint(fp.PrefixHashes(t))
    assert fp.likeness(mark(text[:63]), mark(text[:65])) > 0.8
    assert fp.likeness(mark(text), mark(fp.edited(text, ""))) > 0.5
    assert fp.likeness(mark(text), mark("")) == 0.0
