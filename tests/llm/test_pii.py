import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from slotcast.llm import pii

# the base patterns, as given
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, m.end(), kind))
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(out)]


FRAGMENTS = [
    *["a", "b.c", "@", ".", "com", "1", "22", "255", "256", " ", "-", "+", "(", ")", "_", "%", "é", "😀", "\n", "x"],
    *["4111111111111111", "4111 1111 1111 1111", "+1 (555) 123-4567", "a@b.c@d.e", "1.2.3.4", "call ", ""],
    *['token = "' + "ab12" * 10 + '"', "AKIA" + "A1" * 8, "123-45-6789", "joe (at) web dot com"],
]


def test_base_spans_like_brute_force(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice(FRAGMENTS) for _ in range(rng.randint(0, 25))) for _ in range(600)]
    texts += ["", None, "1 " * 3000, "a" * 20000, "1" * 20000, "a@" * 5000, "1." * 1500, "+" + "1(" * 4000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("found", F.lit(0))
    out = pii.personal_data(df).collect()
    assert len(out) == len(texts)
    for r in out:
        want = base(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), texts[r["doc_id"]]
        counts = Counter(s.split(":")[0] for s in want)
        assert [r[f"n_{k}"] for k in PATTERNS] == [counts[k] for k in PATTERNS]
        assert set(want) <= set(r["spans"].split(",")) or not want


def test_redaction_and_columns(spark):
    rows = [(1, "mail a.b@c.org or +1 (555) 123-4567, ok", 5), (2, None, 6), (3, "clean text 12", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    out = {r["doc_id"]: r for r in pii.redact(df).collect()}
    assert out[1]["text"] == "mail <email> or <phone>, ok" and out[1]["spans"] == 5
    assert out[2]["text"] is None and out[3]["text"] == "clean text 12"


def test_reliable_labelers_win():
    cells = [((1, 1, 1), 500.0), ((1, 1, -1), 60.0), ((-1, -1, 1), 70.0), ((-1, -1, -1), 400.0)]
    belief = pii.estimate(cells)
    assert belief[1, 1, -1] > 0.9 and belief[-1, -1, 1] < 0.1


def test_empty_table(spark):
    assert pii.personal_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0
