"""Personal data by weak supervision (operator 2), in DataFrame functions only.

Base spans follow fixed patterns. They and looser candidates (obfuscated addresses, local numbers,
identity numbers, secrets, and what failed a base check) are voted on by five labelers: shape
(regex and check digit), gazetteer (prefix and domain lists), context words before the span, clean
borders, and digit variety. Each vote is -1, 0 or 1.

Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is;
its posteriors then train a naive Bayes classifier of spans over kind, votes and length. Base spans
stay; a looser candidate becomes a span where the classifier gives it at least ``threshold``.

The fit reads all documents; what reaches the driver are counts of (kind, votes, length bucket)
cells, at most 6 * 3^5 * 4 of them. A table of a fitted model is part of the plan as literals.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast.llm.common import narrow, table

#: Base kinds in the order of ties, then the kinds that only the method finds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "ssn", "secret")
LABELERS = ("shape", "gazetteer", "context", "border", "variety")

# ``\G`` lets a match start where the last one ended; else a run of its letters is tried once, from
# its start, which finds the same leftmost matches without trying each suffix of a long run.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
# Separators between digits become JOIN first. The base pattern takes whole chains of joined digits,
# so the chains of 12 to 19 digits are its matches of that length.
JOIN = "\ue000"
CARD = rf"(?<![0-9{JOIN}])[0-9](?:{JOIN}?[0-9]){{11,18}}(?![0-9{JOIN}])"
OCTET = "0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
VALID_IP = rf"^{OCTET}(?:\.{OCTET}){{3}}$"
# Looser candidates, one alternation: obfuscated address, identity number, local number, secrets.
LOOSE = (
    r"\b[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}"
    r"(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,63}){1,8}"
    r"|(?<![0-9.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
    r"|(?<![0-9+. )-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])"
    r"|\bAKIA[0-9A-Z]{16}\b"
    r"|(?<=token = \")[0-9a-f]{32,64}(?=\")"
)
HINTS = r"\((?:at)\)|\[at\]|[0-9][ )-][0-9 ]|[0-9]\.[0-9]{3}\.|AKIA|token = "
# Gazetteers: well-known top domains, card prefixes, words that introduce personal data or deny it.
DOMAINS = "com|org|net|edu|gov|info|io|de|fr|es|uk|eu|us|ch|at|it|nl|be"
CARD_PREFIXES = "^(?:4|5[1-5]|2[2-7]|3[47]|3[0689]|6011|65|35)"
FOR = "(?i)(?:mail|e-mail|contact|tel|phone|call|fax|mobile|card|visa|credit|ip|host|server|ssn|social|token|key|secret)[ :=\"]*$"
AGAINST = "(?i)(?:version|order|invoice|isbn|figure|fig|page|chapter|serial|sku|item|id|no|nr)[. :#=]*$"


def _matches(text: Column, pattern: str, value_of: Column | None = None) -> Column:
    """Array of (start, end, value) of the leftmost matches, in code points of ``text``.

    What lies between the matches gives their places. ``value_of`` is a text of the same length
    that the values are taken from.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda gap, value: F.struct(gap.alias("gap"), value.alias("value")))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["value"])
        value = pair["value"] if value_of is None else F.substring(value_of, start + 1, end - start)
        span = F.struct(start.alias("start"), end.alias("end"), value.alias("value"))
        return F.struct(end.alias("at"), F.array_append(state["spans"], span).alias("spans"))

    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda s: s["spans"])


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check digit."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        double = digit * 2
        return total + F.when(i % 2 == 1, digit).when(double > 9, double - 9).otherwise(double)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _typed(spans: Column, kind, valid) -> Column:
    """Spans with kind, whether they are base spans, and their text."""
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            kind(s["value"]).alias("kind"),
            valid(s["value"]).alias("base"),
            s["value"].alias("value"),
        ),
    )


_SPANS = "array<struct<start:int,end:int,kind:string,base:boolean,value:string>>"


def _when(condition: Column, spans: Column) -> Column:
    return F.when(condition, spans.cast(_SPANS)).otherwise(F.array().cast(_SPANS))


def candidates(docs: DataFrame) -> DataFrame:
    """Adds ``found``: base spans and looser candidates of ``text``, by start and kind."""
    text = F.col("text")
    joined = F.regexp_replace(F.translate(text, JOIN, "\ue001"), "(?<=[0-9])[ -](?=[0-9])", JOIN)
    enough = lambda v: F.length(_digits(v)).between(9, 15)
    out = (
        docs.withColumn("text", F.coalesce("text", F.lit("")))
        .withColumn("digits", text.rlike("[0-9][^A-Za-z]*[0-9]"))
        .withColumn("joined", F.when(text.rlike("[0-9](?:[ -]?[0-9]){11}"), joined))
        .withColumn(
            "emails",
            _when(
                F.contains(text, F.lit("@")),
                _typed(_matches(text, EMAIL), lambda v: F.lit("email"), lambda v: F.lit(True)),
            ),
        )
        .withColumn(
            "ips",
            _when(
                F.col("digits") & text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
                _typed(_matches(text, IP), lambda v: F.lit("ip"), lambda v: v.rlike(VALID_IP)),
            ),
        )
        .withColumn(
            "cards",
            _when(
                F.col("joined").isNotNull(),
                _typed(
                    _matches(F.col("joined"), CARD, text), lambda v: F.lit("card"), lambda v: _luhn(_digits(v))
                ),
            ),
        )
        .withColumn(
            "phones",
            _when(
                F.contains(text, F.lit("+")) & text.rlike(r"\+[0-9]"),
                _typed(_matches(text, PHONE), lambda v: F.lit("phone"), enough),
            ),
        )
    )
    loose_kind = lambda v: (
        F.when(v.rlike("^AKIA[0-9A-Z]{16}$") | v.rlike("^[0-9a-f]{32,}$"), "secret")
        .when(v.rlike(r"\(at\)|\[at\]"), "email")
        .when(v.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
        .otherwise("phone")
    )
    loose = _typed(_matches(text, LOOSE), loose_kind, lambda v: F.lit(False))
    out = out.withColumn("loose", _when(text.rlike(HINTS), loose))
    order = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    every = F.concat("emails", "ips", "cards", "phones", "loose")
    ranked = F.transform(
        every,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.element_at(order, s["kind"]).alias("rank"),
            s["end"].alias("end"),
            s["kind"].alias("kind"),
            s["base"].alias("base"),
            s["value"].alias("value"),
        ),
    )
    return out.withColumn("found", F.array_sort(ranked)).drop(
        "digits", "joined", "emails", "ips", "cards", "phones", "loose"
    )


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def voted(docs: DataFrame) -> DataFrame:
    """Adds the labelers' votes and the length bucket to each candidate in ``found``."""
    text = F.col("text")

    def labels(s: Column) -> Column:
        value, kind, digits = s["value"], s["kind"], _digits(s["value"])
        before = F.substring(text, F.greatest(s["start"] - 19, F.lit(1)), F.least(s["start"], F.lit(20)))
        left = F.when(s["start"] > 0, F.substring(text, s["start"], F.lit(1))).otherwise(" ")
        right = F.substring(text, s["end"] + 1, F.lit(1))
        shape = F.when(s["base"], 1).when(kind.isin("ip", "card"), -1).when(
            (kind == "phone") & F.startswith(value, F.lit("+")), -1
        ).otherwise(0)
        gazetteer = (
            F.when(kind == "email", _vote(value.rlike(rf"(?i)[. )\]](?:{DOMAINS})$"), F.lit(False)))
            .when(kind == "ip", _vote(F.lit(False), value.rlike(r"^0|\.0+\.0+\.")))
            .when(kind == "card", _vote(digits.rlike(CARD_PREFIXES), F.lit(True)))
            .when(kind == "phone", _vote(digits.rlike("^[1-9]"), F.lit(True)))
            .when(kind == "ssn", _vote(~digits.rlike("^(?:000|666|9)"), F.lit(True)))
            .otherwise(_vote(F.startswith(value, F.lit("AKIA")), F.lit(False)))
        )
        context = _vote(before.rlike(FOR), before.rlike(AGAINST))
        border = _vote(
            left.rlike(r"[\s(\[<\"':,;]") & ((right == "") | right.rlike(r"[\s)\]>\"',;.!?]")),
            left.rlike(r"[\p{L}\p{N}_]") | right.rlike(r"[\p{L}\p{N}_]"),
        )
        same = F.replace(digits, F.substring(digits, 1, 1), F.lit("")) == ""
        variety = F.when((digits != "") & (F.length(digits) > 4) & same, -1).otherwise(0)
        length = F.least(F.floor(F.length(value) / 8), F.lit(3)).cast("int")
        votes = [shape, gazetteer, context, border, variety]
        return F.struct(
            *[s[c].alias(c) for c in ("start", "rank", "end", "kind", "base", "value")],
            *[v.cast("int").alias(name) for v, name in zip(votes, LABELERS)],
            length.alias("length"),
        )

    return docs.withColumn("found", F.transform("found", labels))


def estimate(cells: list[tuple[tuple[int, ...], float]], rounds: int = 25) -> dict[tuple[int, ...], float]:
    """Posterior of each vote pattern by expectation-maximisation over pattern counts.

    Two classes, labelers independent within a class. It starts from the majority of votes.
    """
    belief = {v: 1 / (1 + math.exp(-1.5 * sum(v) - 0.1)) for v, _ in cells}
    for _ in range(rounds):
        mass = defaultdict(lambda: 0.5)
        for v, n in cells:
            for y, p in ((1, belief[v]), (0, 1 - belief[v])):
                mass[y] += n * p
                for j, x in enumerate(v):
                    mass[y, j, x] += n * p
        for v, _ in cells:
            log = [math.log(mass[y]) + sum(math.log(mass[y, j, x] / (mass[y] + 1)) for j, x in enumerate(v)) for y in (0, 1)]
            belief[v] = 1 / (1 + math.exp(min(50.0, max(-50.0, log[0] - log[1]))))
    return belief


def fit(docs: DataFrame) -> dict:
    """Log odds of the span classifier: prior, and one weight for each kind, vote and length.

    Runs a job over all documents. Without any candidate the model knows nothing (score 0.5).
    """
    cells = (
        voted(candidates(docs))
        .select(F.explode("found").alias("s"))
        .groupBy("s.kind", *[f"s.{name}" for name in LABELERS], "s.length")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()  # bounded by kinds, vote patterns and length buckets
    )
    patterns: dict[tuple[int, ...], float] = defaultdict(float)
    for row in cells:
        patterns[tuple(row[name] for name in LABELERS)] += row["n"]
    belief = estimate(sorted(patterns.items()))
    total, mass = [1.0, 1.0], defaultdict(lambda: [0.5, 0.5])
    for row in cells:
        p = belief[tuple(row[name] for name in LABELERS)]
        for y, share in ((1, p), (0, 1 - p)):
            total[y] += row["n"] * share
            for name in (*LABELERS, "kind", "length"):
                mass[name, row[name]][y] += row["n"] * share
    weights = {key: math.log(m[1] / total[1]) - math.log(m[0] / total[0]) for key, m in mass.items()}
    return {"prior": math.log(total[1]) - math.log(total[0]), "weights": weights}


def score(span: Column, model: dict) -> Column:
    """Probability that a voted span is personal data."""
    odds = F.lit(float(model["prior"]))
    values = {"kind": KINDS, "length": range(4)} | {name: (-1, 0, 1) for name in LABELERS}
    for name, known in values.items():
        weight = F.lit(0.0)
        for value in known:
            w = float(model["weights"].get((name, value), 0.0))
            weight = F.when(span[name] == F.lit(value), F.lit(w)).otherwise(weight)
        odds = odds + weight
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def find_spans(docs: DataFrame, model: dict, threshold: float = 0.5) -> DataFrame:
    """Adds ``base`` and ``spans``, arrays of (start, rank, end, kind) by start and kind.

    ``spans`` holds the base spans and the looser candidates that the classifier accepts and that
    overlap no base span. Spans of different kinds may overlap where base patterns do.
    """
    keep = lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))
    out = voted(candidates(docs)).withColumn("base", F.filter("found", lambda s: s["base"]))
    added = F.filter(
        "found",
        lambda s: ~s["base"]
        & (score(s, model) >= threshold)
        & ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    out = out.withColumn("added", added)
    return (
        out.withColumn("spans", F.array_sort(F.transform(F.concat("base", "added"), keep)))
        .withColumn("base", F.transform("base", keep))
        .drop("found", "added")
    )


def _digest(spans: str) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and places of personal data in every whole text (runs a job for the fit).

    Null texts count as empty and have no spans. Repeated rows each get a row; null ids are kept;
    other columns are not read; an empty table gives an empty result.
    """
    docs = narrow(docs, id_col, text_col)
    found = find_spans(docs, fit(docs))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE_KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(_digest("base"), 256).alias("base_sha256"), _digest("spans").alias("spans")
    )


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each span of personal data replaced by its kind in angle brackets.

    Overlapping spans are replaced once, by the kind of the first. Null texts stay null.
    """
    columns = docs.columns
    work = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    found = find_spans(work, fit(work))
    text = F.col("text")

    def step(state: Column, s: Column) -> Column:
        start = F.greatest(s["start"], state["at"])
        piece = F.concat(F.substring(text, state["at"] + 1, start - state["at"]), F.lit("<"), s["kind"], F.lit(">"))
        inside = s["start"] < state["at"]
        return F.struct(
            F.greatest(s["end"], state["at"]).alias("at"),
            F.when(inside, state["out"]).otherwise(F.concat(state["out"], piece)).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    new = F.aggregate(
        "spans", start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text)))
    )
    new = F.when(F.size("spans") > 0, new).otherwise(F.col("row")[text_col].cast("string"))
    return found.select(*[(new if c == text_col else F.col("row")[c]).alias(c) for c in columns])


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
