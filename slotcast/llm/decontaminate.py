"""Benchmark decontamination by templates (operator 4), in DataFrame functions only.

1. Texts become word and number tokens. Numbers (digits or number words), names (capitalised words
   inside a sentence) and units (a unit word or sign after a number) become typed placeholders.
2. Windows of ``width`` tokens are hashed; an item shorter than that is one window of its own
   length. Windows with fewer than ``literals`` words that are no placeholders say too little as
   templates and are hashed by their tokens as text. The benchmark's windows are hash-joined to all
   windows of all documents; they are broadcast while their count is under a bound, else the join
   shuffles.
3. Matches of a document and an item that keep one distance between their places form an
   alignment. The tokens of matched windows are compared again as text, and the changed slots of an
   alignment must be consistent: where one value of the item became several in the document, the
   windows that hold one of these places are dropped. What is left of such an alignment counts when
   it covers ``RUN`` tokens or half of the item's windows.
4. A document is contaminated by an item when the windows left cover at least ``share`` of the
   item's windows, or when ``RUN`` consecutive tokens of the item stand in it as text. Where slot
   values differ, the question was re-parameterised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotcast.llm.common import narrow, stage, table

WIDTH = 8
#: So many consecutive tokens of an item, equal as text, are a leak however long the item is.
RUN = 13
#: Rows of benchmark windows, or of document ids, that are broadcast at most (about 24 bytes each).
LISTED = 1_000_000

MARK = "\u0001"  # set before a name
NAME_AT = r"(?<=[\p{L}0-9,;)][ ])(?=\p{Lu}\p{Ll})"
TOKEN = rf"{MARK}?\p{{L}}+|[0-9]+(?:[.,:/][0-9]+)*|[%$€£°]"
NUMBER_WORDS = (
    "two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million "
    "zwei drei vier fünf sechs sieben acht neun zehn elf zwölf zwanzig hundert tausend "
    "deux trois quatre cinq sept huit dix onze douze vingt cent mille "
    "dos tres cuatro cinco seis siete ocho nueve diez once doce veinte cien mil"
).split()
UNITS = (
    "% $ € £ ° mm cm m km kilometers kilometres meters metres miles mile feet foot inches inch yards "
    "mg g kg grams gram kilograms tons tonnes pounds ounces lb oz ml l liters litres gallons "
    "s sec seconds second min minutes minute h hours hour days day weeks week months month years year "
    "mph kmh degrees percent dollars dollar cents euros euro bucks usd eur gbp "
    "stunden stunde minuten tage wochen jahre meter heures jours semaines ans mètres horas días semanas años metros"
).split()


def _digit(token: Column) -> Column:
    return F.substring(token, 1, 1).between("0", "9")


def _form(token: Column, before: Column) -> Column:
    """A token's canonical form: a typed placeholder or the lower-cased word."""
    word = F.lower(token)
    after_number = _digit(before) | F.lower(before).isin(NUMBER_WORDS)
    return (
        F.when(_digit(token) | word.isin(NUMBER_WORDS), "#n")
        .when(F.startswith(token, F.lit(MARK)), "#p")
        .when(word.isin(UNITS) & after_number, "#u")
        .otherwise(word)
    )


def tokenized(texts: DataFrame) -> DataFrame:
    """Adds ``tokens`` of ``text``; names carry a mark."""
    marked = F.regexp_replace(F.translate(F.coalesce("text", F.lit("")), MARK, " "), NAME_AT, MARK)
    return texts.withColumn("tokens", F.regexp_extract_all(marked, F.lit(TOKEN), F.lit(0)))


def _with_forms(texts: DataFrame) -> DataFrame:
    before = F.slice(F.concat(F.array(F.lit("")), F.col("tokens")), F.lit(1), F.size("tokens"))
    return texts.withColumn("forms", F.zip_with("tokens", before, _form))


def _plain(token: Column) -> Column:
    """A token as text: lower-cased, without the mark of a name."""
    return F.lower(F.translate(token, MARK, ""))


def _with_hashes(texts: DataFrame, exact: bool) -> DataFrame:
    before = F.slice(F.concat(F.array(F.lit("")), F.col("tokens")), F.lit(1), F.size("tokens"))
    hashes = F.zip_with("tokens", before, lambda token, prev: F.xxhash64(_form(token, prev)))
    texts = texts.withColumn("h1", hashes)
    if exact:
        texts = texts.withColumn("v1", F.transform("tokens", lambda token: F.xxhash64(_plain(token))))
    return texts.drop("tokens", "text")


def _join_spans(left: str | Column, right: str | Column, gap: int) -> Column:
    """Hash of each span with the one that starts ``gap`` tokens later."""
    right = F.col(right) if isinstance(right, str) else right
    shifted = F.slice(right, F.lit(gap + 1), F.greatest(F.size(right) - gap, F.lit(0)))
    return F.zip_with(left, shifted, lambda a, b: F.xxhash64(a, b))


def windowed(texts: DataFrame, lengths: list[int], exact: list[int] = ()) -> DataFrame:
    """(key columns, exact, k, pos, hash) of all windows of the given lengths; drops the other columns.

    Windows of ``lengths`` are hashed by their forms, those of ``exact`` by their tokens as text.
    """
    keys = [c for c in texts.columns if c not in ("text", "tokens", "forms")]
    work, sets = _with_hashes(tokenized(texts), bool(exact)), []
    for kind, wanted in (("h", lengths), ("v", exact)):
        size = 1
        while wanted and 2 * size <= max(wanted):
            work = work.withColumn(f"{kind}{2 * size}", _join_spans(f"{kind}{size}", f"{kind}{size}", size))
            size *= 2
        for k in wanted:
            span = 1 << (k.bit_length() - 1)
            column, at = F.col(f"{kind}{span}"), span
            for bit in reversed(range(k.bit_length() - 1)):
                if k >> bit & 1:
                    column = _join_spans(column, f"{kind}{1 << bit}", at)
                    at += 1 << bit
            hashes = F.slice(column, F.lit(1), F.greatest(F.size(f"{kind}1") - (k - 1), F.lit(0)))
            work = work.withColumn(f"w{kind}{k}", hashes)
            sets.append(F.struct(F.lit(kind == "v").alias("exact"), F.lit(k).alias("k"), F.col(f"w{kind}{k}").alias("hashes")))
    return work.select(*keys, F.explode(F.array(*sets)).alias("s")).select(
        *keys, F.col("s.exact").alias("exact"), F.col("s.k").alias("k"), F.posexplode("s.hashes").alias("pos", "hash")
    )


def _telling(forms: str | Column, k: str | Column, literals: int) -> Column:
    words = F.size(F.filter(forms, lambda f: ~F.startswith(f, F.lit("#"))))
    return words >= F.least(F.lit(literals), k)


def benchmark_windows(items: DataFrame, width: int, literals: int) -> DataFrame:
    """(item_id, exact, k, item_pos, hash, of, windows): the windows to look up (runs a job).

    Telling windows go by their forms. The others go by their tokens as text, and so does the first
    window of an item that is short or has such others, since what stands before it in a document
    can change its form. ``of`` counts the telling windows of the item, ``windows`` all.
    """
    formed = _with_forms(tokenized(items))
    formed = stage(formed.select("item_id", "text", "tokens", "forms").dropDuplicates(["item_id", "text"]), "items")
    lengths = sorted(
        {
            min(width, r["n"])
            for r in formed.select(F.least(F.size("forms"), F.lit(width)).alias("n")).distinct().collect()
            if r["n"] > 0
        }
    )  # at most ``width`` values
    if not lengths:
        names = "item_id long, exact boolean, k int, item_pos int, hash long, of long, windows long"
        return items.sparkSession.createDataFrame([], names)
    hashed = windowed(formed.select("item_id", "text", F.size("forms").alias("n")), lengths, lengths)
    wide = hashed.where(F.col("k") == F.least("n", F.lit(width)))
    full = wide.join(formed.select("item_id", "forms"), "item_id").select(
        "item_id",
        "exact",
        "k",
        F.col("pos").alias("item_pos"),
        "hash",
        (F.col("n") <= width).alias("short"),
        _telling(F.slice("forms", F.col("pos") + 1, F.col("k")), F.col("k"), literals).alias("telling"),
    )
    item = Window.partitionBy("item_id")
    counted = full.withColumn("of", F.count(F.when(~F.col("exact") & F.col("telling"), 1)).over(item)).withColumn(
        "windows", F.count(F.when(~F.col("exact"), 1)).over(item)
    )
    first = (F.col("item_pos") == 0) & (F.col("short") | (F.col("of") < F.col("windows")))
    by_text = F.col("exact") & (~F.col("telling") | first)
    return counted.where(by_text | (~F.col("exact") & F.col("telling"))).drop("short", "telling")


def leaks(
    docs: DataFrame, items: DataFrame, width: int = WIDTH, literals: int = 4, share: float = 0.25
) -> DataFrame:
    """(doc_id, item_id, n_windows, share, n_slots, n_changed) of contaminated documents (runs jobs).

    ``docs`` has doc_id and text, ``items`` item_id and text. ``share`` is the larger of two: found
    telling windows among the telling ones, and found windows among all. Rows that share an id, or
    have none, are judged together. A document with several leaked items has several rows.
    """
    bench = stage(benchmark_windows(items, width, literals), "windows")
    kinds = bench.select("exact", "k").distinct().collect()  # at most two for each length
    lengths = sorted(r["k"] for r in kinds if not r["exact"])
    exact = sorted(r["k"] for r in kinds if r["exact"])
    if not kinds:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, item_id long, n_windows long, share double, n_slots long, n_changed long"
        )
    small = bench.count() <= LISTED
    keys = F.broadcast(bench) if small else bench
    hits = windowed(docs, lengths, exact).join(keys, ["exact", "k", "hash"])
    found = (
        hits.withColumn("gap", F.col("pos") - F.col("item_pos"))
        .groupBy("doc_id", "item_id", "of", "windows", "k", "gap")
        .agg(F.sort_array(F.collect_set("item_pos")).alias("at"))  # bounded by the item's windows
    )
    found = stage(found, "hits")
    some = found.groupBy("doc_id", "item_id").agg(
        F.sum(F.size("at")).alias("n"), F.max(F.size("at")).alias("most"), F.first("of").alias("of")
    )
    # a run of RUN tokens holds RUN - width + 1 windows, of which the first can have another form
    some = some.where((F.col("n") >= share * F.col("of")) | (F.col("most") >= RUN - width)).select("doc_id", "item_id")
    found = stage(found.join(some, _same(found, some, "doc_id", "item_id"), "left_semi"), "near")

    ids = found.select("doc_id").distinct()
    ids = F.broadcast(ids) if ids.count() <= LISTED else ids
    texts = docs.join(ids, docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")
    texts = _with_forms(tokenized(texts)).select("doc_id", F.transform("tokens", _plain).alias("plain"), "forms")
    shown = items.select("item_id", "text").dropDuplicates(["item_id", "text"])
    shown = _with_forms(tokenized(shown)).select(
        F.col("item_id").alias("item"),
        F.transform("tokens", _plain).alias("item_plain"),
        F.col("forms").alias("item_forms"),
    )
    aligned = (
        found.withColumnRenamed("doc_id", "id")
        .join(texts, F.col("id").eqNullSafe(texts["doc_id"]))
        .join(shown, F.col("item_id").eqNullSafe(F.col("item")))
    )
    start, k = F.col("gap"), F.col("k")

    def equal(theirs: str, own: str):
        return lambda p: F.slice(theirs, start + p + 1, k) == F.slice(own, p + 1, k)

    def places(windows: str) -> Column:
        return F.array_distinct(F.flatten(F.transform(windows, lambda p: F.sequence(p, p + k - 1))))

    def slots(places: str) -> Column:
        held = F.filter(places, lambda p: F.startswith(F.get("item_forms", p), F.lit("#")))
        return F.transform(
            held,
            lambda p: F.struct(p.alias("p"), F.get("item_plain", p).alias("was"), F.get("plain", start + p).alias("now")),
        )

    def values(slots: Column) -> Column:
        return F.array_distinct(F.transform(slots, lambda s: F.struct(s["was"].alias("was"), s["now"].alias("now"))))

    # the longest run of tokens that are equal as text
    agree = F.transform(
        F.sequence(F.lit(0), F.size("item_plain") - 1),
        lambda p: F.coalesce(F.get("item_plain", p) == F.get("plain", start + p), F.lit(False)),
    )

    def longer(so_far: Column, same: Column) -> Column:
        now = F.when(same, so_far["now"] + 1).otherwise(F.lit(0))
        return F.struct(now.alias("now"), F.greatest(so_far["best"], now).alias("best"))

    run = F.aggregate(agree, F.struct(F.lit(0).alias("now"), F.lit(0).alias("best")), longer, lambda x: x["best"])
    known = F.filter("at", lambda p: equal("forms", "item_forms")(p) | equal("plain", "item_plain")(p))
    aligned = (
        aligned.where(F.size("item_forms") > 0)
        .withColumn("same", known)
        .where(F.size("same") > 0)
        .withColumn("run", run)
        .withColumn("places", places("same"))
        .withColumn("changed", F.filter(slots("places"), lambda s: s["was"] != s["now"]))
        .withColumn("values", values(F.col("changed")))
    )
    # a value of the item that changed into several: its changed places speak against their windows
    torn = F.filter(
        "changed", lambda c: F.size(F.filter("values", lambda v: v["was"] == c["was"])) > 1
    )
    aligned = (
        aligned.withColumn("torn", F.transform(torn, lambda c: c["p"]))
        .withColumn("kept", F.filter("same", lambda p: ~F.exists("torn", lambda c: c.between(p, p + k - 1))))
        .withColumn("covered", places("kept"))
        .where("size(kept) > 0")
        .where((F.size("torn") == 0) | (F.size("covered") >= RUN) | (2 * F.size("kept") >= F.col("windows")))
        .withColumn("slots", values(slots("covered")))
        .withColumn("told", F.filter("kept", lambda p: _telling(F.slice("item_forms", p + 1, k), k, literals)))
    )
    return (
        aligned.groupBy(F.col("id").alias("doc_id"), "item_id", "of", "windows")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_set("kept")))).cast("long").alias("n_windows"),
            F.size(F.array_distinct(F.flatten(F.collect_set("told")))).alias("n_told"),
            F.max("run").alias("run"),
            F.max(F.size("slots")).cast("long").alias("n_slots"),
            F.max(F.size(F.filter("slots", lambda s: s["was"] != s["now"]))).cast("long").alias("n_changed"),
        )
        .withColumn(
            "share",
            F.greatest(F.col("n_windows") / F.col("windows"), F.when(F.col("of") > 0, F.col("n_told") / F.col("of"))),
        )
        .where((F.col("share") >= share) | (F.col("run") >= RUN))
        .select("doc_id", "item_id", "n_windows", "share", "n_slots", "n_changed")
    )


def _same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    out = left[names[0]].eqNullSafe(right[names[0]])
    for name in names[1:]:
        out = out & left[name].eqNullSafe(right[name])
    return out


def contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """One row per document: whether it holds a benchmark item, which one, and how (runs jobs).

    Null and empty texts are clean. An empty benchmark leaves all documents clean; other columns
    are not read. Of several items, that with the largest share and smallest id is named.
    """
    docs, items = narrow(docs), narrow(items, "item_id").withColumnRenamed("doc_id", "item_id")
    found = leaks(docs, items, **options)
    best = found.groupBy(F.col("doc_id").alias("id")).agg(
        F.max_by(F.struct("item_id", "share", "n_windows", "n_changed"), F.struct("share", -F.col("item_id"))).alias("best"),
        F.count(F.lit(1)).alias("n_items"),
    )
    best = stage(best, "leaks")
    return docs.join(best, docs["doc_id"].eqNullSafe(best["id"]), "left").select(
        "doc_id",
        F.col("best").isNotNull().alias("contaminated"),
        F.col("best.item_id").alias("item_id"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("best.n_windows", F.lit(0).cast("long")).alias("n_windows"),
        F.coalesce("best.share", F.lit(0.0)).alias("share"),
        F.coalesce(F.col("best.n_changed") > 0, F.lit(False)).alias("reparameterised"),
    )


def remove_leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; all columns stay."""
    found = leaks(narrow(docs), narrow(items, "item_id").withColumnRenamed("doc_id", "item_id"), **options)
    found = stage(found.select(F.col("doc_id").alias("leaked")).distinct(), "leaks")
    return docs.join(found, docs["doc_id"].eqNullSafe(found["leaked"]), "left_anti")


def op4_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
