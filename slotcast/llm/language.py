"""Language identification in two levels (operator 8).

The first level tells language families apart by one-versus-rest linear support vector machines,
the second the languages of a family by one-versus-one machines and their votes. Features are
hashed counts of one to three letters, word borders included.

The machines are fitted on the driver from a bounded sample: ``per_language`` labelled documents of
each language, or an equal part of ``cap`` where the languages are many, picked by a hash of the
text. Every labelled language is in it. Everything else reads all documents.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast.llm.common import by_batch, narrow, stage, table

SIZE = 4096
UNDETERMINED = "und"
#: Families of common languages; any other language is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs mk bg",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tt",
    "indic": "hi ur bn pa gu mr ne",
    "semitic": "ar he am mt",
    "sinitic": "zh yue wuu",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family_of(lang: str) -> str:
    return _FAMILY.get(lang.lower().replace("_", "-").split("-")[0], lang)


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def counts(text: str) -> np.ndarray | None:
    """Hashed counts of letter n-grams, scaled to length 1; None where there is no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    letter = _letters()[points]
    if not letter.any():
        return None
    points = np.where(letter, points, 32).astype(np.uint32)
    points = np.concatenate([[32], points, [32]]).astype(np.uint32)
    points = points[np.append(True, (points[1:] != 32) | (points[:-1] != 32))]
    one, two, three = points, points[:-1], points[:-2]
    shift = np.uint32(32 - SIZE.bit_length() + 1)
    hashes = [
        (one * np.uint32(0x9E3779B1)) >> shift,
        ((two * np.uint32(0x85EBCA6B)) ^ (points[1:] * np.uint32(0xC2B2AE35))) >> shift,
        ((three * np.uint32(0x27D4EB2F)) ^ (points[1:-1] * np.uint32(0x165667B1)) ^ (points[2:] * np.uint32(0xD3A2646D))) >> shift,
    ]
    out = np.sqrt(np.bincount(np.concatenate(hashes), minlength=SIZE).astype(np.float32))
    return out / np.linalg.norm(out)


def support_vectors(x: np.ndarray, y: np.ndarray, rounds: int = 150, keep: float = 1e-4) -> np.ndarray:
    """Weights of a linear machine for labels of -1 and 1: squared hinge loss, descent with momentum.

    Both classes weigh the same, whatever their numbers of rows.
    """
    y = y.astype(np.float32)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = np.zeros(x.shape[1], np.float32)
    last = w
    for i in range(rounds):
        ahead = w + np.float32(i / (i + 3)) * (w - last)
        slack = np.maximum(np.float32(0), 1 - y * (x @ ahead))
        gradient = (weight * y * slack) @ x
        last, w = w, (ahead + 0.5 * gradient - 0.5 * keep * ahead).astype(np.float32)
    return w


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1), np.float32)])


def fit(x: np.ndarray, langs: list[str]) -> dict:
    """Machines for the families, and for each pair of languages of a family."""
    names, x = np.array(langs), _with_one(x)
    known = sorted(set(langs))
    families: dict[str, list[str]] = {}
    for lang in known:
        families.setdefault(family_of(lang), []).append(lang)
    of = np.array([family_of(lang) for lang in langs])
    tops = sorted(families)
    top = [support_vectors(x, np.where(of == f, 1.0, -1.0)) for f in tops] if len(tops) > 1 else []
    pairs = {}
    for f in tops:
        for a, b in combinations(families[f], 2):
            rows = (names == a) | (names == b)
            pairs[a, b] = support_vectors(x[rows], np.where(names[rows] == a, 1.0, -1.0))
    return {"tops": tops, "families": families, "top": top, "pairs": pairs}


def _sure(margin: float) -> float:
    return float(1 / (1 + np.exp(-4.0 * np.clip(margin, -5, 5))))


def predict(model: dict, row: np.ndarray) -> tuple[str, float]:
    """The language of a feature row, and how sure both levels are of it, from 0 to 1."""
    row = np.append(row, 1.0)
    score, family = 1.0, model["tops"][0]
    if len(model["tops"]) > 1:
        margins = np.array([w @ row for w in model["top"]])
        best = int(margins.argmax())
        family = model["tops"][best]
        score = _sure(margins[best] - np.delete(margins, best).max())
    langs = model["families"][family]
    if len(langs) == 1:
        return langs[0], score
    votes, sure = dict.fromkeys(langs, 0), dict.fromkeys(langs, 0.0)
    for a, b in combinations(langs, 2):
        p = _sure(float(model["pairs"][a, b] @ row))
        votes[a if p >= 0.5 else b] += 1
        sure[a] += p
        sure[b] += 1 - p
    best = max(langs, key=lambda lang: (votes[lang], sure[lang]))
    return best, score * sure[best] / (len(langs) - 1)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, per_language: int, cap: int) -> DataFrame:
    """Labelled documents for the fit, every labelled language among them (runs jobs).

    Each language gives its texts of smallest hash: ``per_language``, or an equal part of ``cap``
    where that is less, and one at least. Copies of a text count once.
    """
    spark = docs.sparkSession
    known = docs.where("lang is not null").where(F.col("text").rlike("\\p{L}")).where(~held_out())
    place = F.pmod(F.xxhash64("text"), F.lit(2**40)) / F.lit(2.0**40)
    known = known.select(F.col("lang").cast("string").alias("lang"), "text", place.alias("place"))
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("place").alias("n"), F.min("place").alias("low")).collect()
    if not sizes:
        return known.select("lang", "text").limit(0)
    quota = max(1, min(per_language, cap // len(sizes)))
    # thinned to about twice the quota and some more; the quota itself is then cut by rank
    edges = [(r["lang"], max(r["low"], (2.0 * quota + 32) / max(1, r["n"]))) for r in sizes]
    thinned = stage(_under(spark, known, edges).dropDuplicates(["lang", "place"]), "languages")
    places: dict[str, list[float]] = {}
    for r in thinned.select("lang", "place").collect():  # a few numbers for each text of the sample
        places.setdefault(r["lang"], []).append(r["place"])
    edges = [(lang, sorted(found)[:quota][-1]) for lang, found in places.items()]
    return _under(spark, thinned, edges).select("lang", "text")


def _under(spark: SparkSession, texts: DataFrame, edges: list[tuple[str, float]]) -> DataFrame:
    """The texts whose place is not above the edge of their language."""
    bounds = spark.createDataFrame(edges, "lang string, edge double")
    return texts.join(F.broadcast(bounds), "lang").where(F.col("place") <= F.col("edge")).drop("edge")


def train(docs: DataFrame, per_language: int = 600, cap: int = 4000) -> dict | None:
    """The fitted model, or None without labelled text. Reads doc_id, text and lang (runs jobs)."""

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [counts(t) for t in batch.column("text").to_pylist()]
            data = [None if r is None else r.astype("<f4").tobytes() for r in rows]
            return pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(data, pa.binary())], names=["lang", "row"])

        return one

    spread = sample(docs, per_language, cap)
    rows = by_batch(spread, make, "lang string, row binary").where("row is not null").collect()  # ``cap`` rows at most
    if not rows:
        return None
    rows.sort(key=lambda r: (r["lang"], bytes(r["row"])))
    return fit(np.stack([np.frombuffer(r["row"], "<f4") for r in rows]), [r["lang"] for r in rows])


def identify(docs: DataFrame, per_language: int = 600, cap: int = 4000, more: tuple[str, ...] = ()) -> DataFrame:
    """Language of every whole text (runs jobs for the fit).

    Null texts, texts without a letter, and all texts where nothing could be learned are ``und``
    with score 0. A null id is never held out. Repeated rows each get a row; an empty table gives
    an empty result. Columns named in ``more`` are carried along, others are not read.
    """
    work = narrow(docs, "doc_id", "text", "lang")
    model = train(work, per_language, cap)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a weight row per family and pair

    def make():
        model = shared.value

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for text in batch.column("text").to_pylist():
                row = counts(text) if text and model else None
                out.append((UNDETERMINED, 0.0) if row is None else predict(model, row))
            langs, scores = zip(*out)
            drop = [batch.schema.get_field_index("text")]
            keep = [i for i in range(batch.num_columns) if i not in drop]
            return pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in keep], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*[batch.schema.names[i] for i in keep], "lang_pred", "score"],
            )

        return one

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id").cast("string")).alias("held_out"),
        *[F.col(f"`{c}`") for c in more],
        F.col("text").cast("string").alias("text"),
    )
    kinds = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != "text")
    return by_batch(rows, make, f"{kinds}, lang_pred string, score double")


def determined(docs: DataFrame, least: float = 0.0) -> DataFrame:
    """``docs`` without those whose language stays undetermined or scores under ``least``."""
    columns = docs.columns
    packed = docs.select("doc_id", "text", "lang", F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    known = identify(packed, more=("row",)).where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least))
    return known.select(*[F.col("row")[c].alias(c) for c in columns])


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
