"""Language identification by nearest centroid.

A text is a TF-IDF vector of byte n-grams (two and three bytes of the lower-cased
text, hashed to a fixed number of features), normalised to length 1. Every language
has several centroids, found by spherical k-means on a bounded sample of labelled
documents. A text gets the language of the centroid with the largest cosine. It is
rejected when it lies farther from that centroid than all but ``REJECTED`` of the
sampled texts of its language and length.

Fitting sees at most ``SAMPLE`` documents a language, and every language is fitted in a
task of its own; the driver gets centroids only. Predicting is narrow: only the text
goes to Python, as Arrow batches, and nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowgate.llm.frames import read, with_columns, written

FEATURES = 4096
SAMPLE = 600
CENTROIDS = 3
ROUNDS = 12
# Part of a language's own texts that may lie beyond the distance of rejection.
REJECTED = 0.005
# Quantiles of few texts are unsure: from MANY on a centroid has its own, from SOME on
# its language has, each with some slack; with fewer, half the least cosine holds.
MANY, SOME, SLACK = 100, 20, 0.8
CLASSES = 7
UNKNOWN = "und"

RESULT = "lang_pred string, score double, rejected boolean"
LETTER = re.compile(r"[^\W\d_]")
# Every ASCII byte that is no letter becomes a blank; other bytes stay.
BLANKED = bytes(
    c if c >= 128 or chr(c).isalpha() else 32 for c in range(256)
)


def hashed(codes: np.ndarray) -> np.ndarray:
    mixed = codes.astype(np.uint32) * np.uint32(0x9E3779B1)
    return (mixed ^ (mixed >> np.uint32(15))) & np.uint32(FEATURES - 1)


def features(text: str) -> np.ndarray | None:
    """Counts per feature; null without any letter."""
    if not LETTER.search(text):
        return None
    raw = f" {text.lower()} ".encode("utf-8", "surrogatepass").translate(BLANKED)
    code = np.frombuffer(raw, np.uint8).astype(np.uint32)
    two = (code[:-1] << np.uint32(8)) | code[1:]
    two = two[two != 0x2020]
    three = (code[:-2] << np.uint32(16)) | (code[1:-1] << np.uint32(8)) | code[2:]
    # A gram with two blanks in a row says nothing about the language.
    three = three[((three >> np.uint32(8)) != 0x2020) & ((three & np.uint32(0xFFFF)) != 0x2020)]
    grams = np.concatenate([hashed(two + np.uint32(1 << 24)), hashed(three)])
    return np.bincount(grams, minlength=FEATURES)


def length_class(counts: np.ndarray) -> int:
    """0 for up to 15 n-grams, then one class per factor 4."""
    return min(int(max(np.log2(counts.sum() + 1) - 4, 0) // 2) + (counts.sum() > 15), CLASSES - 1)


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weights = np.log1p(counts).astype(np.float32) * idf
    return weights / max(float(np.linalg.norm(weights)), 1e-12)


@dataclass(frozen=True)
class Model:
    """``centroids`` are unit rows; ``floors`` has their least cosines per length class."""

    languages: tuple[str, ...]
    owners: np.ndarray
    centroids: np.ndarray
    idf: np.ndarray
    floors: np.ndarray

    def vector(self, counts: np.ndarray) -> np.ndarray:
        return vector(counts, self.idf)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        counts = None if text is None else features(text)
        if counts is None or not len(self.languages):
            return UNKNOWN, 0.0, True
        cosines = self.centroids @ self.vector(counts)
        best = int(np.argmax(cosines))
        score = float(min(max(cosines[best], 0.0), 1.0))
        floor = self.floors[best, length_class(counts)]
        return self.languages[self.owners[best]], score, bool(score < floor)


def k_means(vectors: np.ndarray, k: int) -> np.ndarray:
    """Unit centroids. Starts are the means of equal parts along the direction of largest
    variance, so outliers do not become centroids and a rerun gives the same."""
    middle = vectors - vectors.mean(axis=0)
    direction = middle[int(np.argmax((middle**2).sum(axis=1)))]
    for _ in range(ROUNDS):
        direction = middle.T @ (middle @ direction)
        direction /= max(float(np.linalg.norm(direction)), 1e-12)
    parts = np.array_split(np.argsort(middle @ direction, kind="stable"), min(k, len(vectors)))
    centroids = np.stack([vectors[p].mean(axis=0) for p in parts])
    for _ in range(ROUNDS):
        centroids /= np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-12)
        near = np.argmax(vectors @ centroids.T, axis=1)
        centroids = np.stack(
            [vectors[near == j].sum(axis=0) if (near == j).any() else centroids[j] for j in range(len(centroids))]
        )
    return centroids / np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-12)


def floors_of(cosines: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The least accepted cosine of every centroid and length class, from the cosines of a
    language's texts to its centroids. A class without texts takes the next shorter one's."""
    near, best = np.argmax(cosines, axis=1), cosines.max(axis=1)
    floors = np.zeros((cosines.shape[1], CLASSES))
    before = 0.0
    for c in range(CLASSES):
        own = best[classes == c]
        if len(own) >= SOME:
            before = SLACK * float(np.quantile(own, REJECTED))
        elif len(own):
            before = 0.5 * float(own.min())
        floors[:, c] = before
        for j in range(cosines.shape[1]):
            cell = best[(classes == c) & (near == j)]
            if len(cell) >= MANY:
                floors[j, c] = SLACK * float(np.quantile(cell, REJECTED))
    return floors


def fitted_language(sample: pd.DataFrame, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centroids and their floors from one language's (order, features, counts)."""
    sample = sample.sort_values("order", kind="stable")
    vectors, classes = [], []
    for ids, numbers in zip(sample["features"], sample["counts"], strict=True):
        counts = np.zeros(FEATURES, np.int32)
        counts[np.asarray(ids, np.int64)] = numbers
        vectors.append(vector(counts, idf))
        classes.append(length_class(counts))
    vectors = np.stack(vectors)
    centroids = k_means(vectors, CENTROIDS).astype(np.float32)
    return centroids, floors_of(vectors @ centroids.T, np.array(classes))


def bucket_of(key: Column) -> Column:
    """CRC-32 of the id as text modulo 4; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(4))


def sampled(labelled: DataFrame, size: int = SAMPLE) -> DataFrame:
    """(lang, order, features, counts) of at most ``size`` documents a language; written.

    Documents are drawn by a hash of id and text. Where that draws none of a language,
    because its rows are all alike, the first ones in the order of the hash are taken. A
    document has at most ``FEATURES`` numbers, however long it is.
    """
    labelled = labelled.filter("lang is not null and text is not null")
    rates = labelled.groupBy("lang").count().collect()
    order = F.xxhash64(F.lit("language"), "doc_id", "text")
    rows = labelled.select("lang", order.alias("order"), "text")
    part = F.pmod(F.col("order"), F.lit(1_000_003)) / 1_000_003.0

    def first(rows: DataFrame) -> DataFrame:
        place = F.row_number().over(W.partitionBy("lang").orderBy("order"))
        return rows.withColumn("place", place).filter(F.col("place") <= size).drop("place")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for lang, place, text in batch[["lang", "order", "text"]].itertuples(index=False):
                counts = features(text)
                if counts is not None:
                    ids = np.flatnonzero(counts)
                    found.append((lang, place, ids.astype(np.int32), counts[ids].astype(np.int32)))
            yield pd.DataFrame(found, columns=["lang", "order", "features", "counts"])

    kind = "lang string, order long, features array<int>, counts array<int>"
    if not rates:
        return written(rows.mapInPandas(counted, kind), "sample")
    share = F.create_map(*(F.lit(x) for r in rates for x in (r["lang"], 2 * size / r["count"])))
    drawn = written(first(rows.filter(part < share[F.col("lang")])), "drawn")
    missing = {r["lang"] for r in rates} - {r["lang"] for r in drawn.select("lang").distinct().collect()}
    if missing:
        drawn = drawn.unionByName(first(rows.filter(F.col("lang").isin(sorted(missing)))))
    return written(drawn.mapInPandas(counted, kind), "sample")


def fit(docs: DataFrame) -> Model:
    """Learns from the documents that are not held out, from text and lang alone."""
    return fitted(sampled(docs.select("doc_id", "text", "lang").filter(bucket_of(F.col("doc_id")) != 2)))


def fitted(sample: DataFrame) -> Model:
    """A model from (lang, order, features, counts); its size is that of the centroids."""
    total = sample.count()
    held = sample.select(F.explode("features").alias("feature")).groupBy("feature").count().toPandas()
    counts = np.zeros(FEATURES)
    counts[held["feature"].to_numpy(np.int64)] = held["count"].to_numpy(np.float64)
    idf = (np.log((1 + total) / (1 + counts)) + 1).astype(np.float32)

    def learn(own: pd.DataFrame) -> pd.DataFrame:
        centroids, floors = fitted_language(own, idf)
        return pd.DataFrame({"lang": own["lang"].iloc[0], "centroid": list(centroids), "floors": list(floors)})

    kind = "lang string, centroid array<float>, floors array<double>"
    found = sample.groupBy("lang").applyInPandas(learn, kind).toPandas().sort_values("lang", kind="stable")
    languages = tuple(sorted(found["lang"].unique()))
    if not languages:
        return Model((), np.zeros(0, int), np.zeros((0, FEATURES)), idf, np.zeros((0, CLASSES)))
    return Model(
        languages,
        np.array([languages.index(x) for x in found["lang"]]),
        np.stack(found["centroid"].to_list()).astype(np.float32),
        idf,
        np.stack(found["floors"].to_list()),
    )


def predicted(docs: DataFrame, model: Model, column: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred``, ``score`` (the cosine) and ``rejected``.

    Columns of these names give way. A text that is null or has no letter is ``und``
    with score 0, and rejected. Texts are read whole, one at a time.
    """

    @F.pandas_udf(RESULT)
    def judged(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = [model.predict(text) for text in batch]
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "rejected"])

    done = docs.withColumn("_judged", judged(F.col(f"`{column}`")))
    names = ("lang_pred", "score", "rejected")
    return with_columns(done, **{n: F.col(f"_judged.{n}") for n in names}).drop("_judged")


def op4_centroid_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out.

    Repeated rows get the same answer; without any labelled text all are ``und``.
    """
    docs = read(spark, sf_dir, "documents")
    model = fit(docs)
    return predicted(docs.select("doc_id", "text"), model).select(
        "doc_id", (bucket_of(F.col("doc_id")) == 2).alias("held_out"), "lang_pred", "score",
        "rejected",
    )


QUERIES = {"op4_centroid_language": op4_centroid_language}
# A learned classifier is not expressible in SQL; tests measure held-out accuracy.
SQL: dict[str, str] = {}
