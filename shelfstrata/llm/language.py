"""Language identification by nearest centroids.

A text is a vector of hashed character n-grams (one to three characters, words bounded by spaces) weighed by
TF-IDF and normalised to length 1. Each language has several centroids, found by spherical k-means, since
texts of one language come in kinds (prose, lists, capitals). A text gets the language of the centroid with
the highest cosine; if its distance from that centroid is well beyond that of nearly all training texts of
its length, it is rejected.

Document frequencies are counted over all training rows. Clustering uses at most `FIT_ROWS` rows of each
language, those with small hashes, which bounds its memory; every row is then classified.

Defined cases: a NULL text or one without a letter is `und` with score 0, and rejected; without training
rows every text is; rows that repeat an id are classified each by itself; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstrata.llm.common import bounded_sample, held_out, ship_code, table

UNKNOWN = "und"
DIMENSIONS = 1 << 13
GRAMS = (1, 2, 3)
CENTROIDS = 4
FIT_ROWS = 1_000
ROUNDS = 12
#: A text is rejected below this share of the cosine that 99 of 100 training texts of its length reach.
REJECT_BELOW = 0.5
#: Lengths are told apart by powers of two of their letters, up to this one.
LENGTHS = 16

_FACTORS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], dtype=np.uint32)


class _Letters:
    """Code points to themselves if letters, else to 0."""

    def __init__(self) -> None:
        self.is_letter = np.array([chr(c).isalpha() for c in range(0x10000)])

    def __call__(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = self.is_letter[np.minimum(codes, 0xFFFF)]
        for c in np.unique(codes[codes > 0xFFFF]):
            letter[codes == c] = chr(c).isalpha()
        codes = np.where(letter, codes, 0)
        return codes[(codes > 0) | np.append(True, codes[:-1] > 0)] if len(codes) else codes


def _vector(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashed n-grams of letter codes and how often each occurs."""
    codes = np.concatenate([[0], codes, [0]]).astype(np.uint32)
    hashes = []
    for n in GRAMS:
        h = np.full(max(0, len(codes) - n + 1), n, dtype=np.uint32)
        for i in range(n):
            h = (h ^ codes[i : len(codes) - n + 1 + i]) * _FACTORS[i]
            h ^= h >> np.uint32(15)
        hashes.append(h & np.uint32(DIMENSIONS - 1))
    counts = np.bincount(np.concatenate(hashes), minlength=DIMENSIONS)
    grams = np.flatnonzero(counts)
    return grams, counts[grams]


def _weighed(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weights = (1.0 + np.log(counts)) * idf
    return weights / max(np.linalg.norm(weights), 1e-12)


def _length(letters: int) -> int:
    return min(int(letters).bit_length(), LENGTHS)


@dataclass(frozen=True)
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    floors: np.ndarray  # lowest cosine by length that is not rejected


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters, seen, rows = _Letters(), np.zeros(DIMENSIONS, dtype=np.int64), 0
    for batch in batches:
        for text in batch.column("text"):
            codes = letters(text.as_py() or "")
            if codes.any():
                seen[_vector(codes)[0]] += 1
                rows += 1
    grams = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(grams, -1)), pa.array(np.append(seen[grams], rows))], ["gram", "n"])


def _clustered(x: np.ndarray, k: int) -> np.ndarray:
    """Centroids of length 1 by spherical k-means, started from rows far from those taken before."""
    centres = [x.mean(axis=0)]
    while len(centres) < min(k, len(x)):
        near = np.max([x @ (c / max(np.linalg.norm(c), 1e-12)) for c in centres], axis=0)
        centres.append(x[np.argsort(near, kind="stable")[len(x) // 20]])
    c = np.array(centres, dtype=np.float32)
    for _ in range(ROUNDS):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        nearest = (x @ c.T).argmax(axis=1)
        c = np.array([x[nearest == i].mean(axis=0) if (nearest == i).any() else c[i] for i in range(len(c))], dtype=np.float32)
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


def _fitter(idf: np.ndarray) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        letters = _Letters()
        x, lengths = np.zeros((min(len(rows), FIT_ROWS), DIMENSIONS), dtype=np.float32), []
        for text in rows.sort_values("key", kind="stable")["text"][:FIT_ROWS]:
            codes = letters(text)
            if codes.any():
                grams, counts = _vector(codes)
                x[len(lengths), grams] = _weighed(counts, idf[grams])
                lengths.append(_length(np.count_nonzero(codes)))
        x = x[: len(lengths)]
        if not len(x):
            return pd.DataFrame({"lang": [], "centroid": [], "floors": []})
        c = _clustered(x, CENTROIDS)
        near, lengths = (x @ c.T).max(axis=1), np.array(lengths)
        floors = np.array([np.quantile(near[lengths == n], 0.01) if (lengths == n).any() else np.nan for n in range(LENGTHS + 1)])
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "centroid": [v.tobytes() for v in c], "floors": floors.astype(np.float64).tobytes()})

    return fit


def fit(labelled: DataFrame) -> Model:
    """A model learnt from the rows of `labelled` (doc_id, text, lang); rows where either is NULL are left out."""
    ship_code(labelled.sparkSession)
    rows = labelled.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    counted = rows.select("text").mapInArrow(_document_frequencies, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    seen = {r.gram: r.n for r in counted.collect()}  # a row per dimension at most
    total = seen.pop(-1, 0)
    idf = np.log((1 + total) / (1 + np.array([seen.get(g, 0) for g in range(DIMENSIONS)]))) + 1
    chosen = bounded_sample(rows, "lang", ["doc_id", "text"], FIT_ROWS).withColumnRenamed("_place", "key")
    fitted = chosen.select("lang", "text", "key").groupBy("lang").applyInPandas(_fitter(idf), "lang string, centroid binary, floors binary")
    found = sorted(fitted.collect(), key=lambda r: (r.lang, bytes(r.centroid)))  # a few rows per language
    centroids = np.array([np.frombuffer(r.centroid, dtype=np.float32) for r in found]).reshape(-1, DIMENSIONS)
    floors = np.array([np.frombuffer(r.floors) for r in found]).reshape(-1, LENGTHS + 1)
    floors = np.fmin.reduce(floors, axis=0) if len(floors) else np.zeros(LENGTHS + 1)
    # Longer texts come nearer to a centroid, so a length without training texts has the floor of the shorter
    # ones; below all of them nothing is rejected.
    floors = np.append(0.0, floors)
    floors = floors[np.maximum.accumulate(np.where(np.isnan(floors), 0, np.arange(len(floors))))][1:]
    return Model([r.lang for r in found], centroids, idf, REJECT_BELOW * floors)


def _classifier(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, by_gram = _Letters(), np.ascontiguousarray(model.centroids.T)
        for batch in batches:
            languages, scores, rejected = [], [], []
            for text in batch.column("text"):
                codes = letters(text.as_py() or "")
                if not codes.any() or not len(by_gram.T):
                    languages.append(UNKNOWN), scores.append(0.0), rejected.append(True)
                    continue
                grams, counts = _vector(codes)
                cosine = _weighed(counts, model.idf[grams]) @ by_gram[grams]
                best = int(cosine.argmax())
                languages.append(model.languages[best])
                scores.append(float(min(max(cosine[best], 0.0), 1.0)))
                rejected.append(bool(cosine[best] < model.floors[_length(np.count_nonzero(codes))]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(languages, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    return classify


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of `docs`: doc_id, lang_pred, score (cosine with the nearest centroid), rejected."""
    classify = _classifier(model)
    return docs.select("doc_id", "text").mapInArrow(classify, "doc_id long, lang_pred string, score double, rejected boolean")


def drop_rejected(docs: DataFrame) -> DataFrame:
    """`docs` without the rows whose language is not recognised, by a model learnt from the rest."""
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    classify = _classifier(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdict = next(classify(iter([batch])))
            yield batch.filter(pc.invert(verdict.column("rejected")))

    return docs.mapInArrow(keep, docs.schema)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs, model).withColumn("held_out", held_out(F.col("doc_id"))).select("doc_id", "held_out", "lang_pred", "score", "rejected")
