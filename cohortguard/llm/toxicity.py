"""Toxicity scores from a counterfactually regularised linear classifier.

Features of a text are its lower-cased words and their first four and five
letters, each present or absent.  A logistic model is fitted on labelled rows
with a second penalty: wherever a labelled sentence names a group of people,
the name is swapped for every other one of its list, and the squared change of
the score is charged.  Group names thus cannot carry the verdict, which keeps
neutral mentions of groups from being rejected.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, text_or_empty

# Lists of group names; names in one list replace each other.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrant", "refugee", "foreigner", "native"),
    ("blind", "deaf", "disabled", "autistic"),
    ("frauen", "männer"), ("christen", "muslime", "juden"),
    ("femmes", "hommes"), ("chrétiens", "musulmans", "juifs"),
    ("mujeres", "hombres"), ("cristianos", "musulmanes", "judíos"),
)
#: Labelled rows the model is fitted on at most (those of smallest id hash).
MAX_ROWS = 20_000
#: Evidence features kept at most.
MAX_FEATURES = 4096

_WORD = re.compile(r"[^\W\d_]+")
_STEMS = (4, 5)
_CACHE_WORDS = 200_000


def word_features(word: str) -> list[str]:
    """The word itself and its stems (marked ``*``)."""
    return [word, *(f"{word[:n]}*" for n in _STEMS if len(word) > n)]


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


@dataclass(frozen=True)
class ToxicityModel:
    """Feature weights and bias; ``score`` is a probability."""
    weights: dict[str, float]
    bias: float

    def score_texts(self, texts, cache: dict[str, tuple[str, ...]] | None = None) -> list[float]:
        cache = {} if cache is None else cache
        known, out = self.weights, []
        for text in texts:
            hits: set[str] = set()
            for w in words_of(text):
                found = cache.get(w)
                if found is None:
                    found = cache[w] = tuple(f for f in word_features(w) if f in known)
                hits.update(found)
            if len(cache) > _CACHE_WORDS:
                cache.clear()
            # summed in one order, so equal texts get equal scores anywhere
            z = self.bias + sum(known[f] for f in sorted(hits))
            out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
        return out

    def score(self, text: str | Column) -> Column:
        """A column with the score of a text column; null counts as empty."""
        model = self

        @F.pandas_udf("double")
        def toxicity_score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            cache: dict[str, tuple[str, ...]] = {}
            for batch in batches:
                yield pd.Series(model.score_texts(batch, cache), dtype="float64")

        return toxicity_score(F.col(text) if isinstance(text, str) else text)


def held_out(doc_id: str | Column) -> Column:
    """Rows never learnt from: ``crc32`` of the id as text is a multiple of 5
    (a null id counts as an empty text, which is)."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(text_or_empty(col.cast("string")).cast("binary")) % 5 == 0


def _swaps(words: set[str], terms) -> Iterator[tuple[str, str]]:
    for group in terms:
        for old in group:
            if old in words:
                yield from ((old, new) for new in group if new != old)


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist()):
            counts[label].update({f for w in words_of(text) for f in word_features(w)})
    keys = list(counts[0].keys() | counts[1].keys())
    for i in range(0, len(keys), 50_000):
        part = keys[i:i + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array([counts[0][k] for k in part], pa.int64()),
             pa.array([counts[1][k] for k in part], pa.int64())], names=["feature", "clean", "toxic"])


def _descend(rows: list[tuple[int, list[int]]], swaps: list[tuple[list[int], list[int]]], width: int,
             bias: float, l2: float, counterfactual: float, steps: int) -> tuple[np.ndarray, float]:
    """Full-batch Adam on log loss + l2·|w|² + counterfactual·mean (w·Δ)²."""
    def flat(lists):
        return (np.repeat(np.arange(len(lists)), [len(x) for x in lists]),
                np.array([j for x in lists for j in x], dtype=np.int64))

    y = np.array([label for label, _ in rows], dtype=float)
    at, col = flat([x for _, x in rows])
    out_at, out_col = flat([x for x, _ in swaps])
    in_at, in_col = flat([x for _, x in swaps])
    theta = np.zeros(width + 1)
    theta[width] = bias
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        w = theta[:width]
        z = theta[width] + np.bincount(at, w[col], len(y))
        err = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        grad = np.zeros(width + 1)
        grad[:width] = np.bincount(col, err[at], width) / len(y) + 2 * l2 * w
        grad[width] = err.mean()
        if swaps:
            delta = np.bincount(in_at, w[in_col], len(swaps)) - np.bincount(out_at, w[out_col], len(swaps))
            grad[:width] += 2 * counterfactual / len(swaps) * (
                np.bincount(in_col, delta[in_at], width) - np.bincount(out_col, delta[out_at], width))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta - 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return theta[:width], float(theta[width])


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", *, terms=IDENTITY_TERMS, max_rows: int = MAX_ROWS,
                 max_features: int = MAX_FEATURES, l2: float = 3e-6, counterfactual: float = 10.0,
                 min_count: int = 5, min_z: float = 4.0, steps: int = 800) -> ToxicityModel:
    """Fit on at most ``max_rows`` labelled rows that are not held out.

    The sampled label rows (``max_rows`` at most) are broadcast to the
    documents; features are counted per class inside the tasks and summed by
    Spark.  Evidence features are those over-represented in toxic rows by
    ``min_z`` standard errors of the log odds; features of the group names
    always take part, so that the penalty can hold them level.  What reaches
    the driver is bounded: per sampled row, its evidence features.

    Rows with a null label are not learnt from; rows whose label is 1 count
    as toxic.  Without labelled rows the model scores every text 0.25.
    """
    picked = F.broadcast(
        labels.where(F.col(label_col).isNotNull() & ~held_out(id_col))
        .select(F.col(id_col).alias("_id"), (F.col(label_col) == 1).cast("int").alias("label"))
        .orderBy(F.xxhash64("_id"), "_id", "label").limit(max_rows))
    train = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
             .join(picked, "_id").select("text", "label"))
    n = {r.label: r.n for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = n.get(0, 0), n.get(1, 0)
    prior = (toxic + 0.5) / (clean + toxic + 2)
    bias = math.log(prior / (1 - prior))
    if not clean or not toxic:
        return ToxicityModel({}, bias)
    p1, p0 = (F.col("toxic") + 0.5), (F.col("clean") + 0.5)
    z = ((F.log(p1 / F.lit(toxic + 1)) - F.log(p0 / F.lit(clean + 1))) / F.sqrt(1 / p1 + 1 / p0))
    evidence = (train.mapInArrow(_feature_counts, "feature string, clean long, toxic long")
                .groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
                .where(F.col("toxic") >= min_count).withColumn("z", z).where(F.col("z") >= min_z)
                .orderBy(F.col("z").desc(), "feature").limit(max_features))
    names = [r.feature for r in evidence.select("feature").collect()]
    names += sorted({f for g in terms for t in g for f in word_features(t)} - set(names))
    index = {f: i for i, f in enumerate(names)}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, outs, ins = [], [], []
            for text in batch["text"].to_pylist():
                words = words_of(text)
                have = {f for w in words for f in word_features(w)}
                rows.append(sorted(index[f] for f in have if f in index))
                gone, new = [], []
                for old, term in _swaps(words, terms):
                    after = {f for w in (words - {old}) | {term} for f in word_features(w)}
                    gone.append(sorted(index[f] for f in have - after if f in index))
                    new.append(sorted(index[f] for f in after - have if f in index))
                outs.append(gone)
                ins.append(new)
            nested = pa.list_(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch["label"], pa.array(rows, pa.list_(pa.int32())), pa.array(outs, nested),
                 pa.array(ins, nested)], names=["label", "features", "swapped_out", "swapped_in"])

    found = train.mapInArrow(encode, "label int, features array<int>, swapped_out array<array<int>>,"
                                     " swapped_in array<array<int>>").collect()
    found.sort(key=lambda r: (r.label, r.features))
    swaps = [s for r in found for s in zip(r.swapped_out, r.swapped_in)]
    w, bias = _descend([(r.label, r.features) for r in found], swaps, len(names), bias, l2, counterfactual, steps)
    return ToxicityModel({f: float(x) for f, x in zip(names, w) if abs(x) > 1e-6}, bias)


def toxicity_scores(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id",
                    text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``id_col, held_out, score, predicted`` for every row.

    A null or empty text gets the model's base score; repeated rows get equal
    scores; other columns are ignored; an empty table gives an empty result.
    """
    scored = docs.select(F.col(id_col), held_out(id_col).alias("held_out"),
                         model.score(text_col).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text",
               threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``."""
    score = fresh("score")
    return docs.withColumn(score, model.score(text_col)).where(F.col(score) < threshold).select(*docs.columns)
