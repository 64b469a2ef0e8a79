"""Toxicity from confirmed examples and unlabelled text: non-negative positive-unlabelled learning."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import ALNUM, LOWER, windows, words
from .sampling import agreed_labels, first_by_hash, remainder, with_texts
from .shared import begins_of, cut_by_bytes, keyed_texts, typed

BITS = 20


def features(parts: list[bytes], lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words and word pairs that each document holds (once each), and where each document's begin."""
    data = LOWER[np.frombuffer(b"".join(parts), np.uint8)]
    start, _, hashes = words(data, ALNUM)
    first = np.searchsorted(start, begins_of(lens))
    counts = np.diff(first)
    doc = np.repeat(np.arange(len(counts)), counts)
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    value = np.concatenate((hashes, windows(hashes, pair, 2))) >> np.uint64(64 - BITS)
    owner = np.concatenate((doc, doc[pair])).astype(np.uint64)
    keys = np.unique((owner << np.uint64(BITS)) | value)
    return (keys & np.uint64((1 << BITS) - 1)).astype(np.int64), np.searchsorted(keys >> np.uint64(BITS), np.arange(len(counts) + 1, dtype=np.uint64))


def sums(weights: np.ndarray, index: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0.0], np.cumsum(weights[index])))[first])


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def learnt(positive: list[bytes], unlabelled: list[bytes], prior: float, turns: int = 300, rate: float = 0.05, sparse: float = 0.45, least_documents: int = 5) -> tuple:
    """Weights and bias that minimise the non-negative risk: prior * E_P[l(+)] + max(0, E_U[l(-)] - prior * E_P[l(-)]).

    Weights shrink towards zero, the more the fewer positive examples there are. Words and pairs in fewer than
    ``least_documents`` of the examples have none.
    """
    parts, index, first = positive + unlabelled, [], [np.zeros(1, np.int64)]
    for at in range(0, len(parts), 256):
        block = parts[at : at + 256]
        i, f = features([x for p in block for x in (p, b"\n")], np.array([len(p) for p in block], np.int64))
        index.append(i)
        first.append(f[1:] + first[-1][-1])
    index, first = np.concatenate(index), np.concatenate(first)
    seen = np.bincount(index, minlength=1 << BITS) >= least_documents
    owner = np.repeat(np.arange(len(parts)), np.diff(first))[seen[index]]
    column = (np.cumsum(seen) - 1)[index[seen[index]]]
    first = np.searchsorted(owner, np.arange(len(parts) + 1))
    n, is_positive = len(positive), np.arange(len(parts)) < len(positive)
    weights, bias = np.zeros(int(seen.sum())), np.log(prior / (1 - prior))
    m, v = np.zeros(len(weights) + 1), np.zeros(len(weights) + 1)
    share = np.where(is_positive, 1 / n, 1 / max(len(unlabelled), 1))
    for turn in range(1, turns + 1):
        z = sums(weights, column, first) + bias
        p = logistic(z)
        loss_negative = np.logaddexp(0, z) * share
        negative_risk = loss_negative[~is_positive].sum() - prior * loss_negative[is_positive].sum()
        slope_negative = np.where(is_positive, -prior, 1.0) * p * share
        slope_positive = np.where(is_positive, prior * (p - 1) * share, 0.0)
        slope = slope_positive + slope_negative if negative_risk >= 0 else -slope_negative
        gradient = np.append(np.bincount(column, slope[owner], len(weights)), slope.sum())
        m = 0.9 * m + 0.1 * gradient
        v = 0.999 * v + 0.001 * gradient**2
        step = rate * (1 - turn / (turns + 1))
        move = step * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
        shrink = step * sparse / n / (np.sqrt(v[:-1] / (1 - 0.999**turn)) + 1e-8)
        weights = np.sign(weights) * np.maximum(np.abs(weights) - shrink, 0)
    full = np.zeros(1 << BITS, np.float32)
    full[seen] = weights
    return full, float(bias)


def score_toxicity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 4, held: int = 2, threshold: float = 0.3,
    key: str = "doc_id", text: str = "text", most_positive: int = 2000, most_unlabelled: int = 6000,
    least_documents: int | None = None,
) -> DataFrame:
    """Probability of toxicity for every whole text: ``key``, ``held_out``, ``score``, ``predicted`` (score >= threshold).

    Learns from at most ``most_positive`` confirmed toxic documents and ``most_unlabelled`` of all documents, taken as
    unlabelled whether or not they have a label, none held out; the class prior is the share of toxic labels learnt
    from. Words in fewer than ``least_documents`` of these carry no weight (None: one for twenty toxic ones, from 2 to
    5). Only the text is scored. A null text counts as empty; repeated rows are scored alike; a null key is not held out;
    contradicting or null labels are left out; without toxic examples every score is 0. An empty table gives an
    empty one.
    """
    kind = docs.schema[key].dataType
    known = agreed_labels(labels, key, label)
    usable = known.filter(remainder(F.col("k"), modulus) != held)
    total, toxic = usable.agg(F.count(F.lit(1)), F.sum("y")).first()
    body = None
    if toxic:
        prior = min(max(toxic / total, 0.001), 0.9)
        keys = docs.select(F.col(f"`{key}`").alias("k")).filter(F.col("k").isNotNull() & (remainder(F.col("k"), modulus) != held)).distinct()
        free = first_by_hash(keys, most_unlabelled)
        sample = first_by_hash(usable.filter("y = 1"), most_positive).unionByName(free.withColumn("y", F.lit(-1)))

        def learn(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["k", "t"])
            groups = [[t.encode() for t in rows["t"][rows["y"] == y]] for y in (1, -1)]
            least = min(max(len(groups[0]) // 20, 2), 5) if least_documents is None else least_documents
            weights, bias = learnt(*groups, prior, least_documents=least)
            buffer = io.BytesIO()
            np.savez_compressed(buffer, weights=weights, bias=bias)
            return pd.DataFrame({"body": [buffer.getvalue()]})

        found = with_texts(sample, docs, key, text).withColumn("g", F.lit(0)).groupBy("g").applyInPandas(learn, "body binary").collect()
        body = found[0]["body"] if found else None
    shared = docs.sparkSession.sparkContext.broadcast(body)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = np.load(io.BytesIO(shared.value)) if shared.value else None
        weights, bias = (model["weights"].astype(np.float64), float(model["bias"])) if model else (None, 0.0)
        for keys, lens, parts in cut_by_bytes(batches):
            values = logistic(sums(weights, *features(parts, lens)) + bias) if model else np.zeros(len(keys))
            yield pa.RecordBatch.from_arrays([keys, pa.array(values)], names=[key, "score"])

    scored = keyed_texts(docs, key, text).mapInArrow(score, typed("score double", 0, key, kind))
    held_out = (remainder(F.col(f"`{key}`"), modulus) == held).alias("held_out")
    return scored.select(f"`{key}`", held_out, "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
