"""A byte-level convolutional network for document quality, in numpy."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import agreed_labels, first_by_hash, remainder, with_texts
from .shared import cut_by_bytes, keyed_texts, release, texts, typed

#: A filter reads two steps of bytes and moves by one, so neighbouring chunks overlap by a step.
STEP = 8
CHUNK_STEPS = 64
EMBED, FILTERS = 6, 32
BATCH_BYTES = 1 << 20


def blocks(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all documents as steps (rows of ``STEP``), zero-filled at each end, and where documents begin."""
    steps = np.array([-(-len(p) // STEP) + 1 for p in parts], np.int64)
    first = np.concatenate(([0], np.cumsum(steps)))
    out = np.zeros((first[-1], STEP), np.uint8)
    flat = out.reshape(-1)
    for p, at in zip(parts, (first[:-1] * STEP).tolist(), strict=True):
        flat[at : at + len(p)] = np.frombuffer(p, np.uint8)
    return out, first


class Network:
    """Embedded bytes, convolution, ReLU, max-pooling per chunk, mean and maximum over chunks, one probability."""

    NAMES = ("table", "one", "two", "bias", "out", "base")

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        width = STEP * EMBED
        self.table = rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        self.table[0] = 0
        self.one = rng.normal(0, 0.15, (width, FILTERS)).astype(np.float32)
        self.two = rng.normal(0, 0.15, (width, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32)
        self.base = np.zeros(1, np.float32)

    def dumps(self) -> bytes:
        buffer = io.BytesIO()
        np.savez(buffer, **{n: getattr(self, n) for n in self.NAMES})
        return buffer.getvalue()

    @classmethod
    def loads(cls, body: bytes) -> Network:
        net, values = cls(), np.load(io.BytesIO(body))
        for n in cls.NAMES:
            setattr(net, n, values[n])
        return net

    def forward(self, parts: list[bytes]) -> dict:
        step, first = blocks(parts)
        x = self.table[step].reshape(len(step), -1)
        response = x @ self.one
        response[:-1] += x[1:] @ self.two  # the last step of a document is zero, so this stays inside it
        response += self.bias
        chunk = np.unique(np.concatenate([np.arange(a, z, CHUNK_STEPS) for a, z in zip(first[:-1], first[1:], strict=True)]))
        pooled = np.maximum(np.maximum.reduceat(response, chunk), 0)
        first_chunk = np.searchsorted(chunk, first)
        count = np.diff(first_chunk)[:, None]
        mean = np.add.reduceat(pooled, first_chunk[:-1]) / count
        most = np.maximum.reduceat(pooled, first_chunk[:-1])
        features = np.concatenate((mean, most), 1)
        logit = features @ self.out + self.base[0]
        return {"step": step, "x": x, "response": response, "chunk": chunk, "pooled": pooled, "first": first_chunk, "count": count,
                "most": most, "features": features, "logit": logit}

    def score(self, parts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.forward(parts)["logit"].astype(np.float64), -40, 40)))

    def gradients(self, parts: list[bytes], label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        f = self.forward(parts)
        error = ((1 / (1 + np.exp(-np.clip(f["logit"], -40, 40))) - label) * weight / weight.sum()).astype(np.float32)
        grad = {"out": f["features"].T @ error + 1e-4 * self.out, "base": np.array([error.sum()], np.float32)}
        d_features = error[:, None] * self.out[None, :]
        times = np.diff(f["first"])
        d_pooled = np.repeat(d_features[:, :FILTERS] / f["count"], times, axis=0)
        d_pooled += np.where(f["pooled"] == np.repeat(f["most"], times, axis=0), np.repeat(d_features[:, FILTERS:], times, axis=0), 0)
        d_pooled[f["pooled"] <= 0] = 0
        sizes = np.diff(np.append(f["chunk"], len(f["step"])))
        d_response = np.where(f["response"] == np.repeat(f["pooled"], sizes, axis=0), np.repeat(d_pooled, sizes, axis=0), 0).astype(np.float32)
        grad["bias"] = d_response.sum(0)
        grad["one"] = f["x"].T @ d_response
        grad["two"] = f["x"][1:].T @ d_response[:-1]
        d_x = d_response @ self.one.T
        d_x[1:] += d_response[:-1] @ self.two.T
        flat = d_x.reshape(-1, EMBED)
        grad["table"] = np.stack([np.bincount(f["step"].ravel(), flat[:, e], 256) for e in range(EMBED)], 1).astype(np.float32)
        grad["table"][0] = 0
        return grad


def trained(samples: list[bytes], label: np.ndarray, weight: np.ndarray, epochs: int, batch: int = 24, rate: float = 0.01) -> Network:
    """A network fitted with Adam; long texts come as bounded runs of bytes, drawn anew in each epoch.

    Small samples get more epochs, so that there are about 600 steps at least.
    """
    epochs = max(epochs, 600 * batch // max(len(samples), batch))
    net, rng = Network(), np.random.default_rng(5)
    net.base[0] = np.log((weight[label == 1].sum() + 1) / (weight[label == 0].sum() + 1))
    one, two = ({n: np.zeros_like(getattr(net, n)) for n in Network.NAMES} for _ in range(2))
    turn, turns = 0, epochs * -(-len(samples) // batch)
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(len(samples)), -(-len(samples) // batch)):
            turn += 1
            parts = []
            for i in at:
                begin = int(rng.integers(0, max(len(samples[i]) - 16_384, 0) + 1))
                parts.append(samples[i][begin : begin + 16_384])
            step = rate * (1 - turn / (turns + 1))
            for n, g in net.gradients(parts, label[at], weight[at]).items():
                one[n] = 0.9 * one[n] + 0.1 * g
                two[n] = 0.999 * two[n] + 0.001 * g * g
                move = step * (one[n] / (1 - 0.9**turn)) / (np.sqrt(two[n] / (1 - 0.999**turn)) + 1e-8)
                setattr(net, n, (getattr(net, n) - move).astype(np.float32))
    return net


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", most_per_class: int = 1500, epochs: int = 6, modulus: int = 3, held: int = 1,
    key: str = "doc_id", text: str = "text",
) -> bytes | None:
    """Weights learnt from at most ``most_per_class`` labelled documents of each class that are not held out.

    Rows are weighted so that classes keep their share. None if there are no two classes to learn from.
    """
    usable = agreed_labels(labels, key, label).filter(remainder(F.col("k"), modulus) != held)
    shares = {r["y"]: r["n"] for r in usable.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(shares) < 2:
        return None
    sample = first_by_hash(usable.filter("y = 0"), most_per_class).unionByName(first_by_hash(usable.filter("y = 1"), most_per_class))

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["k", "t"])
        y = rows["y"].to_numpy()
        weight = np.where(y == 1, shares[1] / max((y == 1).sum(), 1), shares[0] / max((y == 0).sum(), 1))
        net = trained([t.encode() for t in rows["t"]], y, weight / weight.mean(), epochs)
        return pd.DataFrame({"body": [net.dumps()]})

    found = with_texts(sample, docs, key, text).withColumn("g", F.lit(0)).groupBy("g").applyInPandas(learn, "body binary").collect()
    return found[0]["body"] if found else None


def keep_good(
    docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.5, key: str = "doc_id", text: str = "text", held: int = 1
) -> DataFrame:
    """The rows of ``docs`` whose whole text scores at least ``threshold`` (see ``score_quality``), all columns kept."""
    body = fit(docs, labels, label, key=key, text=text, held=held)
    shared = docs.sparkSession.sparkContext.broadcast(body)

    place = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network.loads(shared.value) if shared.value else None
        for batch in batches:
            data, offsets = texts(batch.column(place))
            groups = np.flatnonzero(np.diff(offsets[1:] // BATCH_BYTES)) + 1
            values = []
            for g in np.split(np.arange(batch.num_rows), groups):
                parts = [data[offsets[i] : offsets[i + 1]].tobytes() for i in g]
                values.append(net.score(parts) if net and parts else np.full(len(g), 0.5))
            yield batch.filter(pa.array(np.concatenate(values) >= threshold))
        release()

    return docs.mapInArrow(keep, docs.schema)


def score_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 3, held: int = 1, key: str = "doc_id", text: str = "text",
    most_per_class: int = 1500, epochs: int = 6,
) -> DataFrame:
    """Probability of label 1 for every whole text: ``key``, ``held_out``, ``score``, ``predicted`` (score >= 0.5).

    Only the text is scored. Labels of keys whose crc32 modulo ``modulus`` is ``held`` are never learnt from. A null
    text counts as empty; repeated rows are scored alike; a null key is not held out; contradicting or null labels
    are left out; without two classes to learn from every score is 0.5. An empty table gives an empty one.
    """
    kind = docs.schema[key].dataType
    body = fit(docs, labels, label, most_per_class, epochs, modulus, held, key, text)
    shared = docs.sparkSession.sparkContext.broadcast(body)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network.loads(shared.value) if shared.value else None
        for keys, _, parts in cut_by_bytes(batches, BATCH_BYTES):
            values = net.score(parts[::2]) if net else np.full(len(keys), 0.5)
            yield pa.RecordBatch.from_arrays([keys, pa.array(values)], names=[key, "score"])

    scored = keyed_texts(docs, key, text).mapInArrow(score, typed("score double", 0, key, kind))
    held_out = (remainder(F.col(f"`{key}`"), modulus) == held).alias("held_out")
    return scored.select(f"`{key}`", held_out, "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
