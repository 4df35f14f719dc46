"""Language identification: averaged hashed subword embeddings under a linear softmax."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanstrata.llm.common import rows

_GAP = re.compile(r"[\W\d_]+")
_LETTER = regex.compile(r"\p{L}")
_SIZES = (2, 3, 4)


def _subwords(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed byte n-grams of the lower-cased words, with the ends of words as blanks.

    Returns the bucket of each n-gram, whether it lies in one word, and where each text begins.
    """
    encoded = [b" " + _GAP.sub(" ", t.lower()).strip().encode() + b" " for t in texts]
    starts = np.cumsum([0, *map(len, encoded[:-1])])
    raw = np.frombuffer(b"".join(encoded) + b" " * 4, np.uint8)
    blank = raw == 32
    n = len(raw) - 4
    buckets, valid = [], []
    mixed = raw[:n].astype(np.uint32) + np.uint32(1)
    inside = np.ones(n, bool)
    for size in range(2, max(_SIZES) + 1):
        mixed = mixed * np.uint32(0x01000193) ^ raw[size - 1 : n + size - 1]
        # blanks only at the ends, and not at both ends of nothing
        ok = inside & ~(blank[:n] & blank[size - 1 : n + size - 1]) if size == 2 else inside.copy()
        if size in _SIZES:
            buckets.append((mixed * np.uint32(0x9E3779B1) >> np.uint32(32 - bits)).astype(np.int64))
            valid.append(ok)
        inside &= ~blank[size - 1 : n + size - 1]
    return np.stack(buckets), np.stack(valid), starts


def _bags(texts: list[str], bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text the buckets it has, with counts."""
    out = []
    for text in texts:
        buckets, valid, _ = _subwords([text], bits)
        out.append(np.unique(buckets[valid], return_counts=True))
    return out


@dataclass
class Model:
    """``table[b]`` is what bucket b adds to the logits (embedding times weights)."""

    labels: list[str]
    table: np.ndarray
    bias: np.ndarray
    bits: int
    temperature: float
    least_score: float

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Label number and calibrated probability of each text; -1 and 0 for one without a letter."""
        best, score = np.full(len(texts), -1), np.zeros(len(texts))
        some = [i for i, t in enumerate(texts) if self.labels and _LETTER.search(t)]
        if not some:
            return best, score
        buckets, valid, starts = _subwords([texts[i] for i in some], self.bits)
        count = sum(np.add.reduceat(v.astype(np.int64), starts) for v in valid)
        logits = np.empty((len(some), len(self.labels)))
        for k in range(len(self.labels)):
            column = self.table[:, k]
            total = sum(np.add.reduceat(np.where(v, column[b], 0.0), starts) for b, v in zip(buckets, valid, strict=True))
            logits[:, k] = total / np.maximum(count, 1) + self.bias[k]
        p = _softmax(logits / self.temperature)
        best[some], score[some] = p.argmax(1), p.max(1)
        return best, score


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(
    docs: DataFrame,
    text_col: str = "text",
    label_col: str = "lang",
    id_col: str = "doc_id",
    fit_rows: int = 2000,
    bits: int = 15,
    dim: int = 16,
    epochs: int = 6,
    rate: float = 0.5,
    lost: float = 0.001,
    seed: int = 0,
    most_labels: int = 1000,
) -> Model:
    """Learn labels from a bounded sample of labelled rows.

    The sample has at most ``fit_rows`` rows, each label about the same number, chosen by a hash of
    id and text; at most ``most_labels`` labels, the most frequent ones: others are never predicted. Each
    text is made a bag of n-grams in 2 ** ``bits`` buckets where it lies, so its length counts neither
    where the sample comes together nor on the driver. A second bag holds a few words in a row of it, so
    that short texts are learnt too. Rows without a text or a label teach nothing, no row at all gives a
    model that predicts nothing; repeated rows count as often as they come.

    A fifth of the sample trains nothing: it sets the temperature, so that scores are probabilities,
    and ``least_score``, under which a prediction is rejected. Of its right predictions of whole
    texts at most the share ``lost`` falls under it, and it never exceeds 0.5.
    """
    labelled = docs.select(
        F.col(text_col).alias("text"),
        F.col(label_col).cast("string").alias("label"),
        F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("h"),
    ).filter(F.col("text").isNotNull() & F.col("label").isNotNull())
    sizes = {r.label: r.n for r in labelled.groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(most_labels).collect()}
    labels = sorted(sizes)
    if not labels:
        return Model([], np.zeros((1, 0)), np.zeros(0), bits, 1.0, 0.5)
    each = max(1, fit_rows // len(labels))
    share = F.create_map(*[F.lit(x) for k in labels for x in (k, min(1.0, each / sizes[k]))])
    sample = labelled.filter(F.pmod(F.col("h"), F.lit(1_000_003)) < F.try_element_at(share, "label") * 1_000_003)

    def bag(batches):
        for part in rows(batches, "text"):
            texts, labels_, hashes = (part.column(c).to_pylist() for c in ("text", "label", "h"))
            few = []
            for text, h in zip(texts, hashes, strict=True):
                words, rng = text.split(), np.random.default_rng(h & 0xFFFFFFFF)
                size = int(rng.choice([2, 4, 8, 16, 32]))
                at = int(rng.integers(max(1, len(words) - size + 1)))
                few.append(" ".join(words[at : at + size]))
            for whole, group in ((True, texts), (False, few)):
                bags = _bags(group, bits)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(labels_),
                        pa.array(hashes, pa.int64()),
                        pa.array([whole] * len(group)),
                        pa.array([b.astype(np.int32) for b, _ in bags], pa.list_(pa.int32())),
                        pa.array([n.astype(np.int32) for _, n in bags], pa.list_(pa.int32())),
                    ],
                    ["label", "h", "whole", "bucket", "n"],
                )

    bags = sample.mapInArrow(bag, "label string, h long, whole boolean, bucket array<int>, n array<int>")
    # two bags of a row have one hash
    found = bags.orderBy("h", "label", "whole").limit(2 * fit_rows).toArrow()
    keep = [i for i, b in enumerate(found.column("bucket").to_pylist()) if b]
    found = found.take(pa.array(keep, pa.int64())).sort_by([("h", "ascending"), ("label", "ascending"), ("whole", "ascending")])
    target = np.searchsorted(labels, found.column("label").to_pylist()) if keep else np.zeros(0, int)
    calibrate = found.column("h").to_numpy() % 5 == 0 if keep else np.zeros(0, bool)
    whole = np.array(found.column("whole").to_pylist(), bool)
    bucket = [np.array(b) for b in found.column("bucket").to_pylist()]
    weight = [np.array(n, np.float32) / sum(n) for n in found.column("n").to_pylist()]

    def dense(some: np.ndarray) -> np.ndarray:
        x = np.zeros((len(some), 1 << bits), np.float32)
        for r, i in enumerate(some):
            x[r, bucket[i]] = weight[i]
        return x

    rng = np.random.default_rng(seed)
    embedding = rng.uniform(-1 / dim, 1 / dim, (1 << bits, dim)).astype(np.float32)
    weights = rng.normal(0, 0.5, (dim, len(labels))).astype(np.float32)
    bias = np.zeros(len(labels), np.float32)
    train = np.flatnonzero(~calibrate)
    steps, step = epochs * -(-len(train) // 32), 0
    for _ in range(epochs):
        for some in np.array_split(rng.permutation(train), max(1, -(-len(train) // 32))):
            if not len(some):
                continue
            x = dense(some)
            average = x @ embedding
            error = _softmax(average @ weights + bias).astype(np.float32)
            error[np.arange(len(some)), target[some]] -= 1
            now = rate * (1 - step / steps)
            step += 1
            used = np.unique(np.concatenate([bucket[i] for i in some]))
            # embeddings of single buckets get little weight each, hence the larger step
            embedding[used] -= 200 * now * (x[:, used].T @ (error @ weights.T)) / len(some)
            weights -= now * average.T @ error / len(some)
            bias -= now * error.mean(0)
    model = Model(labels, (embedding @ weights).astype(np.float64), bias.astype(np.float64), bits, 1.0, 0.5)
    held = np.flatnonzero(calibrate)
    if len(held):
        logits = np.array([weight[i] @ model.table[bucket[i]] for i in held]) + model.bias
        grid = np.geomspace(0.05, 20, 61)
        loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(held)), target[held]], 1e-12)).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
        p = _softmax(logits / model.temperature)
        right = np.sort(p.max(1)[(p.argmax(1) == target[held]) & whole[held]])
        if len(right):
            model.least_score = float(min(0.5, right[int(lost * len(right))]))
    return model


def held_out(id_col: Column) -> Column:
    """Is CRC-32 of the id as text 2 modulo 4? A null id counts as an empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def classify(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """(doc_id, columns to ``carry``, lang_pred, score, accepted) of every row, from its whole text alone.

    ``score`` is the calibrated probability of ``lang_pred``. A text that is null or has no letter is
    `und` with score 0. ``accepted`` is false for `und` and for scores under the model's least one.
    Rows with equal or null ids are kept; other columns aren't read, and a carried column of one of
    these names gives way.
    """
    results = ["doc_id", "lang_pred", "score", "accepted"]
    carried = [c for c in carry if c not in results]

    def run(batches):
        for part in rows(batches, "text", 2_000_000):
            best, score = model.predict([t or "" for t in part.column("text").to_pylist()])
            names = [model.labels[b] if b >= 0 else "und" for b in best]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    *(part.column(f"c{k}") for k in range(len(carried))),
                    pa.array(names, pa.string()),
                    pa.array(score),
                    pa.array((best >= 0) & (score >= model.least_score)),
                ],
                ["doc_id", *carried, "lang_pred", "score", "accepted"],
            )

    given = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        *(F.col(c).alias(f"c{k}") for k, c in enumerate(carried)),
    )
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType)])
    for c in carried:
        schema.add(c, docs.schema[c].dataType)
    schema.add("lang_pred", "string").add("score", "double").add("accepted", "boolean")
    return given.mapInArrow(run, schema)
