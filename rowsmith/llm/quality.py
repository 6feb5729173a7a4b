"""Quality classifier by positive-unlabelled learning: the non-negative unbiased risk with an estimated class prior.

Only trusted good texts and a sample of unlabelled texts are used; no text is ever known to be bad. A network with
one hidden layer over statistics of the whole text is fitted in numpy.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm import words
from rowsmith.llm.toxicity import remainder

#: Most trusted texts, and most unlabelled ones, that the model is fitted on.
SAMPLE = 6000
HIDDEN, STEPS, RATE, DECAY = 24, 400, 0.01, 1e-3
#: Share of trusted texts that must lie above a threshold for it to count in the estimate of the prior.
LEAST_SHARE = 0.2
_KINDS = 64


def kinds() -> np.ndarray:
    """A kind for each byte: ASCII signs one by one, digits, upper case, lower case, white space, the rest."""
    out = np.full(256, 0, np.int64)
    signs = [b for b in range(33, 127) if not chr(b).isalnum()]
    out[signs] = np.arange(6, 6 + len(signs))
    for kind, members in enumerate((b"0123456789", range(65, 91), range(97, 123), b" \t\r\x0b\x0c", b"\n"), 1):
        out[list(members)] = kind
    return out


KINDS = kinds()


def features(texts: pa.Array) -> np.ndarray:
    """One row for each text: shares of kinds of bytes and of pairs of kinds, word and line statistics."""
    data, offsets = words.texts_of(texts)
    rows, sizes = len(offsets) - 1, np.diff(offsets)
    row = np.repeat(np.arange(rows), sizes)
    kind = KINDS[data[offsets[0] : offsets[-1]]]
    share = np.bincount(row * _KINDS + kind, minlength=rows * _KINDS).reshape(rows, _KINDS) / np.maximum(sizes, 1)[:, None]
    coarse = np.minimum(kind, 6)
    inner = row[1:] == row[:-1]
    pairs = np.bincount((row[1:] * 49 + coarse[:-1] * 7 + coarse[1:])[inner], minlength=rows * 49).reshape(rows, 49) / np.maximum(sizes, 1)[:, None]
    table = words.word_table(data, offsets)
    many = np.diff(table.before)
    owner = np.repeat(np.arange(rows), many)
    length = np.minimum(table.stops - table.starts, 40)
    mean = np.bincount(owner, length, rows) / np.maximum(many, 1)
    spread = np.sqrt(np.maximum(np.bincount(owner, length.astype(float) ** 2, rows) / np.maximum(many, 1) - mean**2, 0))
    out = [share, np.sqrt(share), pairs, mean[:, None] / 10, spread[:, None] / 10, np.log1p(many)[:, None] / 10]
    for n in (1, 2, 4):
        values, before = words.shingle_hashes(table.hashes, table.before, n)
        different = np.diff(words.distinct(values, before)[1])
        out.append((different / np.maximum(np.diff(before), 1))[:, None])
    lines = np.bincount(row[data[offsets[0] : offsets[-1]] == 10], minlength=rows) + 1
    out.append(np.log1p(many / lines)[:, None] / 5)
    return np.concatenate(out, axis=1).astype(np.float32)


def network(rng: np.random.Generator, inputs: int) -> list[np.ndarray]:
    first = rng.normal(0, 1 / np.sqrt(inputs), (inputs, HIDDEN)).astype(np.float32)
    return [first, np.zeros(HIDDEN, np.float32), rng.normal(0, 0.2, HIDDEN).astype(np.float32), np.zeros(1, np.float32)]


def output(net: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.tanh(x @ net[0] + net[1])
    return hidden, hidden @ net[2] + net[3][0]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def descend(net: list[np.ndarray], x: np.ndarray, slope_of) -> list[np.ndarray]:
    """Full-batch Adam on a risk whose derivative by the outputs is given by slope_of(outputs)."""
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in net]
    for step in range(1, STEPS + 1):
        hidden, z = output(net, x)
        slope = slope_of(z).astype(np.float32)
        back = slope[:, None] * net[2] * (1 - hidden**2)
        grads = [x.T @ back + DECAY * net[0], back.sum(axis=0), hidden.T @ slope + DECAY * net[2], slope.sum(keepdims=True)]
        for p, g, (m, v) in zip(net, grads, state, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def estimated_prior(trusted: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of good texts among the unlabelled: above any threshold lie at least prior x the trusted share of texts,
    so the prior is the least ratio of the shares, over thresholds with enough trusted texts above them."""
    levels = np.quantile(trusted, np.linspace(0, 1 - LEAST_SHARE, 81))
    above = [(unlabelled >= t).mean() / (trusted >= t).mean() for t in levels]
    return float(np.clip(min(above), 0.05, 0.98))


def fit(trusted: np.ndarray, unlabelled: np.ndarray, seed: int = 1) -> dict[str, np.ndarray]:
    """The network with the least non-negative unbiased risk, under logistic loss.

    A first network tells trusted from unlabelled texts on one half and is applied to the other half, and the other
    way round; the prior is estimated on those outputs. The risk of calling unlabelled texts bad is their loss less
    the prior's share of good ones; where that turns negative, its own gradient is undone instead of followed.
    """
    x = np.concatenate([trusted, unlabelled])
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = np.clip((x - center) / scale, -6, 6)
    good = np.arange(len(x)) < len(trusted)
    rng = np.random.default_rng(seed)
    half = rng.random(len(x)) < 0.5
    crossed = np.zeros(len(x))
    for part in (half, ~half):
        y = good[part]
        weight = np.where(y, 0.5 / max(1, y.sum()), 0.5 / max(1, (~y).sum()))
        net = descend(network(rng, x.shape[1]), x[part], lambda z, y=y, weight=weight: (sigmoid(z) - y) * weight)
        crossed[~part] = output(net, x[~part])[1]
    prior = estimated_prior(crossed[good], crossed[~good])

    def slope(z):
        p = sigmoid(z)
        negative = np.logaddexp(0, z[~good]).mean() - prior * np.logaddexp(0, z[good]).mean()
        as_bad = np.where(good, -prior * p / good.sum(), p / (~good).sum())
        as_good = np.where(good, prior * (p - 1) / good.sum(), 0.0)
        return as_good + as_bad if negative >= 0 else -as_bad

    net = descend(network(rng, x.shape[1]), x, slope)
    return dict(zip(("w1", "b1", "w2", "b2"), net, strict=True)) | {"center": center, "scale": scale, "prior": np.array(prior)}


def scored(texts: pa.Array, model: dict[str, np.ndarray]) -> np.ndarray:
    x = np.clip((features(texts) - model["center"]) / model["scale"], -6, 6)
    return sigmoid(output([model[k] for k in ("w1", "b1", "w2", "b2")], x)[1].astype(np.float64))


def model_of(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, sample: int = SAMPLE, seed: int = 1) -> dict | None:
    """The model, fitted in one task on at most `sample` trusted and `sample` unlabelled texts, those with the
    smallest hashed ids outside the held-out fold; or None without texts of both kinds. Trusted texts have quality 1
    and no other label; unlabelled texts are drawn from all documents, whatever their labels say."""
    free = F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), folds) != held)
    near = [F.xxhash64(F.lit(seed), "doc_id"), F.col("doc_id")]
    known = labels.filter(free & F.col("quality").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min("quality").alias("q"))
    trusted = known.filter("q = 1").orderBy(*near).limit(sample).select("doc_id", F.lit(True).alias("trusted"))
    drawn = docs.filter(free).select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    drawn = drawn.orderBy(F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id").limit(sample).select("doc_id", F.lit(False).alias("trusted"))
    picked = F.broadcast(trusted.unionByName(drawn))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in words.slices(whole):
                rows = [x.tobytes() for x in features(batch.column("text"))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("trusted"), pa.array(rows, pa.binary())], ["doc_id", "trusted", "x"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [batch for batch in batches if batch.num_rows]
        if not tables:
            return
        table = pa.Table.from_batches(tables)
        x = np.stack([np.frombuffer(row, np.float32) for row in table.column("x").to_pylist()])
        good = table.column("trusted").to_numpy().astype(bool)
        if good.any() and not good.all():
            out = io.BytesIO()
            np.savez(out, **fit(x[good], x[~good], seed))
            yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()])], ["model"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    measured = texts.join(picked, "doc_id").mapInArrow(measure, "doc_id bigint, trusted boolean, x binary")
    measured = measured.dropDuplicates(["doc_id", "trusted"]).repartition(1).sortWithinPartitions("trusted", "doc_id")
    row = measured.mapInArrow(task, "model binary").first()
    if row is None:
        return None
    with np.load(io.BytesIO(bytes(row[0]))) as file:
        return dict(file)


def scores(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, threshold: float = 0.7, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per input row; the score is the probability of a good text.

    Only the texts are read for a score. Null and empty texts are scored as texts without words. Null and repeated
    doc_ids are scored like others; a null id counts as the empty text for held_out. Without texts to fit on, every
    score is one half. Other columns do not matter.
    """
    model = model_of(docs, labels, folds, held, sample)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in words.slices(whole):
                text = batch.column("text")
                score = np.full(batch.num_rows, 0.5) if model is None else scored(text, model)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(task, "doc_id bigint, score double")
    out = remainder(F.col("doc_id"), folds) == held
    return found.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
