"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its character n-grams (with its ends marked) and of the whole word, a passage
the mean of its words, and a softmax over a linear map of that gives the passage's class. Vectors live in a table of
hashed n-grams, so an unseen misspelling shares most vectors with the word it is made from. A text is as toxic as
its most toxic passage; passages are consecutive and together are the whole text.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.llm import words
from rowsmith.llm.decontaminate import LETTERED

BUCKETS = 1 << 17
WIDTH = 4
GRAMS = (3, 4, 5, 6)
PASSAGE = 8
#: Most labelled documents of each class that the model is fitted on.
SAMPLE = 1200
ROUNDS, STEPS, RATE, FLOOR = 6, 12, 1.5, 0.03
#: n-grams of words of whole texts that are counted at a time; a text with more is counted alone.
AT_ONCE = 1 << 21
#: Fitted texts that must have a bucket for it to get a vector.
FEWEST = 3


def remainder(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % of


def subwords(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of texts as (place of each word in the distinct words, words before each text) and the distinct words'
    n-grams as (buckets, n-grams before each distinct word)."""
    table = words.word_table(data, offsets, LETTERED)
    before = table.before
    distinct, first, place = np.unique(table.hashes, return_index=True, return_inverse=True)
    start, size = table.starts[first], (table.stops - table.starts)[first]
    marked = np.concatenate([[0], np.cumsum(size + 2)])
    letters = np.zeros(marked[-1], np.uint64)
    inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    letters[np.repeat(marked[:-1], size) + 1 + inner] = LETTERED.folded[data[np.repeat(start, size) + inner]]
    letters[marked[:-1]], letters[marked[1:] - 1] = 300, 301
    owner = np.repeat(np.arange(len(distinct)), size + 2)
    found, owners = [distinct], [np.arange(len(distinct))]
    for n in GRAMS:
        at = np.arange(max(len(letters) - n + 1, 0))
        at = at[owner[at] == owner[at + n - 1]] if len(at) else at
        total = np.full(len(at), np.uint64(n))
        for i in range(n):
            total = total * np.uint64(0xD6E8FEB86659FD93) + letters[at + i]
        found.append(words.mix(total))
        owners.append(owner[at])
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    bucket = (np.concatenate(found)[order] & np.uint64(BUCKETS - 1)).astype(np.int64)
    return place, before, bucket, np.searchsorted(owners[order], np.arange(len(distinct) + 1))


def means(values: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Mean of the values of each group; no group is empty."""
    return np.add.reduceat(values, before[:-1], axis=0) / np.diff(before).reshape(-1, *[1] * (values.ndim - 1))


def passages(before: np.ndarray, size: int = PASSAGE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of all passages, where each passage begins among them (and the end of the last), and its text.

    Passages have that many words; the last one of a text takes them from its end, so that it may share words with
    the one before. A shorter text is one passage, an empty one has none.
    """
    words_of = np.diff(before)
    many = -(-words_of // size)
    text = np.repeat(np.arange(len(many)), many)
    inner = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    first = np.minimum(inner * size, np.maximum(words_of - size, 0)[text]) + before[:-1][text]
    length = np.minimum(words_of, size)[text]
    starts = np.concatenate([[0], np.cumsum(length)])
    return np.arange(starts[-1]) + np.repeat(first - starts[:-1], length), starts, text


def summed(values: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Sums over the last axis of the groups that begin at these places; no group is empty."""
    return np.add.reduceat(values, before, axis=-1)


def fit(texts: pa.Array, labels: np.ndarray, seed: int = 1) -> bytes:
    """Vectors and classifier, fitted together by full-batch steps of Adam whose steps are smaller for n-grams that
    few texts share.

    In each round a toxic text is represented by its highest passage, a clean text by all its passages and, with
    more weight, its highest. The first vectors say how much more texts of one class have the n-gram than expected.
    A fifth of the texts of each class is not fitted but sets the bias: it goes where their highest passages are
    parted best.
    """
    place, before, bucket, grams_before = subwords(*words.texts_of(texts))
    slots, starts, text = passages(before)
    rng = np.random.default_rng(seed)
    set_aside = np.zeros(len(labels), bool)
    for kind in (0, 1):
        mine = rng.permutation(np.flatnonzero(labels == kind))
        set_aside[mine[: len(mine) // 5]] = True
    used, column, toxic_texts, clean_texts = shared_buckets(place, before, bucket, grams_before, labels, set_aside)
    table = rng.normal(0, 0.1, (WIDTH, len(used) + 1)).astype(np.float32)
    table[:, 0] = 0
    table[0, 1:] = surprise(toxic_texts, clean_texts, (labels[~set_aside] == 1).sum(), (labels[~set_aside] == 0).sum())
    linear, bias = rng.normal(0, 0.01, (2, WIDTH)).astype(np.float32), np.zeros((2, 1), np.float32)
    linear[:, 0] = -1, 1
    fitted = ~set_aside[text]
    place = place[slots]
    passage_of = np.repeat(np.arange(len(text)), np.diff(starts))
    by_word, by_column = np.argsort(place, kind="stable"), np.argsort(column, kind="stable")
    word_edges = np.searchsorted(place[by_word], np.arange(len(grams_before) - 1))
    by_column = by_column[np.searchsorted(column[by_column], 1) :]
    column_edges = np.searchsorted(column[by_column], np.arange(1, len(used) + 1))
    per_gram = (1 / np.diff(grams_before)).astype(np.float32)
    share = (1 / np.diff(starts)).astype(np.float32)
    passage_by_word = passage_of[by_word]
    word_by_column = np.repeat(np.arange(len(grams_before) - 1), np.diff(grams_before))[by_column]
    state = [(np.zeros_like(x), np.zeros_like(x)) for x in (table, linear, bias)]
    step = 0

    def forward():
        vectors = summed(table[:, column], grams_before[:-1]) * per_gram
        bags = summed(vectors[:, place], starts[:-1]) * share
        logits = linear @ bags + bias
        return bags, 1 / (1 + np.exp(np.clip(logits[0] - logits[1], -50, 50))), logits[1] - logits[0]

    for _ in range(ROUNDS if len(text) else 0):
        margin = forward()[2]
        top = fitted & (margin == highest(margin, text, len(labels))[text])
        toxic, clean, hard = top & (labels[text] == 1), fitted & (labels[text] == 0), top & (labels[text] == 0)
        weight = toxic / max(1, toxic.sum()) + clean / max(1, clean.sum()) / 4 + hard / max(1, hard.sum()) * 3 / 4
        for _ in range(STEPS):
            bags, score, _ = forward()
            error = ((score - toxic) * weight).astype(np.float32)
            error = np.stack([-error, error])
            bag_error = (linear.T @ error) * share
            word_error = summed(bag_error[:, passage_by_word], word_edges) * per_gram
            gram_error = np.pad(summed(word_error[:, word_by_column], column_edges), ((0, 0), (1, 0)))
            step += 1
            for x, slope, (m, v) in zip((table, linear, bias), (gram_error, error @ bags.T, error.sum(axis=1, keepdims=True)), state, strict=True):
                m += 0.1 * (slope - m)
                v += 0.02 * (slope * slope - v)
                size = np.sqrt(v / (1 - 0.98**step))
                x -= RATE * (m / (1 - 0.9**step)) / (size + FLOOR * size.max() + 1e-12)
    margin = highest(forward()[2], text, len(labels)) if len(text) else None
    shift = parting(margin[set_aside], labels[set_aside] == 1) if len(text) else 0.0
    whole = np.zeros(BUCKETS, np.float32)
    whole[used] = (linear[1] - linear[0]) @ table[:, 1:]
    out = io.BytesIO()
    level = float((bias[1] - bias[0])[0] - shift)
    clean = margin[(labels == 0) & np.isfinite(margin)] - shift if len(text) else np.zeros(0)
    np.savez(out, grams=whole, bias=level, empty=min(level, float(np.median(clean))) if len(clean) else level)
    return out.getvalue()


def shared_buckets(place, before, bucket, grams_before, labels, set_aside):
    """Counted in slices of whole texts: buckets that at least FEWEST of the fitted texts have, the place of each n-gram's bucket among them, from 1
    (0 stands for all others, whose vector stays zero), and how many fitted texts of each class have the bucket."""
    words_, many = len(grams_before) - 1, np.diff(grams_before)
    kinds = np.zeros((2, BUCKETS), np.int64)
    grams_upto = np.concatenate([[0], np.cumsum(many[place])])[before]
    edges = np.flatnonzero(np.diff(grams_upto[:-1] // AT_ONCE, prepend=-1))
    for first, last in zip(edges, [*edges[1:], len(labels)], strict=True):
        text = np.repeat(np.arange(last - first), np.diff(before[first : last + 1]))
        pairs = np.unique(text * words_ + place[before[first] : before[last]])
        word = pairs % words_
        inner = np.arange(many[word].sum()) - np.repeat(np.cumsum(many[word]) - many[word], many[word])
        grams = np.repeat(pairs // words_, many[word]) * BUCKETS + bucket[np.repeat(grams_before[:-1][word], many[word]) + inner]
        grams = np.unique(grams)
        for at, kind in enumerate((1, 0)):
            mine = ((labels == kind) & ~set_aside)[first:last]
            kinds[at] += np.bincount(grams[mine[grams // BUCKETS]] % BUCKETS, minlength=BUCKETS)
    used = np.flatnonzero(kinds[0] + kinds[1] >= FEWEST)
    at = np.zeros(BUCKETS, np.int64)
    at[used] = np.arange(1, len(used) + 1)
    return used, at[bucket], kinds[0][used], kinds[1][used]


def surprise(a, c, many_a, many_c) -> np.ndarray:
    """Signed log-likelihood ratio of each bucket's share of the toxic and of the clean texts."""
    expected = (a + c) * many_a / max(1, many_a + many_c)
    other = a + c - expected
    ratio = a * np.log(np.maximum(a, 1e-9) / np.maximum(expected, 1e-9)) + c * np.log(np.maximum(c, 1e-9) / np.maximum(other, 1e-9))
    return np.sign(a - expected) * 2 * ratio


def highest(values: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """The largest value of each text's passages."""
    out = np.full(texts, -np.inf)
    np.maximum.at(out, text, values)
    return out


def parting(margin: np.ndarray, toxic: np.ndarray) -> float:
    """The middle of the gap in which the fewest texts of either kind are on the wrong side, errors in the two kinds
    being weighed by the kinds' sizes; 0 where a kind is absent."""
    known = np.isfinite(margin)
    margin, toxic = margin[known], toxic[known]
    if not toxic.any() or toxic.all():
        return 0.0
    order = np.argsort(margin)
    margin, toxic = margin[order], toxic[order]
    wrong = np.cumsum(toxic)[:-1] / toxic.sum() + (np.cumsum((~toxic)[::-1])[::-1][1:]) / (~toxic).sum()
    best = np.flatnonzero(wrong == wrong.min())
    at = best[np.argmax((margin[1:] - margin[:-1])[best])]
    return float((margin[at] + margin[at + 1]) / 2)


def scored(texts: pa.Array, model: dict) -> np.ndarray:
    """Score of each text. As the model is linear, a word's share in the logit is the mean of its n-grams' shares."""
    place, before, bucket, grams_before = subwords(*words.texts_of(texts))
    logit = np.where(np.diff(before) > 0, float(model["bias"]), float(model["empty"]))
    if len(place):
        share = means(model["grams"][bucket].astype(np.float64), grams_before)
        slots, starts, text = passages(before)
        head = np.flatnonzero(np.diff(text, prepend=-1))
        logit[text[head]] += np.maximum.reduceat(means(share[place[slots]], starts), head)
    return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))


def model_of(docs: DataFrame, labels: DataFrame, folds: int = 5, sample: int = SAMPLE, seed: int = 1) -> dict:
    """The model, fitted in one task on at most `sample` labelled documents of each class: those whose hashed ids are
    smallest, among documents whose id is not in the held-out fold. A document with several labels has the largest.
    Without labelled documents of both classes every text scores one half."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), folds) != 0))
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("label"))
    near = [F.xxhash64(F.lit(seed), "doc_id"), F.col("doc_id")]
    picked = known.filter("label = 0").orderBy(*near).limit(sample).unionByName(known.filter("label = 1").orderBy(*near).limit(sample))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id"]).repartition(1).sortWithinPartitions("doc_id")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [batch for batch in batches if batch.num_rows]
        if not tables:
            return
        table = pa.Table.from_batches(tables).combine_chunks()
        truth = table.column("label").to_numpy()
        if 0 < truth.sum() < len(truth):
            yield pa.RecordBatch.from_arrays([pa.array([fit(table.column("text").combine_chunks(), truth, seed)])], ["model"])

    row = rows.select("text", "label").mapInArrow(task, "model binary").first()
    if row is None:
        return {"grams": np.zeros(BUCKETS, np.float32), "bias": 0.0, "empty": 0.0}
    with np.load(io.BytesIO(bytes(row[0]))) as file:
        return dict(file)


def scores(docs: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per input row.

    Only the texts are read for a score. Null and empty texts, and others without words, score like the median clean text. Null and
    repeated doc_ids are scored like others, a null one is held out. Other columns do not matter.
    """
    model = model_of(docs, labels, folds, sample)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in words.slices(whole):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scored(batch.column("text"), model))], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(task, "doc_id bigint, score double")
    held, predicted = remainder(F.col("doc_id"), folds) == 0, (F.col("score") >= threshold).cast("int")
    return found.select("doc_id", held.alias("held_out"), "score", predicted.alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of docs, with all their columns, that score below the threshold."""
    model = model_of(docs, labels)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in words.slices(whole):
                text = batch.column(batch.schema.get_field_index("text"))
                yield batch.filter(pa.array(scored(text, model) < threshold))

    return docs.mapInArrow(task, docs.schema)
