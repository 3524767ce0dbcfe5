"""Quality: heuristic labellers, their accuracies by expectation-maximisation, and a hashed linear scorer of the posteriors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loom.llm.common import attach
from loom.llm.textnp import chunks, is_space, mix, range_hashes, spans

NEVER = np.inf
#: name: (bad below, good from, good to, bad above); between them, and where it doesn't apply, a labeller abstains. Those
#: that look for one defect never vote for good: that it is absent says little.
LABELLERS = {
    "words": (1, 30, np.inf, np.inf),
    "symbols": (-1, NEVER, NEVER, 0.12),
    "capitals": (-1, NEVER, NEVER, 0.5),
    "word_length": (2.2, 3, 9, 12),
    "distinct_words": (0.25, 0.45, 2, 2),
    "word_again": (-1, NEVER, NEVER, 0.2),
    "repeated_lines": (-1, NEVER, NEVER, 0.3),
    "exclamations": (-1, NEVER, NEVER, 0.2),
    "digits": (-1, NEVER, NEVER, 0.3),
    "odd_endings": (-1, NEVER, NEVER, 0.4),
    "lone_marks": (-1, NEVER, NEVER, 0.15),
    "plain_words": (0.3, 0.6, 2, 2),
}
#: Marks that may end a word of a sentence.
SENTENCE = np.frombuffer(b".,;:!?'\")]", np.uint8)
BUCKETS = 1 << 16
#: Bound of the scorer's training sample.
TRAIN_ROWS = 6_000


@dataclass(frozen=True)
class QualityModel:
    """posterior: probability of good quality for each vote pattern; weights: of the hashed features."""

    posterior: dict[int, float]
    accuracy: dict[str, float]
    prior: float
    weights: np.ndarray
    bias: float


def _per_document(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(values)))[offs])


def _per_run(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(values)))[first])


def _distinct(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        _, at = np.unique(mix(h + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    return np.bincount(doc[at], minlength=n)


def measures(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """What the labellers look at, for each document; nan where a measure doesn't apply."""
    n = len(offs) - 1
    blank, up = is_space(data), (data >= 65) & (data <= 90)
    digit, letter = (data >= 48) & (data <= 57), up | ((data >= 97) & (data <= 122)) | (data >= 128)
    starts, ends, first = spans(~blank, offs)
    words = np.diff(first)
    ink, letters = _per_document(~blank, offs), _per_document(letter, offs)
    doc = np.repeat(np.arange(n), words)
    odd = ~letter & ~digit & ~blank & ~np.isin(data, SENTENCE)
    inner = np.concatenate(([0], np.cumsum(letter)))
    inside = inner[ends] - inner[starts]
    pure = (inside >= ends - starts - 1) & (inside > 0)
    mark = (inside == 0) & ~digit[starts]
    word = range_hashes(data, starts, ends)
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
    ls, le, lf = spans(data != 10, offs)
    lines, ldoc = np.diff(lf), np.repeat(np.arange(n), np.diff(lf))
    with np.errstate(divide="ignore", invalid="ignore"):
        return {
            "words": words.astype(float),
            "symbols": _per_document(odd, offs) / np.where(ink, ink, np.nan),
            "capitals": _per_document(up, offs) / np.where(letters, letters, np.nan),
            "word_length": letters / np.where(words, words, np.nan),
            "distinct_words": np.where(words >= 20, _distinct(word, doc, n) / np.sqrt(np.maximum(words, 1) * np.minimum(np.maximum(words, 1), 300)), np.nan),
            "word_again": np.where(words >= 4, _per_run(again, first) / np.maximum(words, 1), np.nan),
            "repeated_lines": np.where(lines >= 2, 1 - _distinct(range_hashes(data, ls, le), ldoc, n) / np.maximum(lines, 1), np.nan),
            "exclamations": _per_document(data == 33, offs) / np.where(words, words, np.nan),
            "digits": _per_document(digit, offs) / np.where(ink, ink, np.nan),
            "odd_endings": _per_run(odd[ends - 1], first) / np.where(words, words, np.nan),
            "lone_marks": _per_run(mark, first) / np.where(words, words, np.nan),
            "plain_words": _per_run(pure & ~(up[starts] & up[ends - 1] & (ends - starts > 1)), first) / np.where(words, words, np.nan),
        }


def patterns(column: pa.Array) -> np.ndarray:
    """The votes of all labellers (0 abstains, 1 bad, 2 good) as digits to the base 3."""
    out = np.zeros(len(column), np.int64)
    for i, j, data, offs in chunks(column):
        m = measures(data, offs)
        for name, (bad_below, good_from, good_to, bad_above) in LABELLERS.items():
            x = m[name]
            vote = np.where((x < bad_below) | (x > bad_above), 1, np.where((x >= good_from) & (x <= good_to), 2, 0))
            out[i:j] = out[i:j] * 3 + vote
    return out


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of each word, of the letter classes at its beginning and end, and of its being said again."""
    starts, ends, first = spans(~is_space(data), offs)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    if not len(starts):
        return doc, doc
    kind = np.where((data >= 65) & (data <= 90), 65,
        np.where(((data >= 97) & (data <= 122)) | (data >= 128), 97, np.where((data >= 48) & (data <= 57), 48, data)))
    word = range_hashes(data, starts, ends)
    again = np.zeros(len(word), np.uint64)
    again[1:] = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
    got = [word, mix(again + np.uint64(12345)), range_hashes(kind, starts, np.minimum(ends, starts + 4)) ^ np.uint64(0x3333),
        range_hashes(kind, np.maximum(starts, ends - 4), ends) ^ np.uint64(0x7777)]
    return np.tile(doc, 4), np.concatenate([(h >> np.uint64(48)).astype(np.int64) for h in got])


def expectation_maximisation(counts: dict[int, int], rounds: int = 200) -> tuple[dict[int, float], dict[str, float], float]:
    """Posteriors of the vote patterns, accuracies of the labellers and the share of good documents.

    Labellers are taken as independent given the quality; abstaining is an outcome like the votes. The start is the majority
    of votes, of which one for bad weighs four times, since most labellers look for one defect of several.
    """
    keys = sorted(counts)
    if not keys:
        return {}, dict.fromkeys(LABELLERS, 0.5), 0.5
    n = np.array([counts[k] for k in keys], float)
    votes = np.array([[k // 3**i % 3 for i in range(len(LABELLERS) - 1, -1, -1)] for k in keys])
    p = (1 + (votes == 2).sum(1)) / (2 + (votes == 2).sum(1) + 4 * (votes == 1).sum(1))
    for _ in range(rounds):
        prior = np.clip((n * p).sum() / n.sum(), 0.01, 0.99)
        log = np.log(prior / (1 - prior)) * np.ones(len(keys))
        chance = []
        for i in range(votes.shape[1]):
            good, bad = (np.array([(n * q * (votes[:, i] == v)).sum() + 1 for v in range(3)]) for q in (p, 1 - p))
            good, bad = good / good.sum(), bad / bad.sum()
            chance.append((good, bad))
            log += np.log(good[votes[:, i]] / bad[votes[:, i]])
        new = 1 / (1 + np.exp(-np.clip(log, -30, 30)))
        done = np.abs(new - p).max() < 1e-9
        p = new
        if done:
            break
    accuracy = {name: float((prior * g[2] + (1 - prior) * b[1]) / max(1e-12, prior * (g[1] + g[2]) + (1 - prior) * (b[1] + b[2]))) for name,
        (g, b) in zip(LABELLERS, chance, strict=True)}
    return dict(zip(keys, p.tolist(), strict=True)), accuracy, float(prior)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS, epochs: int = 6, seed: int = 3) -> QualityModel:
    """Votes of all documents are counted by pattern (at most 3 to the number of labellers); a sample trains the scorer.

    The sample is the first rows by the hash of id and text; their features are made where they are, so that no task and not
    the driver holds their texts. Null texts vote as empty ones and have no features; an empty table gives a model without any.
    """
    base = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    voted = attach(base, "text", [T.StructField("pattern", T.LongType())], lambda c: [pa.array(patterns(c))])
    posterior, accuracy, prior = expectation_maximisation({r.pattern: r.n for r in voted.groupBy("pattern").agg(F.count("*").alias("n")).collect()})
    base = base.withColumn("h", F.xxhash64(F.coalesce("id", F.lit("")), F.coalesce("text", F.lit("")), F.lit("quality sample")))
    limit = base.select("h").orderBy("h").limit(rows).agg(F.max("h").alias("h")).first().h
    weights, bias = np.zeros(BUCKETS), 0.0
    if limit is None:
        return QualityModel(posterior, accuracy, prior, weights, bias)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = patterns(batch.column(1))
            for i, j, data, offs in chunks(batch.column(1)):
                doc, bucket = features(data, offs)
                cell, count = np.unique(doc * BUCKETS + bucket, return_counts=True)
                cut = np.searchsorted(cell, np.arange(1, j - i) * BUCKETS)
                u, c = (pa.array(np.split(x, cut), pa.list_(pa.int64())) for x in (cell % BUCKETS, count))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(kind[i:j]), u, c],
                    names=["id", "h", "pattern", "u", "c"])

    made = base.where(F.col("h") <= limit).mapInArrow(extract, "id string, h long, pattern long, u array<long>, c array<long>")
    got = made.orderBy("h", "id").limit(rows).collect()
    sample = [(np.array(r.u), np.array(r.c) / sum(r.c), posterior[r.pattern]) for r in sorted(got, key=lambda r: (r.id or "", r.pattern, len(r.u))) if r.u]
    rng = np.random.default_rng(seed)
    for epoch in range(epochs):
        rate = 8.0 * (1 - epoch / epochs)
        for i in rng.permutation(len(sample)):
            u, c, y = sample[i]
            g = 1 / (1 + np.exp(-(c @ weights[u] + bias))) - y
            weights[u] -= rate * g * c
            bias -= 0.01 * g
    return QualityModel(posterior, accuracy, prior, weights, float(bias))


def score(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """docs with quality (the scorer's, 0 to 1), weak_posterior (the labellers') and votes; columns of these names are replaced.

    Whole texts are scored. Null and empty texts have quality 0; a vote pattern not seen in training has the prior as its
    posterior. Equal texts score alike; an empty table gives an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make(column: pa.Array) -> list[pa.Array]:
        model = held.value
        out, kind = np.zeros(len(column)), patterns(column)
        for i, j, data, offs in chunks(column):
            doc, bucket = features(data, offs)
            n = np.bincount(doc, minlength=j - i)
            total = np.bincount(doc, model.weights[bucket], minlength=j - i) if len(doc) else np.zeros(j - i)
            out[i:j] = np.where(n > 0, 1 / (1 + np.exp(-np.clip(total / np.maximum(n, 1) + model.bias, -30, 30))), 0.0)
        return [pa.array(out), pa.array([model.posterior.get(k, model.prior) for k in kind.tolist()], pa.float64()), pa.array(kind)]

    return attach(docs, text_col, [T.StructField("quality", T.DoubleType()), T.StructField("weak_posterior", T.DoubleType()),
        T.StructField("votes", T.LongType())], make)
