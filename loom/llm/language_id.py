"""Language ID: averaged hashed subword embeddings under a linear softmax, with a calibrated rejection."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from loom.llm.common import attach
from loom.llm.textnp import chunks

BUCKETS = 1 << 16
DIMENSIONS = 16
#: Bounds of the training sample: documents of each language, the most frequent languages, and characters of a document; a
#: longer one is learned from STRETCHES stretches at even distances over the whole of it.
TRAIN_PER_LANGUAGE, MAX_LANGUAGES, TRAIN_CHARS, STRETCHES = 1200, 200, 20_000, 20
#: The rejection threshold makes the accepted calibration texts right at this rate, but rejects no more of the rightly
#: predicted ones than this share.
ACCURACY, MAX_REJECTED = 0.995, 0.01
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    """table: embeddings times output weights, one row a bucket (averaging and the linear layer commute)."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float


def _letters(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z as a-z and every other ASCII byte but letters as a blank."""
    low = data | 0x20
    return np.where(data >= 128, data, np.where((low >= 97) & (low <= 122), low, 32)).astype(np.uint32)


def subwords(data: np.ndarray, offs: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bucket ids of the byte 2-, 3- and 4-grams within words (blanks stand for word ends), for each a list and its documents."""
    b = np.full(len(data) + 2 * (len(offs) - 1), 32, np.uint32)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs) + 2)
    own = np.arange(len(data)) + 2 * np.repeat(np.arange(len(offs) - 1), np.diff(offs)) + 1
    b[own] = _letters(data)
    letter = b != 32
    ids, docs, code = [], [], b.copy()
    for n in (2, 3, 4):
        m = len(b) - n + 1
        if m <= 0:
            break
        code = code[:m] * np.uint32(257) + b[n - 1 :][:m]
        ok = letter[1 : 1 + m].copy() if n > 2 else letter[:m] | letter[1 : 1 + m]
        if n == 4:
            ok &= letter[2 : 2 + m]
        ok &= doc[:m] == doc[n - 1 :][:m]
        at = np.flatnonzero(ok)
        ids.append(((code[at] * np.uint32(2654435761) + np.uint32(n * 40503)) >> np.uint32(16)).astype(np.int64))
        docs.append(doc[at])
    return ids, docs


def _scores(model: LanguageModel, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    best, score = np.zeros(len(column), np.int64), np.zeros(len(column))
    for i, j, data, offs in chunks(column):
        total, n = np.zeros((j - i, len(model.languages))), np.zeros(j - i)
        for ids, doc in zip(*subwords(data, offs), strict=True):
            n += np.bincount(doc, minlength=j - i)
            for k in range(len(model.languages)):
                total[:, k] += np.bincount(doc, model.table[ids, k], minlength=j - i)
        p = _softmax((total / np.maximum(n, 1)[:, None] + model.bias) / model.temperature)
        best[i:j], score[i:j] = p.argmax(1), np.where(n > 0, p.max(1), 0.0)
    return best, score


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit(texts: list[str], langs: list[str], seed: int = 7, epochs: int = 4, accuracy: float = ACCURACY, max_rejected: float = MAX_REJECTED) -> LanguageModel:
    """Stochastic gradient descent over whole training texts and short passages of them; a fifth of the texts calibrates.

    The temperature minimises the log loss of the calibration texts; the rejection threshold is the smallest score at which
    the accepted ones are right with the given accuracy, or a smaller one where that would reject more than max_rejected of
    the rightly predicted ones (a few wrong labels among sure texts must not reject clean documents).
    """
    languages = sorted(set(langs))
    if not languages:
        return LanguageModel([UNKNOWN], np.zeros((BUCKETS, 1), np.float32), np.zeros(1), 1.0, 1.0)
    rng, y = np.random.default_rng(seed), np.array([languages.index(x) for x in langs])
    hold = rng.random(len(texts)) < 0.2
    if len(texts) < 20:
        hold[:] = False
    e, w, bias = rng.normal(0, 0.05, (BUCKETS, DIMENSIONS)), rng.normal(0, 0.05, (DIMENSIONS, len(languages))), np.zeros(len(languages))

    def features(text: str) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(text.encode(), np.uint8)
        ids, _ = subwords(raw, np.array([0, len(raw)]))
        return np.unique(np.concatenate(ids), return_counts=True) if ids else (np.zeros(0, int), np.zeros(0, int))

    def passage(text: str) -> str:
        words = text.split()
        if len(words) < 4:
            return text
        at, n = rng.integers(0, len(words)), rng.integers(1, 12)
        return " ".join(words[at : at + n])

    train = [(features(t), k) for t, k, h in zip(texts, y, hold, strict=True) if not h]
    train += [(features(passage(t)), k) for t, k, h in zip(texts, y, hold, strict=True) if not h for _ in range(2)]
    train = [(f, k) for f, k in train if len(f[0])]
    for epoch in range(epochs):
        rate = 1.0 * (1 - epoch / epochs)
        for i in rng.permutation(len(train)):
            (u, c), k = train[i]
            share = c / c.sum()
            h = share @ e[u]
            g = _softmax(h @ w + bias)
            g[k] -= 1
            back = w @ g
            w -= rate * np.outer(h, g)
            bias -= rate * 0.1 * g
            e[u] -= rate * 20 * share[:, None] * back
    model = LanguageModel(languages, (e @ w).astype(np.float32), bias, 1.0, 0.0)
    held = [(t, k) for t, k, h in zip(texts, y, hold, strict=True) if h] or list(zip(texts, y, strict=True))
    raw = np.stack([_logits(model, features(t)) for t, _ in held])
    truth = np.array([k for _, k in held])
    losses = {t: -np.log(_softmax(raw / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in np.geomspace(0.1, 10, 41)}
    temperature = min(losses, key=losses.get)
    p = _softmax(raw / temperature)
    order = np.argsort(-p.max(1), kind="stable")
    right = (p.argmax(1) == truth)[order]
    good = np.flatnonzero(np.cumsum(right) / np.arange(1, len(right) + 1) >= accuracy)
    last = len(right) - 1 if len(good) and good[-1] == len(right) - 1 else (good[-1] if len(good) else 0)
    threshold = 0.0 if last == len(right) - 1 else float(p.max(1)[order][last])
    if right.any():
        threshold = min(threshold, float(np.quantile(p.max(1)[order][right], max_rejected, method="lower")))
    return LanguageModel(languages, model.table, bias, float(temperature), threshold)


def _logits(model: LanguageModel, f: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    u, c = f
    return (c @ model.table[u] / c.sum() if len(u) else 0) + model.bias


def training_row(id_col: str = "doc_id") -> Column:
    """Rows that may be learned from: crc32 of the id as text, modulo 5, is not 0."""
    return F.crc32(F.col(id_col).cast("string")) % 5 != 0


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = TRAIN_PER_LANGUAGE,
        max_languages: int = MAX_LANGUAGES, max_chars: int = TRAIN_CHARS) -> LanguageModel:
    """Fits on at most per_language labelled training documents of each of the max_languages most frequent languages.

    Rows without a language, an id or a text are not learned from; rows alike in id and text count once; extra columns are
    not read. Texts of more than max_chars characters give stretches from all over the text instead of the whole. Without
    labelled rows the model rejects everything.

    The first scan counts the languages and (by a sketch) their distinct rows. Hashes of id and text are uniform, so a limit
    on the hash gives about one and a half times the sample, which the second scan cuts to its stretches; the first by hash
    of each language are fetched, never more than max_languages times per_language rows.
    """
    text, n = F.col(text_col), F.length(text_col)
    step = F.floor((n - max_chars // STRETCHES) / F.lit(STRETCHES - 1)).cast("int")
    stretches = F.transform(F.sequence(F.lit(0), F.lit(STRETCHES - 1)), lambda k: text.substr((k * step + 1).cast("int"), F.lit(max_chars // STRETCHES)))
    known = F.col(lang_col).isNotNull() & text.isNotNull() & training_row(id_col)
    rows = docs.where(known).select(F.col(lang_col).cast("string").alias("lang"),
        F.xxhash64(F.col(id_col).cast("string"), text, F.lit("language sample")).alias("order"),
        F.when(n > max_chars, F.array_join(stretches, " ")).otherwise(text).alias("text"))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("order").alias("different"))
    counts = counts.orderBy(F.desc("n"), "lang").limit(max_languages).collect()
    if not counts:
        return fit([], [])
    limits = docs.sparkSession.createDataFrame([(r.lang,
        min(2**63 - 1, int(min(1.0, 1.5 * per_language / max(1, r.different)) * 2**64) - 2**63)) for r in counts], "lang string, most long")
    near = rows.join(F.broadcast(limits), "lang").where(F.col("order") <= F.col("most")).groupBy("lang", "order").agg(F.min("text").alias("text"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    found = sorted((r.lang, r.order, r.text) for r in near.withColumn("nth", nth).where(F.col("nth") <= per_language).select("lang", "order", "text").collect())
    return fit([x[2] for x in found], [x[0] for x in found])


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """docs with lang_pred, score (0 to 1) and accepted; columns of these names are replaced, all others kept.

    lang_pred is 'und', score 0 and accepted false where the text is null or has no letter, or nothing was learned. accepted
    is false where the score lies below the model's rejection threshold. Whole texts are scored; equal texts get equal rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    letter = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))

    def make(column: pa.Array) -> list[pa.Array]:
        model = held.value
        best, score = _scores(model, column)
        return [pa.array([model.languages[k] for k in best], pa.string()), pa.array(score, pa.float64())]

    out = attach(docs, text_col, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())], make)
    known = letter & (F.col("lang_pred") != UNKNOWN)
    return out.withColumns({"lang_pred": F.when(known, F.col("lang_pred")).otherwise(UNKNOWN), "score": F.when(known, F.col("score")).otherwise(0.0),
        "accepted": known & (F.col("score") >= model.threshold)})
