"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams.

Features are the 1- to 3-grams of a text's letters (lower-cased, every stretch
of other characters one space), hashed to 2^16 numbers.  Term frequency is the
share of the text's n-grams, inverse document frequency comes from all
training texts.  ``fit`` learns with follow-the-regularised-leader (FTRL-
Proximal) and elastic-net penalties, so that rare n-grams keep a weight of
exactly zero, and then fits one softmax temperature on rows left out of the
training.  As frequencies are shares, the score of a text is a sum over its
n-grams, which whole texts of any length stream through in pieces.

Document frequencies cover every training row.  The regression itself is
fitted on a bounded sample: at most ``PER_LANG`` rows of each language, those
with the least hashes; the driver holds their distinct n-grams (at most 2^16
of 6 bytes a row).

Defined results: null texts and texts without a letter are ``und`` with score
0; so is everything if no training row has a language and a letter; with a
single language every other text gets it with score 1; repeated training rows
count as often as they occur in the frequencies; other columns are kept by
``predict`` and never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

DIMS = 1 << 16
PER_LANG = 400
PIECE = 1 << 20  # characters handled at once
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 2e-4, 1e-4
UNKNOWN = "und"


def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(1 << 16)])


def ngrams(text: str, letters: np.ndarray):
    """Hashed numbers of a text's n-grams, in pieces of bounded length."""
    for first in range(0, len(text), PIECE):
        # Two characters before the piece, so that no n-gram is cut (the three
        # n-grams inside these two count twice).
        code = np.frombuffer(text[max(0, first - 2) : first + PIECE].lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        alpha = np.where(code < 1 << 16, letters[np.minimum(code, 0xFFFF).astype(np.int64)], True)
        code[~alpha] = 32
        code = code[alpha | np.append(True, alpha[:-1])]
        out = []
        for n in (1, 2, 3):
            if len(code) >= n:
                h = np.full(len(code) - n + 1, n, np.uint64)
                for j in range(n):
                    h = (h ^ code[j : len(code) - n + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
                    h ^= h >> np.uint64(29)
                out.append((h >> np.uint64(13)) & np.uint64(DIMS - 1))
        yield np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


def _texts(column) -> list[str | None]:
    return column.to_pylist()


def document_frequencies(train: DataFrame, letters: np.ndarray) -> tuple[np.ndarray, int]:
    """Number of training texts with each n-gram, and of training texts; at
    most ``DIMS`` rows reach the driver."""

    def task(batches):
        total, seen = np.zeros(DIMS + 1, np.int64), np.zeros(DIMS, bool)
        for batch in batches:
            for text in _texts(batch.column(0)):
                seen[:] = False
                for piece in ngrams(text or "", letters):
                    seen[piece] = True
                total[:DIMS] += seen
                total[DIMS] += 1
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"gram": pa.array(used, pa.int32()), "n": pa.array(total[used], pa.int64())})

    counts = np.zeros(DIMS + 1, np.int64)
    for gram, n in train.select("text").mapInArrow(task, "gram int, n bigint").groupBy("gram").agg(F.sum("n")).collect():
        counts[gram] = n
    return counts[:DIMS], int(counts[DIMS])


def sample(train: DataFrame, per_lang: int, letters: np.ndarray) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(lang, n-grams, shares) of up to ``per_lang`` rows of each language: the
    rows with the least hashes."""
    sizes = train.groupBy("lang").agg(F.count("*").alias("size"))
    order = F.xxhash64(F.lit(17), "key", "text")
    # Rows beyond a generous share of their language cannot be among the least;
    # the rank then bounds the sample whatever the hashes.
    near = train.withColumn("order", order).join(F.broadcast(sizes) if sizes.count() < 10_000 else sizes, "lang")
    near = near.where(F.pmod("order", F.lit(1 << 30)) < (F.lit(1 << 30) * F.least(F.lit(1.0), F.lit(2.0 * per_lang + 100) / F.col("size"))))
    from pyspark.sql import Window

    chosen = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("order", F.lit(1 << 30)), "order", "text"))).where(F.col("rank") <= per_lang)

    def task(batches):
        for batch in batches:
            grams, shares = [], []
            for text in _texts(batch.column(1)):
                counts = np.zeros(DIMS, np.int64)
                for piece in ngrams(text, letters):
                    counts += np.bincount(piece, minlength=DIMS)
                used = np.flatnonzero(counts)
                grams.append(used.astype("<u2").tobytes())
                shares.append((counts[used] / max(1, counts.sum())).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(grams, pa.binary()), pa.array(shares, pa.binary())], names=["lang", "order", "grams", "shares"])

    rows = chosen.select("lang", "text", "order").mapInArrow(task, "lang string, order bigint, grams binary, shares binary").collect()
    rows = sorted(rows, key=lambda r: (r["order"], r["lang"], r["grams"]))
    return [(r["lang"], np.frombuffer(r["grams"], "<u2").astype(np.int64), np.frombuffer(r["shares"], "<f4").astype(np.float64)) for r in rows]


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # DIMS x languages, times the inverse document frequency
    bias: np.ndarray
    temperature: float


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train_ftrl(rows: list, n_langs: int, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-Proximal over (language number, n-grams, values); elastic net: an
    n-gram whose summed gradient stays within L1 has weight zero."""
    # One more feature, always on and not penalised, is the bias.
    z, n = np.zeros((DIMS + 1, n_langs)), np.zeros((DIMS + 1, n_langs))
    l1 = L1 * np.ones(1)

    def weights(at, bias=False):
        zz, nn = z[at], n[at]
        shrunk = np.sign(zz) * np.maximum(np.abs(zz) - (0 if bias else l1), 0)
        return -shrunk / ((BETA + np.sqrt(nn)) / ALPHA + (0 if bias else L2))

    for _ in range(epochs):
        for lang, grams, values in rows:
            w, b = weights(grams), weights(np.array([DIMS]), True)
            p = _softmax(values @ w + b[0])
            p[lang] -= 1
            for at, g in ((grams, values[:, None] * p), (np.array([DIMS]), p[None])):
                bias = at[0] == DIMS
                sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
                z[at] += g - sigma * (b if bias else w)
                n[at] += g * g
    return weights(np.arange(DIMS)), weights(np.array([DIMS]), True)[0]


def calibrate(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature of least cross-entropy (golden section).  Targets are
    smoothed to (n + 1) / (n + languages), as in Platt scaling: n rows without
    an error are no proof of certainty."""
    n, k = logits.shape
    if not n or k < 2:
        return 1.0
    target = np.full((n, k), 1 / (n + k))
    target[np.arange(n), truth] = (n + 1) / (n + k)

    def loss(log_t: float) -> float:
        p = _softmax(logits / np.exp(log_t))
        return -float((target * np.log(np.maximum(p, 1e-300))).sum(1).mean())

    lo, hi, g = np.log(0.02), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def fit(docs: DataFrame, *, lang_col: str = "lang", text_col: str = "text", key_col: str = "doc_id", per_lang: int = PER_LANG) -> Model | None:
    """Learns from the rows of ``docs`` with a language and a letter; ``key_col``
    only orders the sample.  None if there is no such row."""
    letters = _letters()
    train = docs.select(docs[lang_col].alias("lang"), docs[text_col].alias("text"), docs[key_col].cast("string").alias("key"))
    train = train.where(F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}"))
    counts, n_texts = document_frequencies(train, letters)
    if not n_texts:
        return None
    rows = sample(train, per_lang, letters)
    langs = sorted({lang for lang, _, _ in rows})
    idf = np.log((1 + n_texts) / (1 + counts)) + 1
    number = {lang: i for i, lang in enumerate(langs)}
    # Values of a text are scaled by one constant, so that steps have unit size.
    scale = 30.0
    data = [(number[lang], grams, shares * idf[grams] * scale) for lang, grams, shares in rows]
    held = data[4::5]
    weights, bias = train_ftrl([r for i, r in enumerate(data) if i % 5 != 4], len(langs))
    logits = np.array([values @ weights[grams] + bias for _, grams, values in held]).reshape(len(held), len(langs))
    temperature = calibrate(logits, np.array([lang for lang, _, _ in held], np.int64))
    return Model(langs, (weights * (idf * scale)[:, None]).astype(np.float32), bias, temperature)


def predict(docs: DataFrame, model: Model | None, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (columns of these names are
    replaced)."""
    has_letter = F.coalesce(docs[text_col].rlike("\\p{L}"), F.lit(False))
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    letters = _letters()
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.temperature))

    @F.arrow_udf("struct<lang int, score double>")
    def judge(texts: pa.Array) -> pa.Array:
        weights, bias, temperature = sent.value
        lang, score = [], []
        for text in _texts(texts):
            total, n = np.zeros(len(bias)), 0
            for piece in ngrams(text or "", letters):
                total += weights[piece].sum(0, dtype=np.float64)
                n += len(piece)
            p = _softmax((total / max(1, n) + bias) / temperature)
            lang.append(int(p.argmax()))
            score.append(float(p.max()))
        return pa.StructArray.from_arrays([pa.array(lang, pa.int32()), pa.array(score, pa.float64())], names=["lang", "score"])

    langs = F.array(*[F.lit(x) for x in model.langs])
    # Texts without a letter need no Python; they are passed as null.
    judged = docs.withColumn("__judged", judge(F.when(has_letter, docs[text_col])))
    seen = F.coalesce(judged[text_col].rlike("\\p{L}"), F.lit(False))
    return judged.withColumns({
        "lang_pred": F.when(seen, F.element_at(langs, F.col("__judged.lang") + 1)).otherwise(UNKNOWN),
        "score": F.when(seen, F.col("__judged.score")).otherwise(0.0),
    }).drop("__judged")


def held_out(id_col):
    """The rows no model learns from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    judged = predict(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
