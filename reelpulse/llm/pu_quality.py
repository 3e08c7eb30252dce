"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good; the unlabelled part is the web
text itself.  With class prior p and a bounded margin loss l, the unbiased risk
``p E+[l(g)] + E_u[l(-g)] - p E+[l(-g)]`` is minimised with its second part (the
risk of the unseen negatives) kept from going below zero: when it does, the step
goes up its gradient instead of down.

* Features: one pass over whole texts computes shape statistics of every
  document (repetition, symbols, letters, lines, compression), stored as a table
  of small vectors.  Labels, language, source and id are no inputs.
* Fit: on a bounded sample, ``SAMPLE`` positives and ``SAMPLE`` unlabelled rows
  with the least id hash, in the driver; its size is this parameter, whatever the
  input.  Labels are read only from rows that are not held out.
* Prior: the share of good labels among the labelled rows that are not held out,
  counted over all of them.
* Score: the margin through a logistic, for every document.

Defined results: null and empty texts have the features of an empty text and get
a score; every input row gets one row; without any positive every score is 0.5;
an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelpulse.llm.common import drop_stored, small_batches, stored

SAMPLE = 20_000
STEPS = 400
KNOTS = (0.02, 0.1, 0.25, 0.5, 0.75, 0.9, 0.98)
FEATURES = [
    "log_bytes", "log_words", "word_bytes", "distinct_words", "top_word", "repeat_next", "distinct_pairs",
    "top_pair", "lines_per_word", "distinct_lines", "upper", "digits", "blanks", "stops", "commas", "marks",
    "bars", "symbols", "above_ascii", "upper_words", "symbol_words", "short_words", "long_words", "byte_entropy",
    "compression", "worst_repeat", "worst_symbols",
]
_STOPS, _MARKS, _SYMBOLS = list(b".;:"), list(b"!?"), list(b"#$%&*+<=>@^_`~{}[]\\/")
#: Words of a stretch for the worst-stretch features.
STRETCH = 50


def text_features(text: str | None) -> list[float]:
    """Shape statistics of a whole text, in the order of FEATURES."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n_bytes, n = max(len(data), 1), max(len(words), 1)
    hist = np.bincount(np.frombuffer(data, np.uint8), minlength=256) if data else np.zeros(256, np.int64)
    share = hist / n_bytes
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:], strict=False))
    repeated = np.fromiter(map(bytes.__eq__, words, words[1:]), bool, max(len(words) - 1, 0))
    lines = [x for x in data.split(b"\n") if x.strip()]
    symbol_word = np.fromiter((w.translate(None, _WORDY) != b"" for w in words), bool, len(words))
    some = share[share > 0]

    def worst(flags):  # highest share in any stretch of words
        if len(flags) <= STRETCH:
            return float(flags.mean()) if len(flags) else 0.0
        total = np.concatenate([[0], np.cumsum(flags)])
        return float((total[STRETCH:] - total[:-STRETCH]).max() / STRETCH)

    return [
        np.log1p(len(data)), np.log1p(len(words)), len(data) / n, len(counts) / n,
        max(counts.values(), default=0) / n, repeated.sum() / n, len(pairs) / n,
        max(pairs.values(), default=0) / n, len(lines) / n, len(set(lines)) / max(len(lines), 1),
        share[65:91].sum(), share[48:58].sum(), share[9:14].sum() + share[32], share[_STOPS].sum(), share[44],
        share[_MARKS].sum(), share[124], share[_SYMBOLS].sum(), share[128:].sum(),
        sum(w.isupper() for w in words) / n, symbol_word.sum() / n, sum(len(w) <= 2 for w in words) / n,
        sum(len(w) >= 14 for w in words) / n, float(-(some * np.log2(some)).sum()),
        len(zlib.compress(data, 1)) / n_bytes, worst(repeated), worst(symbol_word),
    ]


#: Bytes that ordinary words are made of: letters, digits, plain punctuation, everything above ASCII.
_WORDY = bytes([*range(48, 58), *range(65, 91), *range(97, 123), *b".,;:'\"()-?", *range(128, 256)])


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored table (doc_id, features) with one row per row of ``docs``."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def compute(batches):
        for batch in batches:
            rows = [text_features(t.as_py()) for t in batch.column(1)]
            flat = pa.array(np.array(rows, np.float32).reshape(-1))
            offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, flat)],
                                             names=["doc_id", "features"])

    with small_batches(docs.sparkSession):
        return stored(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
                      .mapInArrow(compute, f"doc_id {id_type}, features array<float>"), "quality_features")


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never read: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


class PuModel:
    """Additive model: every feature through hinges at sample quantiles."""

    def __init__(self, sample: np.ndarray):
        self.centre, self.scale = sample.mean(0), sample.std(0) + 1e-6
        z = self._scaled(sample)
        self.knots = np.quantile(z, KNOTS, axis=0)
        self.weights = np.zeros(z.shape[1] * (1 + len(KNOTS)) + 1)

    def _scaled(self, x):
        return np.clip((x - self.centre) / self.scale, -8, 8)

    def design(self, x):
        z = self._scaled(np.asarray(x, float))
        return np.concatenate([z, *[np.maximum(z - k, 0) for k in self.knots], np.ones((len(z), 1))], axis=1)

    def fit(self, good: np.ndarray, web: np.ndarray, prior: float, steps: int = STEPS,
            rate: float = 0.03, decay: float = 1e-3):
        """Non-negative risk, full batches, Adam; returns the risk of the
        unlabelled side after each step (for tests)."""
        a, u, w = self.design(good), self.design(web), self.weights
        m, v = np.zeros_like(w), np.zeros_like(w)
        w[-1] = np.log(prior / (1 - prior))
        trace = []
        for t in range(1, steps + 1):
            sa, su = 1 / (1 + np.exp(-(a @ w))), 1 / (1 + np.exp(-(u @ w)))
            # logistic loss: l(g) = -log s, l(-g) = -log(1 - s)
            down = a.T @ (sa - 1) / len(a) * prior
            unseen = u.T @ su / len(u) - prior * (a.T @ sa) / len(a)
            risk = -np.log(np.maximum(1 - su, 1e-12)).mean() + prior * np.log(np.maximum(1 - sa, 1e-12)).mean()
            trace.append(risk)
            step = down + unseen if risk >= 0 else -unseen
            step = step + decay * np.append(w[:-1], 0)
            m, v = 0.9 * m + 0.1 * step, 0.999 * v + 0.001 * step * step
            w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        return trace

    def score(self, x) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.design(x) @ self.weights)))


def class_prior(labels: DataFrame) -> float:
    """Share of good labels among the labels that may be read, kept off 0 and 1."""
    good, n = labels.filter(~held_out(F.col("doc_id")) & F.col("quality").isNotNull()).agg(
        F.coalesce(F.sum(F.col("quality").cast("long")), F.lit(0)), F.count("*")).first()
    return min(max((good + 1) / (n + 2), 0.02), 0.98)


def fit_model(features: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> PuModel | None:
    """Fit on ``sample`` trusted positives and ``sample`` unlabelled rows."""
    order = F.xxhash64(F.lit("sample"), F.col("doc_id"))
    trusted = labels.filter(~held_out(F.col("doc_id")) & (F.col("quality") == 1)).select("doc_id").distinct()
    open_rows = features.filter(~held_out(F.col("doc_id")))

    def bounded(df):  # at most `sample` rows of a few floats each
        rows = df.orderBy(order, "doc_id").limit(sample).select("features").collect()
        return np.array([r[0] for r in rows], float).reshape(len(rows), len(FEATURES))

    good, web = bounded(open_rows.join(trusted, "doc_id", "left_semi")), bounded(open_rows)
    if not len(good):
        return None
    model = PuModel(web)
    model.fit(good, web, class_prior(labels))
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, score."""
    features = feature_table(docs)
    model = fit_model(features, labels, sample)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def score(batches):
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), float).reshape(batch.num_rows, len(FEATURES))
            values = model.score(x) if model is not None else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=["doc_id", "score"])

    return features.mapInArrow(score, f"doc_id {id_type}, score double")


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """``docs`` without the rows that score below ``threshold``, stored.

    The model is fitted as in ``quality_scores``; each text is then scored where
    it is read, so whole rows stay together and no text is shuffled.
    """
    features = feature_table(docs)
    model = fit_model(features, labels, sample)
    drop_stored(features)
    if model is None:
        return docs
    at, schema = docs.columns.index("text"), docs.schema

    def keep(batches):
        for batch in batches:
            if batch.num_rows:
                x = np.array([text_features(t.as_py()) for t in batch.column(at)], np.float32)
                yield batch.filter(pa.array(model.score(x) >= threshold))

    with small_batches(docs.sparkSession):
        return stored(docs.mapInArrow(keep, schema), "good_documents")


def op7_pu_quality(spark, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality_scores(docs, labels).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
