"""Language identification with a string kernel.

The kernel is the blended spectrum of presence: two texts share 1 for every character
n-gram (n from 1 to ``MOST``) that stands in both, divided by the root of their own
counts.  N-grams are hashed to ``DIMENSIONS`` places, so a text is a row of bits and the
kernel to the landmarks one matrix product.  Landmarks (Nystroem) and the training rows
are a bounded sample; the classes are learned by one-versus-rest kernel ridge regression
on the landmark features.  Scoring takes whole texts in batches.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slabwise.llm.common import documents, prepare

MOST = 4
DIMENSIONS = 1 << 13
#: Texts that the fit sees, and landmarks among them: so many in all, shared by the languages,
#: and so many of one language at most.  Every language has one of each at least.
SAMPLE, SAMPLE_PER_LANGUAGE = 12_000, 600
LANDMARKS, LANDMARKS_PER_LANGUAGE = 1_000, 60
#: Characters of a sampled text that the fit uses: a span drawn from the whole text by a hash.
#: Predictions use whole texts.
SPAN_CHARS = 4_000
RIDGE = 1e-2
UNKNOWN = "und"
_BATCH = 256
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _codes(text: str) -> np.ndarray:
    """Lower-cased code points; all but letters and marks become one blank."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    high = points > 127
    letter = (points >= 97) & (points <= 122)
    if high.any():
        odd, back = np.unique(points[high], return_inverse=True)
        letter[high] = np.array([chr(p).isalpha() for p in odd.tolist()])[back]
    codes = np.where(letter, points, 32)
    keep = np.ones(len(codes), bool)
    keep[1:] = letter[1:] | letter[:-1]
    return codes[keep].astype(np.uint64)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def presence(texts: list[str]) -> np.ndarray:
    """One row of flags per text: which hashed n-grams it holds."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    shift = np.uint64(64 - DIMENSIONS.bit_length() + 1)
    for row, text in zip(out, texts, strict=True):
        codes = _codes(text)
        rolling = np.zeros(len(codes), np.uint64)
        for n in range(1, MOST + 1):
            if len(codes) < n:
                break
            rolling = (rolling[: len(codes) - n + 1] + codes[n - 1 :] + np.uint64(n)) * _STEP
            row[(rolling ^ (rolling >> np.uint64(29))) * _STEP >> shift] = 1
    return out


def normalised_presence(texts: list[str]) -> np.ndarray:
    rows = presence(texts)
    return rows / np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1))


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray  # unit rows
    weights: np.ndarray  # landmark kernel -> one value per language

    def scores(self, texts: list[str]) -> np.ndarray:
        return normalised_presence(texts) @ self.landmarks.T @ self.weights[:-1] + self.weights[-1]


def fit(texts: list[str], languages: list[str], landmarks_per_language: int = LANDMARKS_PER_LANGUAGE, ridge: float = RIDGE) -> Model:
    """Kernel ridge regression, one language against the rest, in the space of the landmarks.

    Landmarks are the first texts of each language, so texts should come in a random order.
    """
    names = sorted(set(languages))
    label = np.array([names.index(x) for x in languages])
    each = max(1, min(landmarks_per_language, LANDMARKS // len(names)))
    chosen = np.concatenate([np.flatnonzero(label == k)[:each] for k in range(len(names))])
    landmarks = normalised_presence([texts[i] for i in chosen])
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    useful = values > 1e-6 * values.max()
    to_features = vectors[:, useful] / np.sqrt(values[useful])
    blocks = (normalised_presence(texts[low : low + _BATCH]) for low in range(0, len(texts), _BATCH))
    features = np.concatenate([(rows @ landmarks.T) @ to_features for rows in blocks])
    features = np.hstack([features, np.ones((len(texts), 1))])
    targets = np.where(label[:, None] == np.arange(len(names)), 1.0, -1.0)
    weight = 1.0 / np.bincount(label)[label][:, None]  # languages count alike, however many rows they have
    gram = features.T @ (weight * features) + ridge * np.eye(features.shape[1])
    solved = np.linalg.solve(gram, features.T @ (weight * targets))
    return Model(names, landmarks, np.vstack([to_features @ solved[:-1], solved[-1:]]).astype(np.float32))


def sample(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, most: int = SAMPLE) -> list[tuple[str, str]]:
    """At most ``per_language`` different texts of each language, in the order of a hash.

    The share that is drawn comes from the number of different texts, so a language that is
    mostly copies is learned from as many of its texts as any other.  Order statistics of a
    hash: every task passes on at most that many rows a language, so nothing large meets in
    one place.
    """
    usable = labelled.where(F.col("lang").isNotNull() & F.rlike("text", F.lit(r"\p{L}")))
    counted = usable.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text")).alias("n")).collect()  # a row a language
    if not counted:
        return []
    each = max(1, min(per_language, most // len(counted)))
    # A fraction per language first, so that only about four times the sample is ever ordered.
    shares = labelled.sparkSession.createDataFrame([(r["lang"], min(1.0, 4.0 * each / r["n"])) for r in counted], "lang string, share double")
    spread = F.shiftrightunsigned(F.xxhash64("text", "lang"), 11) / F.lit(float(1 << 53))
    few = usable.withColumn("u", spread).join(shares, "lang").where(F.col("u") < F.col("share"))
    begin = F.pmod(F.xxhash64("text", F.lit("span")), F.greatest(F.length("text") - SPAN_CHARS + 1, F.lit(1))) + 1
    picked = few.select(F.struct("u", F.substring("text", begin.cast("int"), F.lit(SPAN_CHARS)).alias("text")).alias("x"), "lang")
    rows = picked.groupBy("lang").agg(F.slice(F.array_sort(F.collect_set("x")), 1, each).alias("xs")).collect()
    return [(lang, text) for lang, _, text in sorted((r["lang"], x["u"], x["text"]) for r in rows for x in r["xs"])]


def _predict(packed: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model | None = pickle.loads(packed)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            known = [i for i, text in enumerate(texts) if model and has_letter(text)]
            for low in range(0, len(known), _BATCH):
                part = known[low : low + _BATCH]
                values = model.scores([texts[i] for i in part])
                best = values.argmax(axis=1)
                scores[part] = np.clip((values[np.arange(len(part)), best] + 1) / 2, 0, 1)
                for i, k in zip(part, best.tolist(), strict=True):
                    names[i] = model.languages[k]
            others = [n for n in batch.schema.names if n != "text"]
            answers = [pa.array(names, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays([*map(batch.column, others), *answers], [*others, "lang_pred", "score"])

    return run


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Rows that are not learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame) -> Model | None:
    """A model from ``text`` and ``lang`` of the rows that are not held out; None without any."""
    rows = sample(docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), held_out().alias("out")).where("not out"))
    return fit([text for _, text in rows], [lang for lang, _ in rows]) if rows else None


def predict(docs: DataFrame, model: Model | None, *keep: str) -> DataFrame:
    """The columns ``keep`` and ``lang_pred`` and ``score`` of every row, from its whole ``text`` alone."""
    prepare(docs.sparkSession)
    rows = docs.select(F.struct(*keep).alias("row"), F.col("text").cast("string").alias("text"))  # no name can clash inside
    schema = T.StructType([rows.schema["row"]]).add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(_predict(pickle.dumps(model)), schema).select("row.*", "lang_pred", "score")


def identify(docs: DataFrame) -> DataFrame:
    """Train on the labelled rows of ``docs`` that are not held out, then predict every row.

    ``docs`` needs ``doc_id``, ``text`` and ``lang``; others are ignored.  Returns
    ``doc_id``, ``held_out``, ``lang_pred`` and ``score`` (0 to 1).  Null, empty and
    letterless texts are ``und`` with score 0, and so is every text if nothing is labelled.
    A row with a null doc_id is not held out.  Repeated rows give repeated rows; ties
    between languages go to the first by name.  An empty table gives an empty result.  Very
    long texts are scored whole, ``_BATCH`` texts at a time.

    The fit reads a sample of the labelled texts, chosen by their hash: ``SAMPLE`` in all and
    ``SAMPLE_PER_LANGUAGE`` of one language, a span of ``SPAN_CHARS`` of each.  Every language
    is learned.
    """
    model = train(docs)
    return predict(documents(docs), model, "doc_id").select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def identify_rows(docs: DataFrame) -> DataFrame:
    """As ``identify``, with all columns of ``docs`` beside ``lang_pred`` and ``score``."""
    return predict(docs, train(docs), *docs.columns)
