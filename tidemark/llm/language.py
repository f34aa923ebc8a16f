"""Language identification with string kernels, Nystroem landmarks and kernel ridge regression.

The kernel of two texts is the blended spectrum: which n-grams of bytes occur in both, for
n from 1 to 3, each length normalised on its own. Training texts are mapped to their
kernels with a few landmark texts; one ridge regression per language is solved on those
coordinates. A batch of texts is scored with two matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_view, chunks, drawn, share_of, shared_value, stored

#: Slots of n-grams by n: bytes have one each, longer ones share by hash.
SLOTS = (256, 4096, 8192)
#: Weight of each n in the kernel.
WEIGHTS = (0.2, 0.3, 0.5)
#: Labelled texts, and landmarks among them, that a language has in training, about; and landmarks of all languages.
TEXTS_PER_LANGUAGE = 1000
LANDMARKS_PER_LANGUAGE = 40
LANDMARKS = 2000
RIDGE = 1e-3
#: Texts whose n-grams a task holds as a matrix at a time.
ROWS = 128
_SEGMENT = 1 << 21
UNKNOWN = "und"


def _folding() -> np.ndarray:
    """Letters in lower case, other ASCII as blanks, the rest as it is."""
    table = np.arange(256, dtype=np.uint8)
    table[:128] = 32
    small = np.arange(97, 123, dtype=np.uint8)
    table[small] = small
    table[small - 32] = small
    return table


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per row: the n-grams that occur, as unit vectors per n, scaled by its weight."""
    rows = len(offsets) - 1
    seen = np.zeros((rows, sum(SLOTS)), np.float32)
    flat = seen.reshape(-1)
    fold = _folding()
    for begin in range(0, len(data), _SEGMENT):
        text = fold[data[begin : begin + _SEGMENT + len(SLOTS) - 1]].astype(np.uint32)
        places = np.arange(begin, begin + len(text))
        row = np.searchsorted(offsets, places, "right") - 1
        base = row * seen.shape[1]
        gram = text
        for n, slots in enumerate(SLOTS, 1):
            if n > 1:
                gram = (gram[: len(text) - n + 1] << np.uint32(8)) | text[n - 1 :]
            inside = row[: len(gram)] == row[n - 1 :][: len(gram)]
            slot = gram if n == 1 else (gram * np.uint32(2654435769)) >> np.uint32(32 - slots.bit_length() + 1)
            flat[(base[: len(gram)] + (sum(SLOTS[: n - 1]) + slot.astype(np.int64)))[inside]] = 1
    begin = 0
    for slots, weight in zip(SLOTS, WEIGHTS):
        block = seen[:, begin : begin + slots]
        block *= np.sqrt(weight / np.maximum(block.sum(axis=1, keepdims=True), 1))
        begin += slots
    return seen


def _matrices(texts: pa.Array) -> Iterator[np.ndarray]:
    data, offsets = byte_view(texts)
    for begin in range(0, len(texts), ROWS):
        part = offsets[begin : begin + ROWS + 1]
        yield presence(data[part[0] : part[-1]], part - part[0])


@dataclass(frozen=True)
class LanguageModel:
    """Languages, the landmarks' n-grams, and the weights of kernels with them."""

    languages: tuple[str, ...]
    landmarks: np.ndarray
    weights: np.ndarray

    def scores(self, texts: pa.Array) -> np.ndarray:
        """A score per text and language, 1 and -1 being the values learned."""
        parts = [m @ self.landmarks.T @ self.weights for m in _matrices(texts)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.languages)), np.float32)


def train(docs: DataFrame, *, id_col: str, text_col: str, label_col: str) -> LanguageModel:
    """Learn from a bounded sample of labelled texts, the same number of each language, drawn row by row.

    About ``TEXTS_PER_LANGUAGE`` texts per language enter; their n-grams never reach the
    driver, which gets the landmarks and sums of the size of the landmarks.
    """
    label = F.col(label_col)
    usable = docs.where(label.isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    # A stored row per language is small enough to be sent to the texts, not they to it.
    counts = stored(usable.groupBy(label.alias("label")).agg(F.count("*").alias("n")), "counts")
    each = min(LANDMARKS_PER_LANGUAGE, LANDMARKS / max(1, counts.count()))
    some = (
        usable.select(label.alias("label"), F.col(text_col).alias("text"), drawn(id_col, text_col).alias("draw"))
        .join(counts, "label")
        .where(F.col("draw") * F.col("n") < TEXTS_PER_LANGUAGE)
        .select("label", "text", (F.col("draw") * F.col("n") < each).alias("landmark"))
    )
    sample = stored(some.repartition(16), "languages")
    marks = sample.where("landmark").mapInArrow(_landmark_rows, "label string, grams binary").collect()
    marks = sorted(marks, key=lambda r: (r["label"], r["grams"]))
    languages = tuple(sorted(r["label"] for r in sample.select("label").distinct().collect()))
    if not marks:
        return LanguageModel(languages, np.zeros((0, sum(SLOTS)), np.float32), np.zeros((0, len(languages)), np.float32))
    landmarks = np.stack([np.frombuffer(r["grams"], np.float32) for r in marks])
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    useful = values > 1e-6 * values[-1]
    root = vectors[:, useful] / np.sqrt(values[useful])
    index = {name: k for k, name in enumerate(languages)}

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((root.shape[1],) * 2)
        target = np.zeros((root.shape[1], len(languages)))
        for batch in chunks(batches, 1):
            labels = np.array([index[x] for x in batch.column(0).to_pylist()])
            begin = 0
            for matrix in _matrices(batch.column(1)):
                z = (matrix @ landmarks.T).astype(np.float64) @ root
                y = np.full((len(z), len(languages)), -1.0)
                y[np.arange(len(z)), labels[begin : begin + len(z)]] = 1
                gram += z.T @ z
                target += z.T @ y
                begin += len(z)
        yield pa.record_batch([pa.array([gram.tobytes()]), pa.array([target.tobytes()])], names=["gram", "target"])

    parts = sample.select("label", "text").mapInArrow(sums, "gram binary, target binary").collect()
    gram = sum(np.frombuffer(p["gram"]).reshape(root.shape[1], -1) for p in parts)
    target = sum(np.frombuffer(p["target"]).reshape(root.shape[1], -1) for p in parts)
    ridge = np.linalg.solve(gram + RIDGE * np.trace(gram) / len(gram) * np.eye(len(gram)), target)
    return LanguageModel(languages, landmarks, (root @ ridge).astype(np.float32))


def _landmark_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, 1):
        rows = [row.tobytes() for matrix in _matrices(batch.column(1)) for row in matrix]
        yield pa.record_batch([batch.column(0), pa.array(rows, pa.binary())], names=["label", "grams"])


def identify_languages(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    folds: int = 5,
    held_out: int = 0,
) -> DataFrame:
    """``(id_col, held_out, lang_pred, score)``, one row per document.

    Learns from documents whose id's crc32 modulo ``folds`` is not ``held_out``. A text that
    is null or has no letter is ``und`` with score 0, as is every text if nothing could be
    learned. The score is the softmax of the per-language values, 0 to 1; equal values go to
    the first language by name. Repeated rows and null ids count as rows like any others.
    """
    docs = docs.select(F.col(id_col), F.col(text_col), F.col(label_col))
    fold = share_of(id_col, folds) == held_out
    model = train(docs.where(~fold), id_col=id_col, text_col=text_col, label_col=label_col)
    shared = shared_value(docs.sparkSession, model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared()
        names = np.array([*model.languages, UNKNOWN])
        for batch in chunks(batches, 2):
            known = batch.column(3).to_numpy(zero_copy_only=False) & bool(len(model.landmarks))
            scores = model.scores(batch.column(2)) if len(model.landmarks) else np.zeros((batch.num_rows, 1))
            best = scores.argmax(axis=1)
            shares = np.exp(4 * (scores - scores.max(axis=1, keepdims=True)))
            share = np.where(known, 1 / shares.sum(axis=1), 0.0)
            lang = pa.array(names[np.where(known, best, len(names) - 1)].tolist(), pa.string())
            columns = [batch.column(0), batch.column(1), lang, pa.array(share, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "held_out", "lang_pred", "score"])

    lettered = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    return docs.select(id_col, fold.alias("held_out"), text_col, lettered.alias("lettered")).mapInArrow(
        predict, f"`{id_col}` {id_type}, held_out boolean, lang_pred string, score double"
    )
