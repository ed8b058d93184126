"""Quality by nearest-neighbour voting among labelled documents in a latent-semantic space.

Terms are hashed runs of three bytes and hashed shapes of five-word windows (which of the words are equal), weighted by the log of
one plus their count and inverse document frequency. A bounded sample of labelled documents, as many of either label, spans the
space: its singular vectors project any document to ``DIMENSIONS`` numbers. The
labelled vectors are broadcast; blocks of documents are multiplied with all of them (exact cosines, no index), and the
``NEIGHBOURS`` nearest vote with a weight that grows with their similarity.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierlake.llm.common import in_draw, mix, text_slices, word_hashes, word_spans
from tierlake.llm.language import held_out
from tierlake.sources.staging import stage

TERMS = 4096
SHAPES = 256  # of these, columns for the shapes of windows
WINDOW = 5
SAMPLE_ROWS = 1000
DIMENSIONS = 64
NEIGHBOURS = 25
SHARPNESS = 16.0
ACCEPT = 0.7
_SLICE = 2_000_000
_ROWS = 512  # a row of counts is of fixed size, however short its text


def window_shapes(words: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """Hash of the shape of each run of ``size`` words: for every word, the place of the first word of the run equal to it."""
    count = max(0, words.size - size + 1)
    shape = np.zeros(count, dtype=np.uint64)
    for later in range(1, size):
        first = np.full(count, later, dtype=np.uint64)
        for before in range(later - 1, -1, -1):
            first[words[later : later + count] == words[before : before + count]] = before
        shape = shape * np.uint64(size) + first
    return mix(shape)


def term_counts(offsets: np.ndarray, content: np.ndarray, terms: int) -> np.ndarray:
    """Counts of hashed byte trigrams and, in the last ``SHAPES`` columns, of hashed window shapes; a row per text.

    Texts of fewer than three bytes have no terms.
    """
    rows, hashed = offsets.size - 1, terms - SHAPES
    if content.size < 3:
        return np.zeros((rows, terms), dtype=np.int64)
    code = content.astype(np.uint32)
    code = (code[:-2] << np.uint32(16)) | (code[1:-1] << np.uint32(8)) | code[2:]
    term = ((code * np.uint32(2654435761)) >> np.uint32(8)) % np.uint32(hashed)
    row = np.repeat(np.arange(rows, dtype=np.int64), np.diff(offsets))
    inside = row[:-2] == row[2:]
    counts = np.bincount(row[:-2][inside] * terms + term[inside], minlength=rows * terms)
    starts, ends, of = word_spans(offsets, content)
    shapes = (window_shapes(word_hashes(content, starts, ends)) % np.uint64(SHAPES)).astype(np.int64)
    whole = np.flatnonzero(of[: shapes.size] == of[of.size - shapes.size :])
    counts += np.bincount(of[whole] * terms + hashed + shapes[whole], minlength=rows * terms)
    return counts.reshape(rows, terms)


def _weights(counts: np.ndarray) -> np.ndarray:
    return np.log1p(counts, dtype=np.float32)


def _unit(vectors: np.ndarray) -> np.ndarray:
    norm = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return vectors / np.maximum(norm, 1e-9)


@dataclass(frozen=True)
class Model:
    """What scoring needs: at most ``2 * sample_rows`` labelled vectors and a projection of ``terms`` rows."""

    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float  # share of label 1 among all labels learned from
    neighbours: int

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Share of the weighted votes for label 1; the prior for texts without terms and without a model."""
        out = np.full(counts.shape[0], self.prior)
        some = counts.any(axis=1)
        if not self.labels.size or not some.any():
            return out
        vectors = _unit(_unit(_weights(counts[some]) * self.idf) @ self.projection)
        cosine = vectors @ self.vectors.T
        k = min(self.neighbours, self.labels.size)
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 1e-6) ** SHARPNESS
        # the sample holds as many of either label; votes count as often as their label does among all
        share = float(self.labels.mean())
        scale = np.where(self.labels > 0, self.prior / max(share, 1e-9), (1 - self.prior) / max(1 - share, 1e-9))
        weight = weight * np.maximum(scale, 1e-6)[near]
        out[some] = (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)
        return np.clip(out, 0.0, 1.0)


def fit(counts: np.ndarray, labels: np.ndarray, prior: float, dimensions: int, neighbours: int) -> Model:
    """Latent-semantic vectors of the labelled sample by the singular vectors of its weighted term matrix."""
    used = counts.any(axis=1)
    counts, labels = counts[used], labels[used]
    if not labels.size:
        empty = np.zeros((0, 1), dtype=np.float32)
        return Model(np.ones(counts.shape[1], np.float32), np.zeros((counts.shape[1], 1), np.float32), empty, labels, prior, neighbours)
    idf = np.log((1 + labels.size) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + np.float32(0.1)
    matrix = _weights(counts)
    matrix *= idf
    matrix /= np.maximum(np.sqrt(np.einsum("ij,ij->i", matrix, matrix))[:, None], 1e-9)
    projection = _leading(matrix, min(dimensions, *matrix.shape))
    return Model(idf, projection, _unit(matrix @ projection), labels.astype(np.float32), prior, neighbours)


def _leading(matrix: np.ndarray, dimensions: int, rounds: int = 10) -> np.ndarray:
    """Leading right singular vectors by subspace iteration, which needs no more than a few columns beside the matrix."""
    start = np.random.default_rng(0).standard_normal((matrix.shape[1], min(dimensions + 8, *matrix.shape)), dtype=np.float32)
    basis = np.linalg.qr(start)[0]
    for _ in range(rounds):
        basis = np.linalg.qr(matrix.T @ (matrix @ basis))[0]
    _, values, turn = np.linalg.svd(matrix @ basis, full_matrices=False)
    kept = values[:dimensions] > 1e-6
    return np.ascontiguousarray((basis @ turn.T)[:, :dimensions][:, kept], dtype=np.float32)


def _counted(terms: int):
    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, offsets, content in text_slices(batch.column(1), _SLICE, _ROWS):
                counts = np.minimum(term_counts(offsets, content, terms), 65535).astype("<u2")
                part = batch.column(0).slice(first, counts.shape[0])
                yield pa.RecordBatch.from_arrays([part, pa.array([c.tobytes() for c in counts], pa.binary())], names=["label", "counts"])

    return counted


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    terms: int = TERMS,
    dimensions: int = DIMENSIONS,
    neighbours: int = NEIGHBOURS,
) -> Model:
    """Fit on at most ``sample_rows`` documents of either label, chosen by key hash among rows not held out.

    Null labels and keys aren't learned from; a key labelled both ways counts by majority and not at all in a tie.
    """
    marks = labels.select(F.col(key).cast("long").alias("row_id"), F.col(label).cast("double").alias("label"))
    marks = marks.filter("row_id is not null and label is not null").filter(~held_out(F.col("row_id")))
    marks = marks.groupBy("row_id").agg(F.avg("label").alias("label")).filter("label != 0.5").withColumn("label", (F.col("label") > 0.5).cast("int"))
    known = docs.select(F.col(key).cast("long").alias("row_id")).distinct()
    order = W.partitionBy("label").orderBy(F.xxhash64("row_id"), "row_id")
    marks = stage(marks.join(known, "row_id", "left_semi"), "marks")
    prior = marks.agg(F.avg("label")).first()[0]
    totals = marks.groupBy("label").agg(F.count(F.lit(1)).alias("total"))  # two rows
    drawn = marks.join(F.broadcast(totals), "label").filter(in_draw(F.col("row_id"), F.col("total"), sample_rows))
    chosen = drawn.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= sample_rows)
    chosen = stage(chosen.select("row_id", "label"), "labelled")
    # at most 2 * sample_rows rows
    rows = docs.select(F.col(key).cast("long").alias("row_id"), F.col(text).cast("string").alias("body"))
    rows = rows.join(F.broadcast(chosen), "row_id").select("row_id", "label", "body").dropDuplicates(["row_id"])
    found = rows.select("label", "body").mapInArrow(_counted(terms), "label int, counts binary").collect()
    found.sort(key=lambda r: (r["label"], r["counts"]))
    counts = np.frombuffer(b"".join(r["counts"] for r in found), dtype="<u2").reshape(len(found), terms)
    return fit(counts, np.array([r["label"] for r in found], dtype=np.int64), 0.5 if prior is None else prior, dimensions, neighbours)


def score_quality(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """One row per document: ``row_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 if the score is ``accept`` or more).

    Null, empty and one- or two-byte texts get the share of label 1 among all labels learned from. Repeated rows get the same score each;
    without labels all scores are 0.5; keys may be null; other columns are ignored; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    terms = model.idf.size

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            scores = [held.score(term_counts(o, c, terms)) for _, o, c in text_slices(batch.column(2), _SLICE, _ROWS)]
            values = np.concatenate(scores) if scores else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values, pa.float64()), pa.array((values >= accept).astype(np.int32))],
                names=["row_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col(key).cast("long").alias("row_id"), F.col(text).cast("string").alias("body"))
    rows = rows.select("row_id", held_out(F.col("row_id")).alias("held_out"), "body")
    return rows.mapInArrow(score, "row_id long, held_out boolean, score double, predicted int")


def drop_low_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", reject_below: float = 0.5, **options) -> DataFrame:
    """The documents whose score reaches ``reject_below``, columns as they were, in one pass over the texts."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, key, text, **options))
    at = docs.columns.index(text)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column(at).cast(pa.large_string())
            scores = [model.score(term_counts(o, c, model.idf.size)) for _, o, c in text_slices(texts, _SLICE, _ROWS)]
            if scores:
                yield batch.filter(pa.array(np.concatenate(scores) >= reject_below))

    return docs.mapInArrow(keep, docs.schema)
