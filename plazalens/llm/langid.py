"""Language of texts, by labelling their words with a conditional random field."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import words
from .crf import Model, train

SAMPLE_ROWS = 2000
"""Labelled documents learned from, at most, as many of each language as there are."""
SAMPLE_WORDS = 48
UNKNOWN = "und"
_CHUNK = 1 << 20


def held_out(doc_id: Column) -> Column:
    """True where the CRC-32 of the id as text leaves 1 when divided by 3; false for NULL."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def learn(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", rows: int = SAMPLE_ROWS
) -> Model | None:
    """A model from a bounded sample of the labelled documents, None if there are none.

    The sample takes ``rows`` divided by the number of languages from each language, those with
    the smallest hash of the id, and of each a stretch of 48 words at a place that the hash
    chooses. The number of rows of each language is counted over all documents; of more than
    ``rows`` languages the most frequent are learned, as a sample cannot hold more.
    """
    labelled = docs.filter(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    often = labelled.groupBy(label_col).count().orderBy(F.desc("count"), label_col).limit(rows)
    counts = {r[label_col]: r["count"] for r in often.collect()}
    if not counts:
        return None
    quota = max(1, rows // len(counts))
    place = F.xxhash64(F.col(id_col))
    share = F.create_map(*[F.lit(x) for kind, n in counts.items() for x in (kind, 2.0 * quota / n)])
    chosen = labelled.select(
        F.col(label_col).alias("label"),
        place.alias("place"),
        F.col(text_col).alias("text"),
    ).filter(F.pmod("place", F.lit(1 << 20)) < share[F.col("label")] * (1 << 20))
    ws = words(F.col("text"))
    start = F.pmod(F.shiftright("place", 20), F.greatest(F.size("ws") - SAMPLE_WORDS + 1, F.lit(1))) + 1
    stretch = F.slice("ws", start.cast("int"), F.lit(SAMPLE_WORDS))
    short = F.array_join(F.transform(stretch, lambda word: F.substring(word, 1, 64)), " ")
    sample = chosen.select("label", "place", F.explode(F.array(ws)).alias("ws")).select("label", "place", short.alias("text"))
    found = sample.orderBy("place", "label", "text").limit(3 * rows).collect()
    taken: dict[str, list[str]] = {}
    for row in found:
        taken.setdefault(row.label, []).append(row.text)
    pairs = [(text, label) for label in sorted(taken) for text in taken[label][:quota]]
    return train([text for text, _ in pairs], [label for _, label in pairs])


def _predict(model: Model | None):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            labels, scores = [], []
            for part in _chunks(texts):
                if model is None:
                    labels += [UNKNOWN] * len(part)
                    scores += [0.0] * len(part)
                    continue
                shares, counts = model.label_shares(part)
                for share, best, count in zip(shares.max(axis=1), shares.argmax(axis=1), counts):
                    labels.append(model.labels[best] if count else UNKNOWN)
                    scores.append(min(1.0, round(float(share), 6)) if count else 0.0)
            columns = [batch.column(0), pa.array(labels, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    return predict


def _chunks(texts: list[str | None]) -> Iterator[list[str | None]]:
    part, held = [], 0
    for text in texts:
        part.append(text)
        held += len(text or "")
        if held >= _CHUNK:
            yield part
            part, held = [], 0
    if part:
        yield part


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``lang_pred``, ``score``.

    Learned from the documents that are not held out. The language is the one with the largest
    share of the words, by their probabilities, and the score is that share. NULL texts and
    texts without a letter are ``und`` with score 0, and so is every text if no document has a
    language. Repeated rows are predicted alike; a NULL id is not held out. Whole texts are
    read, very long ones in stretches of 128 words. Other columns are ignored.
    """
    model = learn(docs.filter(~held_out(F.col(id_col))), id_col, text_col, label_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(_predict(model), "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", score: float = 0.3
) -> DataFrame:
    """The documents with a language that holds at least ``score`` of their words, with all columns."""
    model = learn(docs.filter(~held_out(F.col(id_col))), id_col, text_col, label_col)
    sure = _sure(model, docs.columns.index(text_col), score)
    return docs.mapInArrow(sure, docs.schema)


def _sure(model: Model | None, at: int, least: float):
    predict = _predict(model)

    def sure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at)
            pair = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), texts], ["id", "text"])
            (found,) = predict(iter([pair]))
            labels, scores = found.column(1).to_pylist(), found.column(2).to_pylist()
            yield batch.filter(pa.array([label != UNKNOWN and s >= least for label, s in zip(labels, scores)], pa.bool_()))

    return sure
