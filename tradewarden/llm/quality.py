"""Quality scores from compression: two zstandard dictionaries, one of good and one of bad labelled texts.

A text like the good ones compresses better with the dictionary built from them. The difference of the two compressed
sizes, divided by the size without a dictionary, is turned into a score by a logistic curve fitted to labelled texts
that the dictionaries have not seen. The curve also sees how far the text compresses at all, given its length, since a
text that repeats a few words over and over compresses alike with every dictionary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewarden.llm.common import text_of

FOLDS = 5
# Bounds of the labelled sample that the classifier is fitted on, per label: rows, and bytes of the longest text in it.
SAMPLE_ROWS = 1_500
SAMPLE_BYTES = 32_768
DICTIONARY_BYTES = 112_640
LEVEL = 3
CUT = 0.3


def remainder(id_col: str, folds: int):
    """crc32 of the id as text, modulo `folds`; NULL for a NULL id."""
    return F.pmod(F.crc32(F.col(f"`{id_col}`").cast("long").cast("string").cast("binary")), F.lit(folds))


def _dictionary(texts: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the texts; where there are too few for that, the texts themselves are the dictionary."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"\n".join(texts)[-DICTIONARY_BYTES:] or b"\n" * 8,
                                             dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class Difference:
    """Features of texts from their compressed sizes with either dictionary and with none."""

    def __init__(self, good: bytes, bad: bytes, trained: bool):
        kind = zstandard.DICT_TYPE_AUTO if trained else zstandard.DICT_TYPE_RAWCONTENT
        given = [zstandard.ZstdCompressionDict(d, dict_type=kind) for d in (good, bad)]
        for d in given:
            d.precompute_compress(level=LEVEL)
        params = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.coders = [zstandard.ZstdCompressor(level=LEVEL, dict_data=d, **params) for d in given]
        self.coders.append(zstandard.ZstdCompressor(level=LEVEL, **params))

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        sizes = np.array([[len(c.compress(t)) for c in self.coders] for t in texts], dtype=float).reshape(-1, 3)
        good, bad, plain = sizes.T
        length = np.array([len(t) for t in texts], dtype=float)
        rate, size = good / (length + 8), np.log1p(length)
        return np.column_stack([(bad - good) / plain, rate, rate ** 2, size, rate * size])


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights, the constant last, of the logistic curve with the greatest likelihood, by damped Newton steps with a
    slight ridge; the likelihood grows with every step."""
    middle, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1
    a = np.column_stack([(x - middle) / scale, np.ones(len(x))])
    w, ridge = np.zeros(a.shape[1]), 0.1

    def loss(w: np.ndarray) -> float:
        z = a @ w
        return np.logaddexp(0, z).sum() - y @ z + ridge / 2 * (w @ w)
    for _ in range(100):
        p = _curve(a @ w)
        down = a.T @ (y - p) - ridge * w
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w)), down)
        size = 1.0
        while size > 1e-8 and loss(w + size * step) > loss(w) - 1e-4 * size * (down @ step):
            size /= 2  # a full step can overshoot where the curve is flat
        w = w + size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return np.append(w[:-1] / scale, w[-1] - (w[:-1] * middle / scale).sum())


def _curve(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


#: Rows whose texts are held as bytes and compressed together.
ROWS = 256


def _score(model: dict, difference: Difference | None, texts: list[bytes]) -> np.ndarray:
    if difference is None:
        return np.full(len(texts), model["constant"])
    return _curve(difference(texts) @ model["curve"][:-1] + model["curve"][-1])


def _some_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            yield batch.slice(at, ROWS)


def _difference(model: dict) -> Difference | None:
    return None if "constant" in model else Difference(model["good"], model["bad"], model["trained"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        folds: int = FOLDS, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> dict:
    """The model, from a bounded sample of the labelled rows outside fold 0.

    The sample holds for each label the `sample_rows` labelled documents with the smallest hashed ids among those of 1 to
    `sample_bytes` bytes, whole. Three in four of them build the dictionary, the fourth calibrates the score."""
    marks = labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
    marks = (marks.where(F.col("label").isin(0, 1) & (remainder("id", folds) != 0))
             .groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
             .where("label = other").drop("other"))
    # Ids first, by label and hash; texts only for those. Twice the rows, since too long and missing texts fall out.
    chosen = [marks.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(2 * sample_rows) for k in (0, 1)]
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_of(text_col).alias("text"))
    texts = texts.where(F.octet_length("text").between(1, sample_bytes))
    # At most 4 * sample_rows pairs of numbers are broadcast.
    found = texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    rows = [r for k in (0, 1) for r in
            found.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(sample_rows).collect()]
    sample = {k: [r.text.encode() for r in rows if r.label == k] for k in (0, 1)}
    total = sum(map(len, sample.values()))
    if not sample[0] or not sample[1]:
        return {"constant": (len(sample[1]) + 1) / (total + 2)}
    learn = {k: [t for i, t in enumerate(v) if i % 4 or len(v) < 8] for k, v in sample.items()}
    check = {k: [t for i, t in enumerate(v) if not i % 4 or len(v) < 8] for k, v in sample.items()}
    dictionaries = [_dictionary(learn[k]) for k in (1, 0)]
    trained = all(d.dict_id() for d in dictionaries)
    if not trained:
        dictionaries = [zstandard.ZstdCompressionDict(b"\n".join(learn[k])[-DICTIONARY_BYTES:] + b"\n" * 8,
                                                      dict_type=zstandard.DICT_TYPE_RAWCONTENT) for k in (1, 0)]
    model = {"good": dictionaries[0].as_bytes(), "bad": dictionaries[1].as_bytes(), "trained": trained}
    x = Difference(**model)(check[0] + check[1])
    y = np.repeat([0.0, 1.0], [len(check[0]), len(check[1])])
    return model | {"curve": _logistic(x, y)}


def _scores(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        difference = _difference(model)
        for batch in _some_rows(batches):
            score = _score(model, difference, [t.encode() for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([*(c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "text"),
                                              pa.array(score, pa.float64())],
                                             names=[*(n for n in batch.schema.names if n != "text"), "score"])
    return run


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS,
          cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of `docs`, over whole texts.

    NULL texts count as empty; an empty text gets the score of its (zero) difference. A row without an id has held_out false.
    Without labelled texts of both kinds every score is the same share. Other columns are ignored, whatever their names."""
    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                        F.coalesce(remainder(id_col, folds) == 0, F.lit(False)).alias("held_out"), text_of(text_col).alias("text"))
    scored = plain.mapInArrow(_scores(model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def keep(docs: DataFrame, model: dict, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """The rows of `docs` that the classifier doesn't reject, with all their columns. A NULL text counts as empty and is
    kept or rejected as one; an empty table stays empty; texts of any length are compressed whole."""
    schema = docs.schema
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        difference = _difference(model)
        for batch in _some_rows(batches):
            score = _score(model, difference, [(t or "").encode() for t in batch.column(at).to_pylist()])
            yield batch.filter(pa.array(score >= cut))

    return docs.mapInArrow(run, schema)
