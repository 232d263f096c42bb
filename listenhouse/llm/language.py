"""Language identification by nearest centroid.

A text becomes a vector of character n-grams (1 to 3 bytes of its letters in
lower case, hashed to ``DIMENSIONS`` places): logarithmic counts times inverse
document frequency, at unit length. Every language has up to ``CENTROIDS``
centroids from spherical k-means; the nearest one by cosine decides. A text is
rejected if its cosine is below the limit of that language for texts of its number of
distinct n-grams. Limits are learned: each half of a language's sample, cut to several lengths,
is compared with the centroids of the other half, and the limit is ``MARGIN`` of a
low quantile. Texts of fewer than ``FEW`` distinct n-grams, and languages with too few learning rows
to tell, have only the fixed limit ``MAX_DISTANCE``.

Document frequencies cover all learning rows. The centroids are fitted on a
sample of at most ``SAMPLE`` rows of each language, those with the least hash
of id and text. The model is languages x centroids x dimensions, so its size
does not grow with the corpus.

Defined results: null text or text without a letter is ``und`` with score 0
and is rejected; null ids are not held out; rows of null language are not
learned from. Ties go to the language that sorts first. Without any row to learn
from every text is ``und``. Other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from listenhouse.llm.words import LOWER, slices, utf8

DIMENSIONS = 4096
CENTROIDS = 4
#: Learning rows of each language that centroids are fitted on.
SAMPLE = 400
#: One minus the cosine to the nearest centroid above which a text is rejected.
MAX_DISTANCE = 0.97
#: Quantile of the cosines of learning rows, the share of it that is the limit, the rows it takes, and the n-grams a text needs to be told.
QUANTILE = 0.01
MARGIN = 0.6
LEAST_ROWS = 20
FEW = 24
#: Characters that learning rows are cut to, besides the whole row.
LENGTHS = (12, 24, 48, 96, 192, 384, 768, 1536, 3072)
ROUNDS = 8
_BASES = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))

_BYTES = np.arange(256)
_LETTER = ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)


def counts(column: pa.Array) -> np.ndarray:
    """Rows of n-gram counts. Anything but letters counts as one space; n-grams do not cross texts."""
    raw, offsets = utf8(column)
    n = len(column)
    data = LOWER[raw]
    data = np.where(_LETTER[data], data, 32).astype(np.uint32)
    text = np.repeat(np.arange(n), np.diff(offsets))
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != 32) | (data[:-1] != 32) | (text[1:] != text[:-1])
    data, text = data[keep], text[keep]
    total = np.zeros(n * DIMENSIONS, np.int64)
    gram = np.zeros(len(data), np.uint32)
    for size, base in enumerate(_BASES, 1):
        m = len(data) - size + 1
        if m <= 0:
            break
        gram = (gram[:m] * np.uint32(257)) + data[size - 1 :]
        place = ((gram * base) >> np.uint32(20)).astype(np.int64)
        own = text[:m] == text[size - 1 :]
        if size == 1:
            own &= data != 32
        total += np.bincount((text[:m] * DIMENSIONS + place)[own], minlength=n * DIMENSIONS)
    return total.reshape(n, DIMENSIONS)


def weighted(rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows at unit length; a row without n-grams stays zero."""
    out = np.log1p(rows).astype(np.float32) * idf.astype(np.float32)
    length = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return np.divide(out, length, out=out, where=length > 0)


def _parts(batches, text: int):
    """Slices whose count rows take at most some 16 MB."""
    for part in slices(batches, text, 1 << 20):
        for i in range(0, part.num_rows, 256):
            yield part.slice(i, 256)


def _frequencies(batches):
    df, n = np.zeros(DIMENSIONS, np.int64), 0
    for part in _parts(batches, 0):
        df += (counts(part.column(0)) > 0).sum(axis=0)
        n += part.num_rows
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(DIMENSIONS), -1)), pa.array(np.append(df, n))], ["place", "n"])


def _vectors(texts: list[str], idf: np.ndarray):
    """TF-IDF rows and their numbers of distinct n-grams, slice by slice."""
    for part in _parts([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])], 0):
        rows = counts(part.column(0))
        yield weighted(rows, idf), (rows > 0).sum(axis=1)


def _centres(vectors: np.ndarray) -> np.ndarray:
    """Spherical k-means; starts from rows spread by farthest-first choice."""
    centres = vectors.mean(axis=0, keepdims=True)
    for _ in range(min(CENTROIDS, len(vectors)) - 1):
        far = (vectors @ centres.T).max(axis=1).argmin()
        centres = np.concatenate((centres, vectors[far : far + 1]))
    for _ in range(ROUNDS):
        near = (vectors @ centres.T).argmax(axis=1)
        for c in range(len(centres)):
            if (near == c).any():
                centres[c] = vectors[near == c].mean(axis=0)
        centres /= np.maximum(np.sqrt((centres * centres).sum(axis=1, keepdims=True)), 1e-12)
    return centres


def _bucket(grams: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(grams, 1)).astype(int)


def _limits(texts: list[str], vectors: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The least cosine of a text of the language, by the logarithm of its number of distinct n-grams."""
    limits = np.full(_bucket(np.array(DIMENSIONS)) + 1, 1 - MAX_DISTANCE)
    if len(texts) < 2 * LEAST_ROWS:
        return limits
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for half in (0, 1):
        centres = _centres(vectors[1 - half :: 2])
        own = texts[half::2]
        for length in (*LENGTHS, None):
            cut = [t[:length] for t in own if length is None or len(t) > length]
            found += [((v @ centres.T).max(axis=1), n) for v, n in (_vectors(cut, idf) if cut else ())]
    cosine, grams = (np.concatenate(x) for x in zip(*found))
    for b in range(len(limits)):
        own = cosine[(_bucket(grams) == b) & (grams >= FEW)]
        if len(own) >= LEAST_ROWS:
            limits[b] = max(1 - MAX_DISTANCE, MARGIN * np.quantile(own, QUANTILE))
        elif b:
            limits[b] = limits[b - 1]
    return limits


def _fit(idf: np.ndarray):
    """Centroids of one language's sample and its limits."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        texts = rows.sort_values(["rank"])["text"].tolist()
        vectors = np.concatenate([v for v, _ in _vectors(texts, idf)])
        limits = _limits(texts, vectors, idf).tolist()
        centres = _centres(vectors)
        return pd.DataFrame({"lang": key[0], "centre": [c.tolist() for c in centres], "limits": [limits] * len(centres)})

    return run


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


class Model:
    """Languages in order, their centroids, the inverse document frequencies, and the limits of each centroid's language."""

    def __init__(self, langs: list[str], centres: np.ndarray, idf: np.ndarray, limits: np.ndarray):
        self.langs, self.centres, self.idf, self.limits = langs, centres, idf, limits

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine, and whether it is below the limit."""
        rows = counts(column)
        cosine = weighted(rows, self.idf) @ self.centres.T
        best = cosine.argmax(axis=1)
        score = np.clip(cosine[np.arange(len(best)), best].astype(float), 0, 1)
        grams = (rows > 0).sum(axis=1)
        limit = np.where(grams < FEW, 1 - MAX_DISTANCE, self.limits[best, _bucket(grams)])
        return [self.langs[b] for b in best], score, score < limit


def fit(rows: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model | None:
    """Learn from all of ``rows`` whose text has a letter and whose language is known."""
    named = rows.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).where("lang is not null")
    known = named.where(has_letter(F.col("text")))
    total = {r.place: r.n for r in known.select("text").mapInArrow(_frequencies, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()}
    if not total:
        return None
    df = np.array([total[i] for i in range(DIMENSIONS)])
    idf = np.log((1 + total[-1]) / (1 + df)) + 0.1
    # Only hashes that can be among the least are shuffled: some four times the sample, however many rows there are.
    # One number per language, as the model has; a join would send all texts by language.
    sizes = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    upto = F.create_map(*[x for name, n in sizes.items() for x in (F.lit(name), F.lit(min(1.0, 4 * sample / n) * (1 << 40)))])
    likely = known.withColumn("place", F.pmod(F.xxhash64("id", "text"), F.lit(1 << 40))).where(F.col("place") < upto[F.col("lang")])
    order = Window.partitionBy("lang").orderBy("place", "id", "text")
    chosen = likely.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample)
    fitted = chosen.groupBy("lang").applyInPandas(_fit(idf), "lang string, centre array<float>, limits array<double>").orderBy("lang", "centre").collect()
    return Model([r.lang for r in fitted], np.array([r.centre for r in fitted], np.float32), idf, np.array([r.limits for r in fitted]))


def _predict(model: Model | None):
    def run(batches):
        for part in _parts(batches, 1):
            if model:
                langs, score, low = model.predict(part.column(1))
            else:
                langs, score, low = ["und"] * part.num_rows, np.zeros(part.num_rows), np.ones(part.num_rows, bool)
            letter = part.column(2).to_numpy(zero_copy_only=False)
            langs = [x if y else "und" for x, y in zip(langs, letter)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs, pa.string()), pa.array(np.where(letter, score, 0.0)), pa.array(low)], ["row", "lang_pred", "score", "low"])

    return run


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", keep: bool = False) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, rejected; ``keep`` adds ``row``, the whole input row."""
    model = fit(docs.where(~held_out(F.col(doc_id))), doc_id, text, lang)
    row = F.struct(*([F.col(f"`{c}`") for c in docs.columns] if keep else [F.col(doc_id)])).alias("row")
    source = docs.select(row, F.col(text).cast("string"), has_letter(F.col(text)))
    kind = source.schema["row"].dataType.simpleString()
    found = source.mapInArrow(_predict(model), f"row {kind}, lang_pred string, score double, low boolean")
    out = found.withColumn("rejected", (F.col("lang_pred") == "und") | F.col("low"))
    out = out.withColumn("doc_id", F.col(f"row.`{doc_id}`")).withColumn("held_out", held_out(F.col("doc_id")))
    names = ["doc_id", "held_out", "lang_pred", "score", "rejected"]
    return out.select(*names, "row") if keep else out.select(*names)


def drop_rejected(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language could be told, with their columns."""
    return identify(docs, doc_id, text, lang, keep=True).where("not rejected").select([F.col(f"row.`{c}`").alias(c) for c in docs.columns])
