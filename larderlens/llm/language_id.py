"""Language identification in two steps: the family by softmax regression, then one-versus-one linear support vector
machines between the languages of that family.

Learned from labelled rows only: a documented, bounded sample of ROWS_PER_LANGUAGE whole texts of every language, or of
SAMPLE_ROWS in all where there are very many languages, the same rows on every run. The text is the only input of a prediction.
A text that is null or has no letter is `und` with score 0; so is every text if there is nothing to learn from.
Among the machines of a family the language with most wins is predicted, of equals the one with the larger sum of margins,
then the first by name. The score is the family's probability times the mean chance of the language's own duels.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larderlens.llm import features
from larderlens.llm.common import text_slices

ROWS_PER_LANGUAGE = 500
# Rows of all languages together; each gets an equal part of it, one row at least.
SAMPLE_ROWS = 100_000
BUCKETS = 4096
CHARS = (1, 2, 3, 4)
UNKNOWN = "und"

# Languages by family. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "iranian": ("fa", "ku", "ps", "tg"),
    "semitic": ("am", "ar", "he", "mt"),
    "dravidian": ("kn", "ml", "ta", "te"),
    "malayic": ("id", "jv", "ms", "su", "tl"),
}

PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"


def family_of(language: str) -> str:
    return next((f for f, members in FAMILIES.items() if language.lower() in members), language)


def is_held_out(doc_id: str):
    """Rows kept for testing: a third of the ids by checksum. A null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(3)) == 1, F.lit(False))


def _sample(docs: DataFrame) -> DataFrame:
    """At most ROWS_PER_LANGUAGE labelled rows of every language, chosen by a hash of doc_id; fewer where there are so many
    languages that all would have more than SAMPLE_ROWS."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~is_held_out("doc_id")).select("doc_id", "lang", "text")
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    languages = counts.count()
    most = max(1, min(ROWS_PER_LANGUAGE, SAMPLE_ROWS // max(1, languages)))
    counts = F.broadcast(counts) if languages <= SAMPLE_ROWS else counts
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    thinned = labelled.join(counts, "lang").where(draw * F.col("n") < 2 * most + 50)
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    return thinned.withColumn("place", F.row_number().over(by_hash)).where(F.col("place") <= most).select("lang", "text")


def fit(texts: list[str], languages: list[str]) -> dict:
    """The model: families with a softmax regression, and for each pair of languages of a family a separating plane."""
    rows = np.vstack(
        [
            features.hashed_rows(part, BUCKETS, CHARS)
            for _, part in text_slices(
                pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())}), limit=features.SLICE_TEXT, rows=features.SLICE_ROWS
            )
        ]
    )
    names = np.array(languages)
    own = np.array([family_of(x) for x in languages])
    families = sorted(set(own.tolist()))
    model = {"families": families, "members": {}, "duels": {}}
    model["plane"] = features.fit_logistic(rows, np.searchsorted(families, own), len(families))
    for family in families:
        members = sorted(set(names[own == family].tolist()))
        model["members"][family] = members
        for a, b in combinations(members, 2):
            both = (names == a) | (names == b)
            model["duels"][a, b] = features.fit_svm(rows[both], names[both] == a)
    return model


def predict(model: dict | None, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    told, scores = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
    known = features.has_letter(*features.code_points(texts))
    if model is None or not known.any():
        return told.tolist(), scores
    rows = features.hashed_rows(texts, BUCKETS, CHARS)
    chance = features.softmax(features.apply(rows, model["plane"]))
    best = chance.argmax(axis=1)
    for n, family in enumerate(model["families"]):
        mine = np.flatnonzero(known & (best == n))
        members = model["members"][family]
        wins, margins, odds = (np.zeros((len(mine), len(members))) for _ in range(3))
        for i, j in combinations(range(len(members)), 2):
            margin = features.apply(rows[mine], model["duels"][members[i], members[j]])
            for k, side in ((i, margin), (j, -margin)):
                wins[:, k] += side > 0
                margins[:, k] += side
                odds[:, k] += features.sigmoid(4 * side) / (len(members) - 1)
        order = np.lexsort((-margins, -wins), axis=1) if len(members) > 1 else np.zeros((len(mine), 1), dtype=int)
        first = order[:, 0]
        told[mine] = np.array(members, dtype=object)[first]
        scores[mine] = chance[mine, n] * (odds[np.arange(len(mine)), first] if len(members) > 1 else 1)
    return told.tolist(), np.clip(scores, 0, 1)


def train(docs: DataFrame) -> dict | None:
    """Fit on the sample of `docs` (doc_id, text, lang), in one task of bounded size; the planes come back to the driver."""
    import pickle

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values(["lang", "text"])
        return pd.DataFrame({"model": [pickle.dumps(fit(ordered["text"].tolist(), ordered["lang"].tolist()))]})

    found = _sample(docs).withColumn("all", F.lit(0)).groupBy("all").applyInPandas(fitted, "model binary").collect()
    return pickle.loads(found[0][0]) if found else None


def identify(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of `docs` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_slices(batch, limit=features.SLICE_TEXT, rows=features.SLICE_ROWS):
                names, scores = predict(shared.value, texts)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    ready = docs.select(F.col("doc_id").cast("long").alias("doc_id"), is_held_out("doc_id").alias("held_out"), "text")
    return ready.mapInArrow(told, PREDICTED)


def keep_accepted(docs: DataFrame, model: dict | None, least_score: float = 0.0) -> DataFrame:
    """The rows of `docs` whose language is one that was learned and, where given, scored at least `least_score`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_slices(batch, limit=features.SLICE_TEXT, rows=features.SLICE_ROWS):
                names, scores = predict(shared.value, texts)
                yield rows.filter(pa.array((np.array(names) != UNKNOWN) & (scores >= least_score)))
            pa.default_memory_pool().release_unused()

    return docs.mapInArrow(kept, docs.schema)
