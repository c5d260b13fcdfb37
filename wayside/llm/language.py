"""Language by rank-order profiles of character n-grams.

A profile is the most frequent n-grams of a text, by rank. Each language's profile comes
from the counts over all its training texts; a document goes to the language whose
profile its own is least out of place in: the ranks' differences added up, with the
profile length for an n-gram that the language lacks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from wayside.llm.batches import by_batch

#: n-grams of a profile, and their longest length (three code points fit one 64-bit key).
PROFILE, LONGEST = 300, 3
#: Distinct n-grams a task holds before it passes on what it has counted.
HELD = 1_000_000
UNKNOWN = "und"
_SPACE = 32
_CODE_POINTS = 0x110000
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.array([chr(c).isalpha() for c in range(_CODE_POINTS)]))
    return _LETTER[0]


def _grams(text: str) -> np.ndarray:
    """Keys of all n-grams of the lower-cased words, each word between two spaces."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    letter = _letters()[points]
    points = np.where(letter, points, _SPACE)
    keep = letter.copy()
    keep[:1] = True
    keep[1:] |= letter[:-1]  # of white space and signs between words one stays
    points = points[keep]
    if len(points) < 2:
        return np.empty(0, np.int64)
    found, key = [points[points != _SPACE]], points
    for n in range(2, LONGEST + 1):
        key = (key[: len(points) - n + 1] << 21) | points[n - 1 :]
        inside = points[1 : len(points) - 1] if n == 3 else None
        found.append(key if inside is None else key[inside != _SPACE])
    return np.concatenate(found)


def _top(grams: np.ndarray, size: int) -> np.ndarray:
    """The most frequent keys, ties to the smaller key."""
    keys, counts = np.unique(grams, return_counts=True)
    return keys[np.lexsort((keys, -counts))[:size]]


def profiles(df: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = PROFILE) -> DataFrame:
    """Per language the rank (from 0) and key of its most frequent n-grams, counted over all its texts.

    Rows without a language or a text count for nothing. One row for each language, n-gram
    and task is shuffled.
    """

    def count(batches):
        held: dict[str, list] = {}

        def merged(parts):
            keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return keys, np.bincount(place, np.concatenate([c for _, c in parts]), len(keys)).astype(np.int64)

        def rows():
            for lang, parts in held.items():
                keys, counts = merged(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts)], ["lang", "gram", "n"]
                )

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(lang, []).append(np.unique(_grams(text), return_counts=True))
                if len(held[lang]) >= 100:
                    held[lang] = [merged(held[lang])]
            if sum(len(k) for parts in held.values() for k, _ in parts) > HELD:
                yield from rows()
                held.clear()
        yield from rows()

    texts = df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counted = by_batch(texts.select(F.col(lang_col).cast("string"), F.col(text_col).cast("string")), count, "lang string, gram long, n long")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).withColumn("rank", F.row_number().over(order) - 1)
    return ranked.where(F.col("rank") < size).select("lang", "rank", "gram")


class Profiles:
    """Profiles side by side: for every n-gram its rank in each language, or the profile length."""

    def __init__(self, rows, size: int = PROFILE):
        self.size = size
        self.langs = sorted({r["lang"] for r in rows})
        self.grams = np.unique(np.array([r["gram"] for r in rows], np.int64))
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), size, np.int32)
        for r in rows:
            self.ranks[np.searchsorted(self.grams, r["gram"]), self.langs.index(r["lang"])] = r["rank"]

    def predict(self, text: str) -> tuple[str, float]:
        """Language and score: one less the distance as a share of the largest possible."""
        grams = _grams(text)
        if not len(grams) or not self.langs:
            return UNKNOWN, 0.0
        own = _top(grams, self.size)
        place = np.searchsorted(self.grams, own)
        place[self.grams[np.minimum(place, len(self.grams) - 1)] != own] = len(self.grams)
        ranks = self.ranks[place]
        apart = np.abs(ranks - np.arange(len(own))[:, None])
        apart[ranks == self.size] = self.size
        distance = apart.sum(0)
        best = int(np.argmin(distance))
        return self.langs[best], float(1 - distance[best] / (self.size * len(own)))


def identify(df: DataFrame, learned: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row the language whose profile is nearest, and a score from 0 to 1.

    `learned` holds profiles: a few hundred rows a language, which the driver gathers. Ties
    go to the first language by name. A null text or one without a letter is `und`, as is
    every text when no profile was learned. Rows that repeat each give a row; an empty table
    gives none; other columns are left behind. Whole texts count, in time n log n.
    """
    model = df.sparkSession.sparkContext.broadcast(Profiles(learned.collect()))

    def work(batches):
        for batch in batches:
            found = [model.value.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return by_batch(rows, work, "doc_id long, lang_pred string, score double")
