"""Benchmark passages in documents: rare n-gram seeds, then local alignment.

The document frequency of every n-gram of the test items is counted over all documents;
an item's seeds are all its n-grams that occur, as an edited copy may hold any of them,
and the joins of frequent ones are dealt out. Passages of documents around seeds are
joined to the items that have the seed, and a Smith-Waterman alignment of their words
scores the pair, so that edited copies are found as well as exact ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wayside.llm.batches import Words, by_batch, passes, run_hashes, signed, texts
from wayside.llm.filters import bitmap, passing
from wayside.storage import settle

#: Words of a seed.
N = 3
#: Documents from which on a seed is frequent, and the lanes that its passages are dealt to.
FREQUENT, LANES = 10_000, 64
#: Words kept on both sides of a seed; seeds closer than that share a passage.
PAD = 64
#: Alignment scores of a word: equal, different, left out.
EQUAL, DIFFERENT, GAP = 1.0, -1.0, -1.0
#: A pair is a leak from this share of an item's words on, or from this many words.
SHARE, WORDS = 0.5, 25.0

#: All ASCII but letters and digits.
_APART = bytes(b for b in range(128) if not chr(b).isalnum())


def _words(column):
    for row, data, offsets in passes(column):
        yield row, Words(data, offsets, _APART)


def _items(items: DataFrame) -> DataFrame:
    """Each item's words as packed hashes; items with fewer words than a seed take no part."""

    def work(batches):
        for batch in batches:
            ids, held = batch.column(0).to_pylist(), []
            for row, words in _words(batch.column(1)):
                for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
                    if b - a >= N and ids[row + i] is not None:
                        held.append((ids[row + i], words.hashes[a:b].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in held], pa.int64()), pa.array([x for _, x in held], pa.binary())], ["item_id", "words"]
            )

    return by_batch(items, work, "item_id long, words binary").distinct()


def _item_grams(items: DataFrame) -> DataFrame:
    def work(batches):
        for batch in batches:
            for item, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hashes = np.frombuffer(words, np.uint64)
                grams = signed(np.unique(run_hashes(hashes, np.zeros(len(hashes)), N)[0]))
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(grams), pa.int64()), pa.array(grams)], ["item_id", "gram"])

    return by_batch(items, work, "item_id long, gram long")


def _frequencies(rows: DataFrame, grams: DataFrame) -> DataFrame:
    """Documents that have each n-gram of the items, of those that occur: a row for each n-gram and batch is shuffled."""
    held = rows.sparkSession.sparkContext.broadcast(bitmap(grams, F.col("gram")))

    def work(batches):
        for batch in batches:
            found = []
            for _, words in _words(batch.column(1)):
                hashes, at = words.runs(N)
                keep = passing(held.value, signed(hashes))
                pairs = np.unique(np.stack([words.of[at][keep], signed(hashes[keep])]), axis=1) if keep.any() else np.empty((2, 0), np.int64)
                found.append(pairs[1])
            keys, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], ["gram", "n"])

    counted = by_batch(rows, work, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return grams.select("gram").distinct().join(counted, "gram").select("gram", "n")


def _lanes(seeds: DataFrame, frequent) -> DataFrame:
    """(item_id, gram, lane): frequent seeds in every lane, the others in the first."""

    def work(batches):
        for batch in batches:
            lanes = np.where(passing(frequent.value, batch.column(1).to_numpy()), LANES, 1)
            at = np.repeat(np.arange(len(lanes)), lanes)
            lane = np.arange(len(at)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
            items, grams = (c.take(pa.array(at)) for c in batch.columns[:2])
            yield pa.RecordBatch.from_arrays([items, grams, pa.array(lane)], ["item_id", "gram", "lane"])

    return by_batch(seeds, work, "item_id long, gram long, lane long")


def _passages(rows: DataFrame, seeds: DataFrame, frequent) -> DataFrame:
    """Words around seeds: doc_id, first word, packed word hashes, the seeds in them, and each seed's lane."""
    held = rows.sparkSession.sparkContext.broadcast(bitmap(seeds, F.col("gram")))

    def work(batches):
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for row, words in _words(batch.column(1)):
                hashes, at = words.runs(N)
                keep = passing(held.value, signed(hashes))
                hashes, at = signed(hashes[keep]), at[keep]
                if not len(at):
                    continue
                of = words.of[at]
                cut = np.append(np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (at[1:] - at[:-1] > PAD))), len(at))
                for a, b in zip(cut[:-1], cut[1:]):
                    first, end = words.first[of[a]], words.first[of[a] + 1]
                    begin, stop = max(first, at[a] - PAD), min(end, at[b - 1] + N + PAD)
                    grams = np.unique(hashes[a:b])
                    lane = (ids[row + of[a]] + int(begin - first)) % LANES
                    lanes = np.where(passing(frequent.value, grams), lane, 0)
                    out.append((ids[row + of[a]], int(begin - first), words.hashes[begin:stop].tobytes(), grams, lanes))
            doc, start, packed, grams, lanes = zip(*out) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(packed, pa.binary()),
                    pa.array(list(grams), pa.list_(pa.int64())), pa.array(list(lanes), pa.list_(pa.int64())),
                ],
                ["doc_id", "start", "passage", "grams", "lanes"],
            )

    return by_batch(rows, work, "doc_id long, start long, passage binary, grams array<long>, lanes array<long>")


def align(a: np.ndarray, b: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment of two word sequences: score, and where it ends in each (exclusive)."""
    place = np.arange(len(a) + 1) * -GAP
    above, best = np.zeros(len(a) + 1), (0.0, 0, 0)
    for j, word in enumerate(b, 1):
        row = np.maximum(above + GAP, 0)
        row[1:] = np.maximum(row[1:], above[:-1] + np.where(a == word, EQUAL, DIFFERENT))
        row = np.maximum.accumulate(row + place) - place
        top = int(row.argmax())
        if row[top] > best[0]:
            best = float(row[top]), top, j
        above = row
    return best


def _aligned(batches):
    for batch in batches:
        out = []
        for doc, start, packed, item, words in zip(*(c.to_pylist() for c in batch.columns)):
            a, b = np.frombuffer(packed, np.uint64), np.frombuffer(words, np.uint64)
            least = min(SHARE * len(b), WORDS)
            # No score is above the number of the item's words that the passage has at all.
            if np.isin(b, a).sum() < least:
                continue
            score, end, end_b = align(a, b)
            if score >= least:
                _, back, _ = align(a[:end][::-1], b[:end_b][::-1])
                out.append((doc, item, score / len(b), start + end - back, start + end))
        columns = zip(*out) if out else ((),) * 5
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "item_id", "score", "start_word", "end_word"])


def leaks(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """Pairs of a document and a test item it holds a copy of, exact or edited.

    One row for each pair: doc_id, item_id, score (alignment score as a share of the item's
    words, 1 for an exact copy), and the words [start_word, end_word) of the document's best
    aligned passage. Words are runs of letters and digits (and of any non-ASCII
    character), A-Z lowered.

    Null or empty texts hold nothing, as do items of fewer than three words or without an id,
    and documents without an id. Rows that repeat an id are one document: the best passage
    of all its texts. Ties between passages go to the first. Empty tables give no rows; other
    columns are left behind.

    A copy is aligned if it holds any three words of its item in a row, however frequent
    they are; one that holds nowhere three is not.

    Neither side is broadcast; documents' n-grams pass a filter of fixed size, and passages,
    seeds and items meet in joins that Spark plans by their sizes.
    """
    rows = texts(df.where(F.col(id_col).isNotNull()), id_col, text_col)
    tests = settle(_items(texts(items, item_col, text_col)), "items")
    grams = settle(_item_grams(tests), "item-grams")
    known = settle(_frequencies(rows, grams), "frequencies")
    frequent = df.sparkSession.sparkContext.broadcast(bitmap(known.where(F.col("n") >= FREQUENT), F.col("gram")))
    seeds = settle(grams.join(known, "gram").select("item_id", "gram"), "seeds")
    passages = settle(_passages(rows, seeds, frequent).withColumn("id", F.xxhash64("doc_id", "start", "passage")), "passages")
    each = passages.select("id", F.explode(F.arrays_zip("grams", "lanes")).alias("seed"))
    each = each.select("id", F.col("seed.grams").alias("gram"), F.col("seed.lanes").alias("lane"))
    met = each.join(_lanes(seeds, frequent), ["gram", "lane"]).select("id", "item_id").distinct()
    pairs = met.join(passages.select("id", "doc_id", "start", "passage"), "id").join(tests, "item_id")
    found = by_batch(
        pairs.select("doc_id", "start", "passage", "item_id", "words"), _aligned,
        "doc_id long, item_id long, score double, start_word long, end_word long",
    )
    best = F.max_by(F.struct("score", "start_word", "end_word"), F.struct("score", -F.col("start_word"), -F.col("end_word")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")
