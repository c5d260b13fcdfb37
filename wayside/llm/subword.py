"""A quality classifier of averaged subword vectors.

Every word, every pair of words up to three apart, and every run of three to five bytes
of a word (its borders included) is hashed to a learned vector; a document is the average of its vectors, and a softmax over
two classes gives the score. Vectors and output weights are trained by stochastic
gradient descent on a bounded sample of labelled documents. As the output is linear in
the average, a vector's part in it is one number once training is over, and documents
are scored by averaging those numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wayside.llm.batches import Words, by_batch, passes

#: Labelled documents that training sees at most; the only bound on what is learned from.
SAMPLE = 4000
BUCKETS = 1 << 17
LENGTH, EPOCHS, RATE = 8, 5, 0.5
SHORTEST, LONGEST, REACH = 3, 5, 3
#: The score from which a document is accepted.
THRESHOLD = 0.7
SEED = 11

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - (BUCKETS.bit_length() - 1))
_INNER = bytes([0x20, *range(0x09, 0x0E)])


def _features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, texts they belong to) of all words, word pairs and byte runs of several texts."""
    words = Words(data, offsets, lower=False)
    out = [((words.hashes * _MULTIPLIER) >> _SHIFT, words.of)]
    for apart in range(1, REACH + 1):
        near = np.flatnonzero(words.of[:-apart] == words.of[apart:])
        # Whichever word repeats, the pair has the same key.
        out.append((((words.hashes[near] ^ words.hashes[near + apart]) * _MULTIPLIER) >> _SHIFT, words.of[near]))
    # A space on both sides of every text, so that its first and last words have borders too.
    n = len(offsets) - 1
    places = np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets)) + 1
    spaced = np.full(len(data) + n + 1, 0x20, np.uint8)
    spaced[places] = data
    of = np.repeat(np.arange(n + 1), np.append(np.diff(offsets) + 1, 1))
    blank = np.isin(spaced, np.frombuffer(_INNER, np.uint8))
    spaced[blank] = 0x20
    value = spaced.astype(np.uint64)
    total, clear = value[:-1] << np.uint64(8) | value[1:], None
    for size in range(SHORTEST, LONGEST + 1):
        end = len(spaced) - size + 1
        if end <= 0:
            break
        total = (total[:end] << np.uint64(8)) | value[size - 1 :]
        inner = ~blank[size - 2 : size - 2 + end]
        clear = inner if clear is None else clear[:end] & inner
        out.append((((total[clear] + np.uint64(size)) * _MULTIPLIER) >> _SHIFT, of[:end][clear]))
    return out


def _bags(column) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets of each text and their weights, which add up to one with the text's own constant."""
    out = []
    for _, data, offsets in passes(column):
        n = len(offsets) - 1
        found = _features(data, offsets)
        buckets = np.concatenate([b for b, _ in found]).astype(np.int64)
        keys, counts = np.unique(np.concatenate([o for _, o in found]) * BUCKETS + buckets, return_counts=True)
        cut = np.searchsorted(keys, np.arange(n + 1) * BUCKETS)
        for a, b in zip(cut[:-1], cut[1:]):
            weight = np.append(counts[a:b], 1).astype(np.float64)
            out.append((np.append(keys[a:b] % BUCKETS, BUCKETS), weight / weight.sum()))
    return out


def _train(bags: list, labels: np.ndarray) -> np.ndarray:
    """Stochastic gradient descent; one number for each bucket and the constant."""
    draw = np.random.default_rng(SEED)
    vectors = draw.uniform(-1 / LENGTH, 1 / LENGTH, (BUCKETS + 1, LENGTH)).astype(np.float32)
    output = np.zeros((2, LENGTH), np.float32)
    bags = [(buckets, weight.astype(np.float32)) for buckets, weight in bags]
    steps, step = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for i in draw.permutation(len(bags)):
            buckets, weight = bags[i]
            held = vectors[buckets]
            hidden = weight @ held
            logits = output @ hidden
            share = np.exp(logits - logits.max())
            error = share / share.sum()
            error[labels[i]] -= 1
            rate = np.float32(RATE * (1 - step / steps))
            back = error @ output * (rate * np.float32(len(buckets) ** 0.5))
            output -= rate * error[:, None] * hidden
            vectors[buckets] = held - weight[:, None] * back
            step += 1
    return (vectors @ (output[1] - output[0])).astype(np.float32)


def labelled(df: DataFrame, labels: DataFrame, allowed: Column, label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """Text and label of at most `sample` documents, chosen by a hash of their ids.

    `allowed` says which ids may be learned from. An id with several labels has the smallest;
    without a label, an id or a text it is not drawn. Only as many ids as the sample has are
    broadcast.
    """
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    ids = ids.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & allowed).groupBy("doc_id").agg(F.min("label").alias("label"))
    drawn = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    return rows.join(F.broadcast(drawn), "doc_id").select("doc_id", "text", "label")


def learn(sample: DataFrame) -> np.ndarray | None:
    """Train on a sample (doc_id, text, label) in one task; None if it has no rows."""

    def train(batches):
        rows = [(d, y, bag) for b in batches for d, y, bag in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), _bags(b.column(1)))]
        if rows:
            rows.sort(key=lambda r: (r[0], r[1], len(r[2][0]), r[2][0].tobytes()))  # the same order in every run
            model = _train([bag for _, _, bag in rows], np.array([y for _, y, _ in rows]))
            yield pa.RecordBatch.from_pydict({"model": pa.array([model.tobytes()], pa.binary())})

    row = by_batch(sample.select("doc_id", "text", "label").repartition(1), train, "model binary").first()
    return None if row is None else np.frombuffer(row["model"], np.float32)


def scores(model: np.ndarray | None, column) -> np.ndarray:
    """Probability of class 1 for every text of an Arrow column (null: empty)."""
    out = []
    for _, data, offsets in passes(column.fill_null("")):
        n = len(offsets) - 1
        if model is None:
            out.append(np.full(n, 0.5))
            continue
        total, count = np.full(n, float(model[BUCKETS])), np.ones(n)
        for buckets, of in _features(data, offsets):
            total += np.bincount(of, model[buckets.astype(np.int64)], n)[:n]
            count += np.bincount(of, minlength=n)[:n]
        out.append(1 / (1 + np.exp(-total / count)))
    return np.concatenate(out) if out else np.empty(0)


def score(df: DataFrame, model: np.ndarray | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row the score of its whole text.

    A null or empty text has the score of the constant alone; without a model every score is
    0.5. Rows that repeat each give a row, an empty table gives none, other columns are left
    behind.
    """
    held = df.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores(held.value, batch.column(1)))], ["doc_id", "score"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return by_batch(rows, work, "doc_id long, score double")


def accepted(df: DataFrame, model: np.ndarray | None, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of df, all columns kept, whose text reaches the threshold; without a model all."""
    if model is None:
        return df
    held = df.sparkSession.sparkContext.broadcast(model)
    place = df.columns.index(text_col)

    def work(batches):
        for batch in batches:
            yield batch.filter(pa.array(scores(held.value, batch.column(place)) >= threshold))

    return by_batch(df, work, df.schema)
