"""Spelling variants: words one edit apart, by pairs of trie nodes.

The words lie in two tries, one over the words and one over the words read backwards.
Sorted words give the trie: a word's first code points that the word before it has too are
nodes that exist, the others get the next numbers. A word cut after i code points is
then a pair of integers, the node of its beginning and the (backward) node of its end. Two
pairs are written down for each cut: one that goes on right behind the cut, and one that
skips a code point. Words with the same skipping pair differ by one replaced code point; a
skipping pair equal to a plain one is a code point too many on one side.

Pairs meet by their integers in one shuffle. At most one word has a given plain pair, and
at most as many a skipping one as there are letters, so groups stay small whatever the
words are, and each gives counts and smallest numbers; pairs of words are never listed.
Nodes that a single word reaches are left out, as nothing can meet there.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from wayside.llm.batches import by_batch, texts
from wayside.storage import settle

#: Least code points and occurrences of a word, and how many times as frequent its form is.
LENGTH, LEAST, TIMES = 5, 3, 2
#: One in so many places of the text loses a letter, by a checksum.
SLIP = 97

# Runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
#: Different words that a task counts before it passes them on.
_HELD = 1 << 19
#: A node's number: the range of words that made it, then a count.
_COUNT = 40
_MASK = (1 << _COUNT) - 1


def words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", slip: int = SLIP) -> DataFrame:
    """(word, n): runs of letters of whole texts, lower-cased in A-Z, of LENGTH code points or more.

    With h the crc32 of `<doc_id>:<run>`, a run whose h the slip divides loses its code point
    h % length. A missing id is written as nothing.
    """
    rows = texts(df, id_col, text_col)

    def work(batches):
        held: Counter[bytes] = Counter()

        def told():
            long = [(w, n) for w, n in held.items() if len(w) >= LENGTH and len(w.decode()) >= LENGTH]
            held.clear()
            for a in range(0, len(long), 1 << 16):
                part = long[a : a + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in part], pa.binary()).cast(pa.string()), pa.array([n for _, n in part], pa.int64())], ["word", "n"])

        for batch in batches:
            column = batch.column(1).cast(pa.large_binary())
            for i, doc in enumerate(batch.column(0).to_pylist()):
                runs = _RUN.findall(column[i].as_py().lower())
                if not runs:
                    continue
                start = crc32(b":" if doc is None else b"%d:" % doc)
                sums = np.fromiter(map(crc32, runs, repeat(start)), np.uint32, len(runs))
                for at in np.flatnonzero(sums % slip == 0).tolist():
                    run = runs[at].decode()
                    gone = int(sums[at]) % len(run)
                    runs[at] = (run[:gone] + run[gone + 1 :]).encode()
                held.update(runs)
                if len(held) >= _HELD:
                    yield from told()
        yield from told()

    return by_batch(rows, work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _common(a: str, b: str) -> int:
    return len(os.path.commonprefix((a, b)))


def nodes(named: DataFrame) -> DataFrame:
    """(id, nodes): numbers of the trie nodes on the way of each word (id, word), the root first.

    Words are dealt out by ranges, each numbered in one pass over its sorted words. The first
    word of a range shares nodes with the last one of the range before; as it is numbered
    first, its own numbers 0, 1, ... stand for its depth, and those it shares are put right
    with a table of a row for each range. A word's way ends with the last node that it
    shares with a word beside it, its first and last of a range with the whole word.
    """
    dealt = named.select("id", "word").repartitionByRange("word").sortWithinPartitions("word")
    schema = "id long, nodes array<long>, part int, first string, last string"

    def work(batches):
        part = TaskContext.get().partitionId()
        base = part << _COUNT
        fresh, first, before, way, held = 0, None, None, [], None
        for batch in batches:
            ids, ways = [], []
            for number, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shared = -1 if before is None else _common(before, word)
                if held is not None:
                    # The way of the word before is known to its end only now.
                    ids.append(held[0])
                    ways.append(way if held[1] < 0 else way[: max(held[1], shared) + 1])
                kept = way[: shared + 1]
                way = kept + list(range(base + fresh, base + fresh + len(word) + 1 - len(kept)))
                fresh += len(word) + 1 - len(kept)
                first, before, held = word if first is None else first, word, (number, shared)
            if ids:
                yield _ways(ids, ways)
        if held is not None:
            yield _ways([held[0]], [way])
            yield pa.RecordBatch.from_pydict({
                "id": pa.array([None], pa.int64()), "nodes": pa.array([way], pa.list_(pa.int64())), "part": pa.array([part], pa.int32()),
                "first": pa.array([first], pa.string()), "last": pa.array([before], pa.string()),
            })

    numbered = settle(by_batch(dealt, work, schema), "trie")
    told = sorted(numbered.where("id is null").select("part", "nodes", "first", "last").collect(), key=lambda r: r["part"])
    right: dict[int, list[int]] = {}
    for a, b in zip(told, told[1:], strict=False):
        inherited = right.get(a["part"], [])
        own = [inherited[n & _MASK] if n & _MASK < len(inherited) else n for n in a["nodes"]]
        right[b["part"]] = own[: _common(a["last"], b["first"]) + 1]
    table = numbered.sparkSession.createDataFrame(list(right.items()) or [(-1, [])], "part int, shared array<long>")
    way = numbered.where("id is not null").select("id", "nodes", F.shiftright(F.col("nodes")[0], _COUNT).cast("int").alias("part"))
    put_right = F.expr(f"transform(nodes, n -> if(shared is not null and (n & {_MASK}L) < size(shared), shared[cast(n & {_MASK}L as int)], n))")
    return way.join(F.broadcast(table), "part", "left").select("id", put_right.alias("nodes"))


def _ways(ids: list[int], ways: list[list[int]]) -> pa.RecordBatch:
    none = pa.nulls(len(ids), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(ways, pa.list_(pa.int64())), pa.nulls(len(ids), pa.int32()), none, none], ["id", "nodes", "part", "first", "last"]
    )


def node_pairs(named: DataFrame) -> DataFrame:
    """(p, s, id, skips, first): the cuts of every word as pairs of a node and a backward node.

    skips: the pair leaves out the code point behind the cut; first: that one differs from the
    code point before the cut, so that a run of equal ones is shortened in one way only.
    """
    ahead = nodes(named).withColumnRenamed("nodes", "f")
    back = nodes(named.select("id", F.reverse("word").alias("word"))).withColumnRenamed("nodes", "b")
    both = named.join(ahead, "id").join(back, "id").select("id", "f", "b", F.split("word", "").alias("w"), F.length("word").alias("n"))

    def cuts(skipped: int, made: str):
        low, high = f"greatest(0, n - {skipped} - size(b) + 1)", f"least(n - {skipped}, size(f) - 1)"
        return F.expr(f"if({low} <= {high}, transform(sequence({low}, greatest({low}, {high})), i -> {made}), array())")

    kind = "struct<p:bigint,s:bigint,skips:boolean,first:boolean>"
    plain = cuts(0, "named_struct('p', f[i], 's', b[n - i], 'skips', false, 'first', false)").cast(f"array<{kind}>")
    skipping = cuts(1, "named_struct('p', f[i], 's', b[n - 1 - i], 'skips', true, 'first', i = 0 or w[i] != w[greatest(i - 1, 0)])").cast(f"array<{kind}>")
    return both.select("id", F.explode(F.concat(plain, skipping)).alias("cut")).select("cut.*", "id")


def neighbours(named: DataFrame) -> DataFrame:
    """(id, n_near, least): how many words are one edit away, and the smallest id among them."""
    pair = Window.partitionBy("p", "s")
    line = pair.orderBy(F.desc("skips"), "id")
    skipping, first = F.col("skips"), F.col("skips") & F.col("first")
    plain = F.max(F.when(~skipping, F.col("id"))).over(pair)
    met = node_pairs(named).select(
        "id", "skips", "first",
        F.sum(skipping.cast("long")).over(pair).alias("replaced"),
        F.min(F.when(skipping, F.col("id"))).over(pair).alias("least_skip"),
        F.when(F.lead("skips").over(line), F.lead("id").over(line)).alias("next_skip"),
        F.sum(first.cast("long")).over(pair).alias("longer"),
        F.min(F.when(first, F.col("id"))).over(pair).alias("least_longer"),
        plain.alias("plain"),
    )
    shorter = F.when(F.col("first"), F.col("plain"))
    other = F.when(F.col("id") == F.col("least_skip"), F.col("next_skip")).otherwise(F.col("least_skip"))
    count = F.when(skipping, F.col("replaced") - 1 + F.when(shorter.isNotNull(), 1).otherwise(0)).otherwise(F.col("longer"))
    least = F.when(skipping, F.least(other, shorter)).otherwise(F.col("least_longer"))
    return met.select("id", count.alias("n_near"), least.alias("least")).where("n_near > 0").groupBy("id").agg(F.sum("n_near").alias("n_near"), F.min("least").alias("least"))


def variants(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES, slip: int = SLIP
) -> DataFrame:
    """word, form, root, n, n_near, form_n: every word with the more frequent one it is a variant of.

    n_near counts the words one inserted, deleted or replaced code point away. form is the
    most frequent of them (ties: the smallest in code-point order) if it occurs at least
    `times` as often, else null; root follows forms to the last and is the group's name.

    Null and empty texts have no words. Rows that repeat count as often as they stand there,
    also without an id. An empty table gives no rows; other columns are left behind. Words of
    any length take part; the work on a word is in proportion to its length.
    """
    kept = words(df, id_col, text_col, slip).where(F.col("n") >= least)
    # Numbers in order of falling count, then code points: the best of some words is the smallest number.
    named = settle(kept.orderBy(F.desc("n"), "word").withColumn("id", F.monotonically_increasing_id()), "spellings")
    found = named.join(neighbours(named), "id", "left")
    best = named.select(F.col("id").alias("least"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    found = found.join(best, "least", "left").withColumn("holds", F.coalesce(F.col("form_n") >= F.col("n") * times, F.lit(False)))
    found = settle(
        found.select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("holds"), F.col("least")).alias("to"),
            F.when(F.col("holds"), F.col("form")).alias("form"), F.when(F.col("holds"), F.col("form_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    # Each round doubles the steps that a pointer has gone.
    now = found.where("to is not null").select("id", "to")
    while True:
        ahead = now.select(F.col("id").alias("to"), F.col("to").alias("further"))
        now = settle(now.join(ahead, "to", "left").select("id", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if now.where("moved").isEmpty():
            break
        now = now.select("id", "to")
    roots = now.join(named.select(F.col("id").alias("to"), F.col("word").alias("root")), "to").select("id", "root")
    return found.join(roots, "id", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
