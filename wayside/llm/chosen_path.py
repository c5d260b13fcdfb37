"""Near-duplicate documents by a chosen-path set similarity join.

Documents are sets of word shingles. Documents with the same set are one class. Over the
classes several independent trees are grown: a node chooses a few of the places of its
documents' min-wise signatures, by a hash of its path, and sends each document to one child
for every chosen place, by the document's value there. Similar sets share a path in some
tree. Small nodes compare all their documents; in large ones every document is compared
with a few of the node's documents, and those that are not close to one of them go on. Nodes
that are still large at the last level are compared by every pair of their blocks.

Comparisons of signatures only gather documents that might be linked. Links are confirmed on
the full sets: a gathered group is compared exhaustively, through the shingles that two
of its documents share, a large one by every pair of its blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from wayside.llm.batches import Words, by_batch, mix, passes, signed, texts
from wayside.llm.components import components
from wayside.llm.filters import bitmap, passing, without
from wayside.storage import settle

#: Min-wise values of a signature, trees, and levels below the root.
PLACES, TREES, DEPTH = 128, 10, 3
#: Documents of a node that are all compared, and documents of a larger one that each meets.
NODE, PIVOTS = 256, 4
#: Estimated similarity, below the wanted one, from which documents are gathered: as pairs, and around a node's own.
PAIR_MARGIN, PIVOT_MARGIN = 0.13, 0.25
#: Documents and shingles that one task confirms; larger groups are dealt into blocks of half as many.
GROUP, GROUP_SHINGLES = 4000, 4_000_000

#: signature: the places' values; short: a byte of each, enough to gather by.
_SKETCH = "doc_id long, n_shingles long, k1 long, k2 long, signature binary"
_REPS = "k1 long, k2 long, rep long, n_shingles long, signature binary, short binary"
_SALTS = np.random.default_rng(5).integers(1, 2**63, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_KEY = np.uint64(0x2545F4914F6CDD1D)
_STEPS = np.arange(1, PLACES + 1, dtype=np.uint64) * _KEY


def shingle_sets(column, size: int):
    """For runs of texts: (first row, distinct shingle hashes in order, where each text's begin)."""
    for row, data, offsets in passes(column):
        words = Words(data, offsets)
        hashes, at = words.runs(size)
        of = words.of[at]
        count = np.diff(words.first)
        short = np.flatnonzero((count > 0) & (count < size))
        if len(short):
            hashes = np.append(hashes, np.array([words.whole(i) for i in short], np.uint64))
            of = np.append(of, short)
        order = np.lexsort((hashes, of))
        hashes, of = hashes[order], of[order]
        if len(of):
            keep = np.append(True, (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1]))
            hashes, of = hashes[keep], of[keep]
        yield row, hashes, np.searchsorted(of, np.arange(len(offsets)))


def _sketch(size: int):
    def work(batches):
        for batch in batches:
            n_all, k1, k2, signatures = [], [], [], []
            for _, hashes, cut in shingle_sets(batch.column(1), size):
                n = np.diff(cut)
                some = np.flatnonzero(n)
                begin = cut[:-1][some]
                sums = np.zeros((2, len(n)), np.uint64)
                table = np.empty((len(some), PLACES), np.uint32)
                if len(some):
                    sums[0, some] = np.add.reduceat(mix(hashes), begin)
                    sums[1, some] = np.add.reduceat(mix(hashes ^ _KEY), begin)
                    for i, salt in enumerate(_SALTS):
                        table[:, i] = np.minimum.reduceat(((hashes * salt) >> np.uint64(32)).astype(np.uint32), begin)
                rows = iter(table)
                n_all += n.tolist()
                k1 += signed(sums[0]).tolist()
                k2 += signed(sums[1]).tolist()
                signatures += [next(rows).tobytes() if x else None for x in n]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(n_all, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                    pa.array(signatures, pa.binary()),
                ],
                ["doc_id", "n_shingles", "k1", "k2", "signature"],
            )

    return work


def _shorten(batches):
    """Adds a byte of each value: the chance of equal bytes only makes documents look more alike."""
    for batch in batches:
        short = [row.tobytes() for row in _table(batch.column("signature")).astype(np.uint8)]
        yield batch.append_column("short", pa.array(short, pa.binary()))


def _table(column, kind=np.uint32) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, PLACES)


def _children(path: np.ndarray, table: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """(index of the row, path of the child) for every place the rows' nodes choose."""
    rows, paths = [], []
    for i in range(PLACES):
        drawn = mix(path + _STEPS[i])
        chosen = np.flatnonzero((drawn >> np.uint64(11)).astype(np.float64) < share * 2.0**53)
        rows.append(chosen)
        paths.append(mix(drawn[chosen] ^ (table[chosen, i].astype(np.uint64) * _SALTS[i])))
    return np.concatenate(rows), np.concatenate(paths)


def _pairs(rows, paths) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(signed(paths)), pa.array(rows)], ["path", "rep"])


def _roots(share: float):
    def work(batches):
        for batch in batches:
            reps, table = batch.column(0).to_numpy(), _table(batch.column(1))
            for tree in range(TREES):
                # A root chooses one place for certain and others as any node does.
                start = mix(np.full(len(reps), tree + 1, np.uint64) * _SALTS[0])
                sure = int(_SALTS[tree % PLACES] % np.uint64(PLACES))
                yield _pairs(reps, mix(start ^ (table[:, sure].astype(np.uint64) * _SALTS[sure])))
                at, paths = _children(start, table, share / 4)
                yield _pairs(reps[at], paths)

    return work


def _forest(ids: np.ndarray, near: np.ndarray) -> list[tuple[int, int]]:
    """Links that hold the components of a symmetric matrix of booleans together: each id to the smallest."""
    free, out = np.ones(len(ids), bool), []
    for i in np.argsort(ids, kind="stable"):
        if not free[i]:
            continue
        free[i] = False
        front = np.array([i])
        while len(front):
            reached = np.flatnonzero(near[front].any(0) & free)
            free[reached] = False
            out += [(int(ids[j]), int(ids[i])) for j in reached]
            front = reached
    return out


def _links(links) -> pa.RecordBatch:
    a, b = zip(*links) if links else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _small_nodes(least: float):
    """Compare all documents of each node; the rows of a node stand together."""

    def compare(reps, table):
        near = np.zeros((len(reps),) * 2, bool)
        for i in range(len(reps)):
            near[i] = (table == table[i]).mean(1) >= least
        return _forest(reps, near)

    def work(batches):
        held = None
        for batch in batches:
            path, reps, table = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _table(batch.column(2), np.uint8)
            if held is not None:
                path, reps, table = (np.concatenate(x) for x in zip(held, (path, reps, table)))
            cut = np.append(np.flatnonzero(np.append(True, path[1:] != path[:-1])), len(path)) if len(path) else np.array([0])
            links = []
            for a, b in zip(cut[:-2], cut[1:-1]):
                links += compare(reps[a:b], table[a:b])
            held = (path[cut[-2] :], reps[cut[-2] :], table[cut[-2] :]) if len(path) else None
            yield _links(links)
        if held is not None:
            yield _links(compare(held[1], held[2]))

    return work


def _large_nodes(least: float, close: float, share: float, last: bool):
    """Links to the node's chosen documents (kind 0); those close to none of them go on to children, or stay in a last node (kind 1)."""

    def work(batches):
        for batch in batches:
            path = batch.column("path").to_numpy().view(np.uint64)
            reps, table = batch.column("rep").to_numpy(), _table(batch.column("signature"))
            best, hung, between = np.zeros(len(reps)), np.full(len(reps), -1), []
            others = np.stack([batch.column(f"rep{i}").to_numpy() for i in range(PIVOTS)])
            for i in range(PIVOTS):
                alike = np.where(others[i] == reps, 0, (table == _table(batch.column(f"signature{i}"))).mean(1))
                best = np.maximum(best, alike)
                # To all it is near, as what is alike may hang on any of them: those after the first hang on the first.
                more = np.flatnonzero((alike >= least) & (hung >= 0) & (others[i] != others[hung, np.arange(len(reps))]))
                between.append(np.stack([others[i, more], others[hung[more], more]]))
                hung[(hung < 0) & (alike >= least)] = i
            near = np.flatnonzero(hung >= 0)
            out = [(np.zeros(len(near), np.int32), reps[near], others[hung[near], near])]
            chosen = np.unique(np.concatenate(between, axis=1), axis=1)
            out.append((np.zeros(chosen.shape[1], np.int32), *chosen))
            on = np.flatnonzero(best < close)
            at, paths = (np.arange(len(on)), path[on]) if last else _children(path[on], table[on], share)
            out.append((np.ones(len(at), np.int32), reps[on][at], signed(paths)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["kind", "a", "b"])

    return work


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Documents of the last nodes (path, rep) dealt into blocks: every two blocks of a node are a path, so that any two meet."""
    sizes = rows.groupBy("path").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") * 2 / NODE).cast("int")
    dealt = rows.join(sizes, "path").withColumn("blocks", F.when(F.col("size") > NODE, blocks).otherwise(1))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("rep", F.lit("block")), "blocks").cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("other != block or blocks = 1")
    return met.select(F.xxhash64("path", F.least("block", "other"), F.greatest("block", "other")).alias("path"), "rep")


def _gather(reps: DataFrame, similarity: float) -> DataFrame:
    """Candidate links (a, b) between representatives, from all trees."""
    share = 1 / (similarity * PLACES)
    rows = by_batch(reps.select("rep", "signature"), _roots(share), "path long, rep long")
    found = []
    for level in range(DEPTH + 1):
        sizes = rows.groupBy("path").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        nodes = settle(rows.join(sizes, "path").select("path", "rep", "size"), "nodes")
        small = nodes.where(F.col("size") <= NODE).join(reps, "rep").select("path", "rep", "short")
        compare = _small_nodes(similarity - PAIR_MARGIN)
        found.append(by_batch(small.repartition("path").sortWithinPartitions("path"), compare, "a long, b long"))
        if nodes.where(F.col("size") > NODE).isEmpty():
            break
        large = settle(nodes.where(F.col("size") > NODE).join(reps, "rep").select("path", "rep", "signature"), "large")
        # Mostly the same few of a group of alike documents in every tree, so that its links are few.
        pivots = large.groupBy("path").agg(
            *[F.min_by(F.struct("rep", "signature"), F.xxhash64("rep", F.lit(i))).alias(f"p{i}") for i in range(PIVOTS)]
        )
        met = large.join(pivots, "path").select(
            "path", "rep", "signature",
            *[c for i in range(PIVOTS) for c in (F.col(f"p{i}.rep").alias(f"rep{i}"), F.col(f"p{i}.signature").alias(f"signature{i}"))],
        )
        work = _large_nodes(similarity - PIVOT_MARGIN, similarity, share, level == DEPTH)
        out = settle(by_batch(met, work, "kind int, a long, b long"), "met")
        found.append(out.where("kind = 0").select("a", "b"))
        rows = out.where("kind = 1").select(F.col("b").alias("path"), F.col("a").alias("rep")).distinct()
        if level == DEPTH:
            last = _in_blocks(rows).join(reps, "rep").select("path", "rep", "short")
            found.append(by_batch(last.repartition("path").sortWithinPartitions("path"), compare, "a long, b long"))
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links


def _confirm(size: int, num: int, den: int):
    """Links of one group on full sets: each document to the smallest of those it is linked with, over any path."""

    def work(key, held):
        ids, sets = held.column("rep").to_numpy(), []
        for _, hashes, cut in shingle_sets(held.column("text"), size):
            sets += [hashes[a:b] for a, b in zip(cut[:-1], cut[1:])]
        order = np.argsort(ids, kind="stable")
        ids, sets = ids[order], [sets[i] for i in order]
        n = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), n)
        keys, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        # Only shingles of two documents or more add to an intersection.
        useful = times[place] > 1
        column = (np.cumsum(times > 1) - 1)[place][useful]
        owner = owner[useful]
        both = np.zeros((len(sets),) * 2, np.float32)
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, 1024):
            a, b = np.searchsorted(column, [at, at + 1024])
            part = np.zeros((len(sets), 1024), np.float32)
            part[owner[a:b], column[a:b] - at] = 1
            both += part @ part.T
        union = n[:, None] + n[None, :] - both
        linked = (both * den >= num * union) | (ids[:, None] == ids[None, :])
        return pa.Table.from_batches([_links(_forest(ids, linked))])

    return work


def _confirmed(rows: DataFrame, reps: DataFrame, gathered: DataFrame, size: int, num: int, den: int) -> tuple[DataFrame, bool]:
    """Confirmed links (a, b) of representatives to the smallest of their task, and whether groups were split."""
    groups = gathered.unionByName(gathered.select(F.col("b").alias("a"), "b").distinct()).select(F.col("a").alias("rep"), F.col("b").alias("g"))
    members = settle(groups.join(reps, "rep").select("rep", "g", "n_shingles"), "members")
    sizes = members.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("shingles"))
    parts = F.ceil(F.greatest(F.col("n") / GROUP, F.col("shingles") / GROUP_SHINGLES)).cast("int")
    sizes = settle(sizes.select("g", parts.alias("parts")), "group-sizes")
    dealt = members.join(sizes, "g")
    keys = dealt.where("parts <= 1").select("rep", F.col("g").alias("task"))
    split = not sizes.where("parts > 1").isEmpty()
    if split:
        keys = keys.unionByName(_block_pairs(dealt.where("parts > 1")))
    # Only a group's documents bring their texts, once for each group they are compared in.
    held = rows.sparkSession.sparkContext.broadcast(bitmap(members, F.xxhash64("rep")))

    def pick(batches):
        for batch in batches:
            yield batch.filter(pa.array(passing(held.value, batch.column("key").to_numpy()))).select(["rep", "text"])

    kept = by_batch(rows.select(F.col("doc_id").alias("rep"), "text", F.xxhash64("doc_id").alias("key")), pick, "rep long, text string")
    picked = kept.join(keys, "rep")
    return settle(picked.groupBy("task").applyInArrow(_confirm(size, num, den), "a long, b long"), "confirmed"), split


def _block_pairs(large: DataFrame) -> DataFrame:
    """Tasks of groups that are too large for one: each compares all documents of two blocks, so that any two meet.

    Tasks grow with the square of a group's blocks, each as large as a small group's.
    """
    blocks = F.col("parts") * 2
    dealt = large.withColumn("block", F.pmod(F.xxhash64("rep", F.lit("block")), blocks).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).where("other != block")
    return met.select("rep", F.xxhash64("g", F.least("block", "other"), F.greatest("block", "other")).alias("task"))


def near_duplicates(
    df: DataFrame, shingle: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id linked with it over any path), kept.

    Two documents are linked if den * |A and B| >= num * |A or B| for their sets of
    `shingle`-word shingles; fewer words are one shingle as a whole. Words are cut at ASCII
    white space, A-Z lowered.

    A null or empty text, or one without words, has no shingles and is linked with nothing.
    Rows that repeat an id are one document in the links, with the links of all its
    texts; each gives a row. A row without an id is linked with nothing, has no component
    and is kept. An empty table gives no rows. Other columns are left behind.

    Confirmed links are exact. Trees find a pair at the threshold with a probability of
    over 0.999, and any gathered group is compared exhaustively, whatever its size.
    """
    rows = texts(df, id_col, text_col)
    sketch = settle(by_batch(rows, _sketch(shingle), _SKETCH), "sketch")
    usable = sketch.where("doc_id is not null and n_shingles > 0")
    # Equal sets have equal signatures, so that any row's will do.
    each = usable.groupBy("k1", "k2").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")
    )
    reps = settle(by_batch(each, _shorten, _REPS), "reps")
    gathered = components(_gather(reps, num / den))
    links, split = _confirmed(rows, reps, gathered, shingle, num, den)
    same = usable.select("doc_id", "k1", "k2").distinct().join(reps.select("k1", "k2", "rep"), ["k1", "k2"])
    if split or not same.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        # Groups confirmed in parts, or an id with several texts, can join what is found so far.
        found = components(links.unionByName(same.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))))
        found = found.select(F.col("a").alias("doc_id"), F.col("b").alias("smallest"))
    else:
        # A document goes to its class's representative, and that to the smallest one linked with it.
        roots = links.select(F.col("a").alias("rep"), F.col("b").alias("root"))
        found = same.join(roots, "rep", "left").select("doc_id", F.coalesce("root", "rep").alias("smallest"))
    out = sketch.select("doc_id", "n_shingles").join(found, "doc_id", "left")
    component = F.coalesce("smallest", "doc_id")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def without_near_duplicates(df: DataFrame, shingle: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of df, all columns kept, with one document of each group of near-duplicates.

    The document with the smallest id stays; of rows that repeat an id, the one with the
    smallest text. Rows without an id stay.
    """
    found = settle(near_duplicates(df, shingle, num, den).select("doc_id", "kept"), "kept")
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    stay = without(df, gone)
    again = found.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    if again.isEmpty():
        return stay
    order = Window.partitionBy("doc_id").orderBy("text", F.xxhash64(*df.columns))
    one = stay.join(again, "doc_id", "left_semi").withColumn("__row", F.row_number().over(order)).where("__row = 1")
    return stay.join(again, "doc_id", "left_anti").select(df.columns).unionByName(one.select(df.columns))
