"""Phrases whose words belong together, from count streams in prefix and in suffix order.

Counting: words, then pairs of frequent words, then triples of frequent pairs. A phrase is
never more frequent than its parts, so nothing is lost by leaving out phrases with a rare
part. Two bitmaps of fixed size say which parts are frequent; they let too much through at
worst, and exact counts by the words themselves decide.

Estimation: the frequent phrases of all lengths lie in one stream, sorted by their first
word, second, third. Each phrase then stands behind its own beginnings, so one pass fills
in the counts of the beginnings and the largest count of an extension to the right. Sorted
by the last word, the one before, and so on, the same pass gives the counts of the endings
and extensions to the left. Nothing is looked up or hashed by phrase. Streams are dealt out
by ranges, so a first word with a third of all phrases takes several tasks; what a range
must know of the ones beside it is a few numbers, which a list as long as the number of
ranges passes on.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wayside.llm.batches import by_batch
from wayside.storage import settle

#: Least count of a phrase, share of it (in percent) that hides it in a longer one, rows for each language.
LEAST, HIDDEN, TOP = 10, 50, 2000
#: Bits of each bitmap of frequent parts: 16 MB, whatever the corpus.
BITS = 1 << 27

_BREAK = b"\xff"
_SPLIT = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", _BREAK * 10 + b" ")
#: Bytes of text split at once, words of a task counted together, different words among them.
_BYTES, _TOKENS, _WORDS = 1 << 20, 1 << 22, 1 << 20


def _keys(lang: str, words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    seed = xxh64_intdigest(lang.encode())
    return np.fromiter((xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return first ^ (second << np.uint64(1))


def _in(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bit = (keys & np.uint64(BITS - 1)).astype(np.int64)
    return (bitmap[bit >> 6] >> (bit & 63)) & 1 == 1


def _bitmap(kept: DataFrame, order: int) -> np.ndarray:
    """Bits of the kept phrases; at most BITS / 64 rows come to the driver."""

    def bits(batches):
        for batch in batches:
            langs = batch.column(0).to_pylist()
            words = [batch.column(i + 1).cast(pa.binary()).to_pylist() for i in range(order)]
            keys = np.empty(len(langs), np.uint64)
            for lang in set(langs):
                rows = [i for i, x in enumerate(langs) if x == lang]
                parts = [_keys(lang, [w[i] for i in rows]) for w in words]
                keys[rows] = parts[0] if order == 1 else _pair_key(*parts)
            bit = (keys & np.uint64(BITS - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bit >> 6, pa.int32()), pa.array(np.int64(1) << (bit & 63))], ["word", "bits"])

    found = by_batch(kept.select("lang", *_names(order)), bits, "word int, bits long")
    rows = found.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(BITS // 64, np.int64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return out


def _names(order: int) -> list[str]:
    return [f"w{i + 1}" for i in range(order)]


class _Stream:
    """The words of one language in a task, as numbers in order of first sight; 0 stands between pieces."""

    def __init__(self, lang: str, order: int, bitmap):
        self.lang, self.order, self.bitmap = lang, order, bitmap
        self._begin([_BREAK])

    def _begin(self, words: list[bytes]) -> None:
        self.number = defaultdict()
        self.number.default_factory = self.number.__len__
        self.number[_BREAK]
        self.held, self.size = [], 0
        self._take(words)

    def _take(self, words: list[bytes]) -> None:
        self.held.append(np.fromiter(map(self.number.__getitem__, words), np.int64, len(words)))
        self.size += len(words)

    def add(self, text: bytes) -> Iterator[pa.RecordBatch]:
        data = text.lower().translate(_SPLIT).replace(_BREAK, b" \xff ")
        at = 0
        while at < len(data):
            to = data.find(b" ", at + _BYTES)
            to = len(data) if to < 0 else to
            self._take(data[at:to].split())
            at = to
            if self.size >= _TOKENS or len(self.number) >= _WORDS:
                yield from self.counts()
        self._take([_BREAK])

    def counts(self) -> Iterator[pa.RecordBatch]:
        """Counts of what is held; the last words stay, so that no phrase is torn and none counted twice."""
        ids, words = np.concatenate(self.held), list(self.number)
        self.held = []
        n = len(ids) - self.order + 1
        at = [ids[i : n + i] for i in range(self.order)] if n > 0 else [ids[:0]] * self.order
        good = np.ones(len(at[0]), bool)
        for part in at:
            good &= part > 0
        if self.order > 1:
            keys = _keys(self.lang, words)
        if self.order == 2:
            frequent = _in(self.bitmap, keys)
            good &= frequent[at[0]] & frequent[at[1]]
        elif self.order == 3:
            good[good] = _in(self.bitmap, _pair_key(keys[at[0][good]], keys[at[1][good]]))
            good[good] = _in(self.bitmap, _pair_key(keys[at[1][good]], keys[at[2][good]]))
        packed = np.zeros(int(good.sum()), np.int64)
        for part in at:
            packed = packed * (2 * _WORDS) + part[good]
        phrases, n = np.unique(packed, return_counts=True)
        texts = pa.array(words[1:], pa.binary()).cast(pa.string()) if len(words) > 1 else pa.array([], pa.string())
        for a in range(0, len(phrases), 1 << 16):
            left, columns = phrases[a : a + (1 << 16)], []
            for _ in range(self.order):
                left, word = np.divmod(left, 2 * _WORDS)
                columns.insert(0, texts.take(pa.array(word - 1)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([self.lang] * len(columns[0]), pa.string()), *columns, pa.array(n[a : a + (1 << 16)])], ["lang", *_names(self.order), "n"]
            )
        keep = ids[len(ids) - self.order + 1 :] if self.order > 1 else ids[:0]
        self._begin([words[i] for i in keep])


def _counted(rows: DataFrame, order: int, bitmap: np.ndarray | None = None) -> DataFrame:
    """(lang, w1 ..., n): exact counts of the phrases of one length whose parts may be frequent."""
    held = None if bitmap is None else rows.sparkSession.sparkContext.broadcast(bitmap)

    def work(batches):
        streams: dict[str, _Stream] = {}
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            for i, lang in enumerate(batch.column(0).to_pylist()):
                if lang not in streams:
                    streams[lang] = _Stream(lang, order, held and held.value)
                yield from streams[lang].add(texts[i].as_py())
        for stream in streams.values():
            yield from stream.counts()

    names = _names(order)
    parts = by_batch(rows, work, f"lang string, {', '.join(f'{n} string' for n in names)}, n long")
    # A task gives a phrase once for each time it counts, so there is nothing to add up before the shuffle.
    return parts.repartition("lang", *names).groupBy("lang", *names).agg(F.sum("n").alias("n"))


def _filled(rows: DataFrame, backwards: bool, one: str, two: str, longer: str) -> DataFrame:
    """Rows with three more columns, from one pass in prefix (or, backwards, suffix) order.

    one and two: counts of the first (last) word and of the first (last) two words. longer, of
    a pair: the largest count of a triple that goes on from it (0 without any). Needs every
    beginning (ending) of a phrase to be there, which frequent phrases' are.
    """
    first = F.when(F.col("order") == 1, F.col("w1")).when(F.col("order") == 2, F.col("w2")).otherwise(F.col("w3"))
    second = F.when(F.col("order") == 2, F.col("w1")).when(F.col("order") == 3, F.col("w2"))
    keys = [first, second, F.when(F.col("order") == 3, F.col("w1"))] if backwards else [F.col(n) for n in _names(3)]
    dealt = rows.select("*", *[k.alias(f"_k{i}") for i, k in enumerate(keys)])
    key = ["lang", "_k0", "_k1", "_k2"]
    dealt = dealt.repartitionByRange(*key).sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in key]).drop(*key[1:])
    schema = StructType([*dealt.schema.fields]).add("_one", "long").add("_two", "long").add("_longer", "long").add("_open", "boolean").add("_part", "integer")
    order_at, n_at = dealt.columns.index("order"), dealt.columns.index("n")

    def ahead(values: np.ndarray, here: np.ndarray, before):
        """The value last seen at a place marked in `here`; `before` (None: unknown) until there is one."""
        last = np.maximum.accumulate(np.where(here, np.arange(len(here)), -1))
        known = (last >= 0) | (before is not None)
        return np.where(last >= 0, values[last], 0 if before is None else before), known

    def work(batches):
        part = TaskContext.get().partitionId()
        last_one = last_two = pending = None  # pending: the pair whose triples may go on, a table of one row
        longer, lead, headed, sample = 0, 0, False, None
        for batch in batches:
            if not batch.num_rows:
                continue
            sample = batch
            order, n = batch.column(order_at).to_numpy(), batch.column(n_at).to_numpy()
            ones, one_known = ahead(n, order == 1, last_one)
            twos, two_known = ahead(n, order == 2, last_two)
            heads = np.flatnonzero(order < 3)
            rest = int(n[: heads[0] if len(heads) else len(n)].max(initial=0))
            if headed:
                longer = max(longer, rest)
            else:
                lead = max(lead, rest)
            best = np.zeros(len(n), np.int64)
            if len(heads):
                best[heads] = np.maximum.reduceat(np.where(order == 3, n, 0), heads)
            out = pa.Table.from_batches([batch])
            for name, values, known in (("_one", ones, one_known), ("_two", twos, two_known), ("_longer", best, np.ones(len(n), bool))):
                out = out.append_column(name, pa.array(values, pa.int64(), mask=~known if np.ndim(known) else None))
            out = out.append_column("_open", pa.array(np.zeros(len(n), bool))).append_column("_part", pa.array(np.full(len(n), part, np.int32)))
            if len(heads):
                if pending is not None:
                    yield from _with_longer(pending, longer, False).to_batches()
                headed, pending, longer = True, out.slice(heads[-1], 1), int(best[heads[-1]])
                keep = np.ones(len(n), bool)
                keep[heads[-1]] = False
                out = out.filter(pa.array(keep))
            if (order == 1).any():
                last_one = int(n[order == 1][-1])
            if (order == 2).any():
                last_two = int(n[order == 2][-1])
            yield from out.to_batches()
        if pending is not None:
            yield from _with_longer(pending, longer, True).to_batches()
        if sample is not None:
            # What the ranges beside this one must know, in a row of order 0.
            told = {"order": 0, "_one": last_one, "_two": last_two, "_longer": lead, "_open": headed, "_part": part}
            yield pa.RecordBatch.from_pylist([{f.name: told.get(f.name) for f in arrow}], arrow)

    arrow = to_arrow_schema(schema)
    passed = settle(by_batch(dealt, work, schema), "phrase-stream")
    told = sorted(passed.where("order = 0").select("_part", "_one", "_two", "_longer", "_open").collect(), key=lambda r: r["_part"])
    fixes, seen_one, seen_two = [], None, None
    for r in told:
        fixes.append([r["_part"], seen_one, seen_two, 0])
        seen_one, seen_two = (seen_one if r["_one"] is None else r["_one"]), (seen_two if r["_two"] is None else r["_two"])
    going_on = 0
    for fix, r in zip(reversed(fixes), reversed(told), strict=True):
        fix[3] = going_on
        going_on = r["_longer"] if r["_open"] else max(r["_longer"], going_on)
    fixed = rows.sparkSession.createDataFrame(fixes, "_part int, _before_one long, _before_two long, _after long")
    out = passed.where("order > 0").join(F.broadcast(fixed), "_part")
    order = F.col("order")
    return out.select(
        *rows.columns,
        F.when(order > 1, F.coalesce("_one", "_before_one")).alias(one),
        F.when(order > 2, F.coalesce("_two", "_before_two")).alias(two),
        F.when(order == 2, F.when(F.col("_open"), F.greatest("_longer", "_after")).otherwise(F.col("_longer"))).alias(longer),
    )


def _with_longer(row: pa.Table, longer: int, is_open: bool) -> pa.Table:
    row = row.set_column(row.column_names.index("_longer"), "_longer", pa.array([longer], pa.int64()))
    return row.set_column(row.column_names.index("_open"), "_open", pa.array([is_open]))


def _score(left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)), exact: decimals of 38 digits."""
    whole = [c.cast("decimal(19,0)") for c in (F.col("n"), left, right)]
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * whole[0] * whole[0], whole[1] * whole[2])


def phrases(df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Counts of all frequent phrases with those of their parts, and the number of words of each language.

    First frame: lang, w1, w2, w3 (null where shorter), order, n; l1, l2 the counts of the
    first one and two words, r1, r2 of the last one and two, right and left the largest
    count of a triple that goes on from a pair to the right and to the left.
    """
    rows = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    frequent = F.col("n") >= least
    words = settle(_counted(rows, 1), "phrase-words")
    kept = [words.where(frequent)]
    kept.append(settle(_counted(rows, 2, _bitmap(kept[0], 1)).where(frequent), "phrase-pairs"))
    kept.append(settle(_counted(rows, 3, _bitmap(kept[1], 2)).where(frequent), "phrase-triples"))
    stream = None
    for order, part in enumerate(kept, 1):
        part = part.select("lang", *[F.col(c) if c in part.columns else F.lit(None).cast("string").alias(c) for c in _names(3)], F.lit(order).alias("order"), "n")
        stream = part if stream is None else stream.unionByName(part)
    stream = settle(stream, "phrase-counts")
    filled = _filled(_filled(stream, False, "l1", "l2", "right"), True, "r1", "r2", "left")
    return filled, words.groupBy("lang").agg(F.sum("n").alias("words"))


def collocations(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, hidden: int = HIDDEN, top: int = TOP
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of two or three words.

    Texts are lower-cased (A-Z), cut at .,;:!? and line ends, and split at spaces and tabs.
    a is the phrase's count, l and r those of its two parts at its weakest cut, n the
    language's number of words, score floor(1000000 a a / (l r)). A pair is left out if a
    frequent triple around it has at least `hidden` percent of its count.

    A null language is `und`; null and empty texts have no words. Rows that repeat count as
    often as they stand there. An empty table gives no rows; other columns are left behind.
    Equal scores are ordered by count, then by the phrase in byte order, and equally weak
    cuts by the first. A text of any length is split in steps, and no phrase is lost between them.
    """
    filled, totals = phrases(df, text_col, lang_col, least)
    three = F.col("order") == 3
    # A triple's cuts: first word and last two, first two and last word.
    scored = filled.where("order > 1").select(
        "lang", "w1", "w2", "w3", "n", "l1", "l2", F.col("r1").alias("last"), F.col("r2").alias("last_two"), "order",
        _score(F.col("l1"), F.when(three, F.col("r2")).otherwise(F.col("r1"))).alias("s1"),
        F.when(three, _score(F.col("l2"), F.col("r1"))).alias("s2"),
        F.coalesce(F.greatest("right", "left"), F.lit(0)).alias("longer"),
    ).where(three | (F.col("longer") == 0) | (F.col("longer") * 100 < F.col("n") * hidden))
    later = three & (F.col("s2") < F.col("s1"))
    scored = scored.select(
        "lang",
        F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
        F.col("n").alias("a"),
        F.when(later, F.col("l2")).otherwise(F.col("l1")).alias("l"),
        F.when(three & ~later, F.col("last_two")).otherwise(F.col("last")).alias("r"),
        F.when(later, F.col("s2")).otherwise(F.col("s1")).alias("score"),
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("words").alias("n"), "score")


def collocations_sql() -> str:
    """The same in SQL over the table documents."""
    return rf"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ), spoken AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM spoken),
    f AS (
        SELECT lang, k, phrase, count(*) AS n FROM (
            SELECT lang, 1 AS k, w[i] AS phrase FROM places
            UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM places WHERE i + 1 <= len(w)
            UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM places WHERE i + 2 <= len(w)
        ) GROUP BY ALL
    ),
    candidates AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS p, n AS a FROM f WHERE k > 1 AND n >= {LEAST}),
    cuts AS (
        SELECT c.*, cut, array_to_string(p[:cut], ' ') AS head, array_to_string(p[cut + 1:], ' ') AS tail
        FROM candidates c, (VALUES (1), (2)) AS ends(cut) WHERE cut < k
    ),
    scored AS (
        SELECT c.lang, c.k, c.phrase, c.p, c.a, x.n AS l, y.n AS r, c.cut, ((1000000::HUGEINT * a * a) // (x.n::HUGEINT * y.n))::BIGINT AS score
        FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head AND x.k = c.cut
        JOIN f y ON y.lang = c.lang AND y.phrase = c.tail AND y.k = c.k - c.cut
    ),
    weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    longer AS (
        SELECT lang, part, max(a) AS n FROM (
            SELECT lang, a, p[1] || ' ' || p[2] AS part FROM candidates WHERE k = 3
            UNION ALL SELECT lang, a, p[2] || ' ' || p[3] FROM candidates WHERE k = 3
        ) GROUP BY ALL
    ),
    kept AS (
        SELECT w.* FROM weakest w LEFT JOIN longer g ON w.k = 2 AND g.lang = w.lang AND g.part = w.phrase
        WHERE g.n IS NULL OR 100 * g.n < {HIDDEN} * w.a
    ),
    totals AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, totals.n, score
    FROM kept JOIN totals USING (lang) QUALIFY rank <= {TOP}
    """
