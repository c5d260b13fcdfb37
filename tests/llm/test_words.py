"""Spelling variants and collocations against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from wayside.llm import collocations, queries, spellings

RANGES = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "9"}


@pytest.fixture
def ranges(spark):
    """Many ranges, most of them of a few rows, so that sorted streams are torn everywhere."""
    before = {k: spark.conf.get(k) for k in RANGES}
    for k, v in RANGES.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


# --- spelling variants


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def counted(rows, slip):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return out


def variants(rows, slip=97):
    words = {w: n for w, n in counted(rows, slip).items() if n >= 3 and len(w) >= 5}
    form, close = {}, {}
    for w in words:
        close[w] = [x for x in words if near(w, x)]
        best = min(close[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(close[w]), words.get(form[w])) for w, n in words.items())


def found(frame):
    return sorted(tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect())


def misspelt(seed, n=220):
    draw = random.Random(seed)
    stems = ["".join(draw.choice("abé") for _ in range(draw.randint(5, 8))) for _ in range(12)]
    words = list(stems)
    for _ in range(90):
        w = draw.choice(words)
        i = draw.randrange(len(w))
        words.append(draw.choice([w[:i] + w[i + 1 :], w[:i] + draw.choice("abéZ") + w[i:], w[:i] + draw.choice("abéz") + w[i + 1 :]]))
    weights = [draw.choice([1, 2, 4, 9]) for _ in words]
    return [(i, " ".join(draw.choices(words, weights, k=12)) + ".") for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_match_brute_force(docs, seed):
    rows = misspelt(seed)
    assert found(spellings.variants(docs(*rows), slip=5)) == variants(rows, 5)


def test_variants_over_torn_ranges(docs, ranges):
    """Neighbouring words of different ranges share nodes; runs of equal letters are shortened in one way."""
    rows = [*misspelt(3), *[(900 + i, "aaaaa aaaaaa aaaaaaa aaabaaa aaabaa aabaaa") for i in range(4)]]
    assert found(spellings.variants(docs(*rows))) == variants(rows)


def test_forms_lead_to_one_root(docs):
    ladder = {"stonewall": 40, "stonewal": 16, "stonewa": 7, "stonew": 3}
    rows = [(None, " ".join([w] * n)) for w, n in ladder.items()]
    got = {w: (form, root, near) for w, form, root, _, near, _ in found(spellings.variants(docs(*rows), slip=2**32 - 1))}
    assert got == {"stonewall": (None, "stonewall", 1), "stonewal": ("stonewall", "stonewall", 2), "stonewa": ("stonewal", "stonewall", 2), "stonew": ("stonewa", "stonewall", 1)}


def test_ties_take_the_smallest_form(docs):
    rows = [(1, "carts " * 3 + "charts " * 6 + "parts " * 6 + "cartsé " * 6)]
    got = {w: (form, near) for w, form, _, _, near, _ in found(spellings.variants(docs(*rows), slip=2**32 - 1))}
    assert got["carts"] == ("cartsé", 3) and got["parts"] == (None, 1)


def test_very_long_words(docs):
    long = "y" * 30_000 + "z" + "y" * 30_000
    rows = [(i, f"{long} {long[:-1]} {long.replace('z', 'q')} {long.replace('z', '')}") for i in range(3)]
    got = found(spellings.variants(docs(*rows), slip=2**32 - 1))
    assert sorted(r[4] for r in got) == [2, 2, 3, 3]


def test_variants_of_odd_rows(odd, spark):
    again = odd.union(odd).withColumns({"word": F.lit("x"), "id": F.lit(1), "n": F.lit(None), "p": F.lit(0)})
    rows = [(r["doc_id"], r["text"]) for r in again.collect()]
    assert found(spellings.variants(again)) == variants(rows)
    assert spellings.variants(odd.limit(0)).count() == 0
    assert found(spellings.variants(spark.createDataFrame([(1, None)], "doc_id long, text string"))) == []


def test_query_over_given_documents(spark):
    frame = queries.QUERIES["op12_trie_pair_spellings"](spark, "/root/testdata/sf0.001")
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = {r[0]: r for r in found(frame)}
    words = {w: n for w, n in counted(rows, 97).items() if n >= 3 and len(w) >= 5}
    assert {w: r[3] for w, r in got.items()} == words
    for w in random.Random(5).sample(sorted(words), 150):
        close = [x for x in words if abs(len(x) - len(w)) < 2 and near(w, x)]
        best = min(close, key=lambda x: (-words[x], x), default=None)
        form = best if best and words[best] >= 2 * words[w] else None
        assert (got[w][1], got[w][4], got[w][5]) == (form, len(close), words.get(form))


# --- collocations


def phrases(rows, least=10, hidden=50, top=2000):
    f, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, n in f.items():
        candidates = [p for p in n if len(p) > 1 and n[p] >= least]
        kept = []
        for p in candidates:
            if any(len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) and 100 * n[q] >= hidden * n[p] for q in candidates):
                continue
            score, cut = min((1_000_000 * n[p] ** 2 // (n[p[:k]] * n[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -n[p], " ".join(p).encode(), n[p[:cut]], n[p[cut:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def told(frame):
    return sorted(tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def spoken(seed, n=160):
    draw = random.Random(seed)
    words = ["the", "of", "The", "stone", "river", "é", "x", "ab", "a"]
    weights = [30, 9, 4, 3, 3, 2, 2, 1, 1]
    ends = [" ", " ", " ", "  ", "\t", ". ", "\n", ","]
    rows = []
    for _ in range(n):
        rows.append(("".join(w + draw.choice(ends) for w in draw.choices(words, weights, k=30)), draw.choice(["en", "en", "fr", None])))
    return rows


TEXTS = "text string, lang string"


@pytest.mark.parametrize("seed", [1, 2])
def test_collocations_match_brute_force(spark, seed):
    rows = spoken(seed)
    assert told(collocations.collocations(spark.createDataFrame(rows, TEXTS).repartition(3))) == phrases(rows)


def test_collocations_over_torn_ranges(spark, ranges):
    """One first word has most phrases; its counts and longer phrases lie in other ranges."""
    rows = spoken(3, 300) + [("the end of it all goes on", "en")] * 12 + [("of the end", "en")] * 11
    frame = spark.createDataFrame(rows, TEXTS).repartition(4)
    assert told(collocations.collocations(frame, least=3, hidden=40, top=50)) == phrases(rows, 3, 40, 50)


def test_phrases_across_steps(spark, monkeypatch):
    """Words are counted in steps; a phrase over the end of one is counted once."""
    rows = [(" ".join(["alpha beta gamma delta"] * 500), "en"), ("alpha. beta gamma", "en")]
    frame = spark.createDataFrame(rows, TEXTS).coalesce(1)
    for size in (7, 64):
        stream = collocations._Stream("en", 3, None)
        monkeypatch.setattr(collocations, "_BYTES", size)
        monkeypatch.setattr(collocations, "_TOKENS", 5)
        monkeypatch.setattr(collocations, "_in", lambda bitmap, keys: keys == keys)
        counts = Counter()
        for text, _ in rows:
            for batch in stream.add(text.encode()):
                counts.update({tuple(r[w] for w in ("w1", "w2", "w3")): r["n"] for r in batch.to_pylist()})
        for batch in stream.counts():
            counts.update({tuple(r[w] for w in ("w1", "w2", "w3")): r["n"] for r in batch.to_pylist()})
        assert counts[("alpha", "beta", "gamma")] == 500 and counts[("delta", "alpha", "beta")] == 499
        assert ("delta", "alpha", "beta") in counts and ("gamma", "delta", "alpha.") not in counts and ("delta", "alpha", "alpha") not in counts
    assert told(collocations.collocations(frame)) == phrases(rows)


def test_products_pass_64_bits(spark):
    frame = spark.createDataFrame([(3_000_000_000, 6_000_000_001, 9_000_000_007), (10**15, 10**15, 10**15)], "n long, l long, r long")
    got = [r[0] for r in frame.select(collocations._score(F.col("l"), F.col("r"))).collect()]
    assert got == [1_000_000 * 3_000_000_000**2 // (6_000_000_001 * 9_000_000_007), 1_000_000]


def test_collocations_of_odd_rows(odd, spark):
    frame = odd.withColumns({"lang": F.when(F.col("doc_id") == 7, "en"), "n": F.lit(1), "w1": F.lit("a"), "order": F.lit(0), "rank": F.lit(None)})
    rows = [(r["text"], r["lang"]) for r in frame.collect()]
    assert told(collocations.collocations(frame)) == phrases(rows)
    assert collocations.collocations(frame.limit(0)).count() == 0
    assert collocations.collocations(spark.createDataFrame([(None, None)], TEXTS)).count() == 0


def test_phrases_are_added_up_after_the_shuffle_only(spark):
    """A task counts a phrase itself; an aggregate before the shuffle held all its phrases a second time."""
    rows = spark.createDataFrame([("en", "a b c a b"), ("en", "a b"), ("de", "a b")], "lang string, text string")
    found = collocations._counted(rows, 1)
    before_shuffle = found._jdf.queryExecution().executedPlan().toString().split("Exchange", 1)[1]
    assert "Aggregate" not in before_shuffle
    assert {(r["lang"], r["w1"], r["n"]) for r in found.collect()} == {("en", "a", 3), ("en", "b", 3), ("en", "c", 1), ("de", "a", 1), ("de", "b", 1)}
