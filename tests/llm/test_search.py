"""Neighbours, license statements, benchmark leaks and the pipeline."""

from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from wayside.llm import leaks, licences, one_bit, queries, subword

DATA = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "benchmark", "labels"]


def rows_of(frame):
    return sorted(tuple(map(repr, r)) for r in frame.select(*sorted(frame.columns)).collect())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    frame = queries.QUERIES[name](spark, DATA)
    columns = ", ".join(f'"{c}"' for c in sorted(frame.columns))
    wanted = con.execute(f"SELECT {columns} FROM ({queries.ORACLES[name]})").fetchall()
    assert rows_of(frame) == sorted(tuple(map(repr, r)) for r in wanted)


def test_every_operator_is_registered_once():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()


# --- neighbours ------------------------------------------------------------------


def brute(vectors, queries_, k):
    def product(x, y):
        total = 0.0
        for a, b in zip(x, y):
            total += a * b  # sum() would compensate
        return total

    out = []
    for q, x in queries_:
        scored = sorted((-product(x, y), v) for v, y in vectors if v != q)
        out += [(q, i, v, -s) for i, (s, v) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_neighbours_recall_over_several_blocks(spark):
    draw = np.random.default_rng(1)
    rows = [(i, draw.normal(size=70).tolist()) for i in range(600)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = one_bit.nearest(frame, frame.where("vec_id % 20 = 0"), k=5, block=100, per_block=10)
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in found.collect()}
    wanted = brute(rows, rows[::20], 5)
    assert sum((q, v) in got for q, _, v, _ in wanted) / len(wanted) > 0.98
    assert all(got[q, v] == s for q, _, v, s in wanted if (q, v) in got)


def test_error_bounds_hold(spark):
    draw = np.random.default_rng(2)
    m, q = draw.normal(size=(400, 64)), draw.normal(size=(20, 64))
    centre = m.mean(0)
    turned = (m - centre) @ one_bit._rotation(64)
    norm = np.linalg.norm(turned, axis=1)
    along = np.abs(turned / norm[:, None]).sum(1) / math.sqrt(64)
    codes = np.packbits(turned > 0, axis=1, bitorder="little").view(np.uint64)
    estimate, error = one_bit.estimates(q, centre, codes, np.stack([norm, along, m @ centre]))
    assert (np.abs(estimate - q @ m.T) <= error).mean() > 0.99


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (20, [0.5, 0.5]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]),
        (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0]), (None, [1.0, 1.0]), (1, [1.0, 0.0]), (40, [0.0, 0.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    found = one_bit.nearest(frame, frame.where("vec_id % 20 = 0"), k=3)
    assert sorted(tuple(r) for r in found.collect()) == [
        (0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, 0.5), (20, 1, 0, 0.5), (20, 2, 1, 0.5), (20, 3, 2, 0.5),
    ]
    assert one_bit.nearest(frame.limit(0), frame, k=3).count() == 0
    assert one_bit.nearest(frame, frame.limit(0), k=3).count() == 0


def test_every_length_has_its_own_index(spark):
    """One vector of another length, also at the smallest id, takes nothing from the rest; equal to brute force for each length."""
    draw = np.random.default_rng(6)
    rows = [(i, draw.standard_normal(1 if i in (0, 7) else 3 if i % 4 == 0 else 5).tolist()) for i in range(150)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = one_bit.nearest(frame, frame.where("vec_id % 10 = 0"), k=4, block=20, per_block=5)
    wanted = []
    for q, v in rows:
        if q % 10 == 0:
            near = sorted(((sum(map(lambda a, b: a * b, v, w)), i) for i, w in rows if i != q and len(w) == len(v)), key=lambda s: (-s[0], s[1]))
            wanted += [(q, rank, i) for rank, (_, i) in enumerate(near[:4], 1)]
    assert sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id").collect()) == sorted(wanted)
    assert found.where("query_id = 0").count() == 1


# --- licenses --------------------------------------------------------------------


def test_license_statements(docs):
    rows = docs(
        (1, "CC BY"), (2, "cc by cc-by"), (3, "Released under the MIT License."), (4, "the general public licenses"),
        (5, "Licensed under the GNU General Public License, version 3."), (6, "All rights. Reserved! all rights reserved"),
        (7, "Licensed under CC BY-NC 4.0."), (8, "licensed the apache"), (9, "Licensed under the well known Apache License, Version 2.0"),
    )
    found = {r["doc_id"]: r for r in licences.scan(rows).collect()}
    assert [found[i]["labels"] for i in range(1, 10)] == ["cc-by", "cc-by", "mit", "", "gpl", "reserved", "cc-by,cc-by-nc", "", "apache-2.0"]
    assert [found[i]["n_base"] for i in range(1, 10)] == [1, 2, 0, 0, 1, 2, 1, 0, 0]
    assert (found[2]["first_word"], found[2]["last_word"]) == (0, 2)
    assert found[3]["score"] == 1.0 and found[8]["score"] == 0.0 and 0.6 <= found[9]["score"] < 1


def test_license_scan_of_odd_rows(odd, docs):
    found = licences.scan(odd.withColumn("words", F.lit(1)).withColumn("of", F.lit("x"))).collect()
    assert len(found) == 10
    assert {(r["n_words"], r["labels"], r["score"]) for r in found if r["doc_id"] in (1, 2, 3)} == {(0, "", 0.0)}
    twice = licences.scan(docs((1, "cc by"), (1, "cc by"), (None, "cc by"), (None, "cc by"))).collect()
    assert [r["n_base"] for r in twice] == [1] * 4
    assert licences.scan(docs()).count() == 0


def test_license_scan_has_no_python(docs):
    plan = licences.scan(docs((1, "cc by")).coalesce(1))._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("Python", "Pandas", "Arrow") if w in plan]


# --- leaks -----------------------------------------------------------------------


def plain_align(a, b):
    """Best local alignment score by the textbook table."""
    table, best = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)], 0.0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            table[i][j] = max(0, table[i - 1][j - 1] + (1 if a[i - 1] == b[j - 1] else -1), table[i - 1][j] - 1, table[i][j - 1] - 1)
            best = max(best, table[i][j])
    return best


def test_alignment_against_the_table():
    draw = random.Random(5)
    for _ in range(200):
        a, b = ([draw.randrange(4) for _ in range(draw.randrange(15))] for _ in range(2))
        assert leaks.align(np.array(a), np.array(b))[0] == plain_align(a, b)


def test_edited_copies_are_found(docs, prose, spark):
    item = prose(40, 1)
    w = item.split()
    edited = " ".join(w[:10] + ["other"] + w[11:20] + w[22:30] + ["one", "more"] + w[30:])
    rows = [(1, f"{prose(100, 2)} {item} {prose(50, 3)}"), (2, f"{prose(9, 4)} {edited}"), (3, prose(300, 5)), (4, " ".join(w[:8])), (5, item.upper() + "!")]
    tests = spark.createDataFrame([(7, item), (8, prose(30, 9)), (9, "one two"), (None, item), (10, None)], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r for r in leaks.leaks(docs(*rows), tests).collect()}
    assert set(found) == {(1, 7), (2, 7), (5, 7)}
    assert (found[1, 7]["score"], found[1, 7]["start_word"], found[1, 7]["end_word"]) == (1.0, 100, 140)
    assert 0.5 < found[2, 7]["score"] < 1


def test_a_passage_in_most_documents_is_not_lost(docs, prose, spark):
    item = prose(20, 1)
    rows = [(i, f"{prose(15, 10 + i)} {item}") for i in range(50)]
    tests = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert {r["doc_id"] for r in leaks.leaks(docs(*rows), tests).collect()} == set(range(50))


def test_copies_with_few_intact_trigrams_against_brute_force(docs, prose, spark, monkeypatch):
    """A lone copy with every 4th or 5th word changed, and a part of one; with exact copies elsewhere and without."""
    monkeypatch.setattr(leaks, "FREQUENT", 3, raising=False)  # the exact copies' trigrams are dealt to lanes
    items, rows = [], []
    for at, n in enumerate((40, 50, 59)):
        for i, every in enumerate((4, 5, None)):
            item = prose(n, 100 * at + i).split()
            copy = [f"new{x}" if x % every == every - 1 else w for x, w in enumerate(item)] if every else item[-28:]
            items.append((len(items), " ".join(item)))
            rows.append((len(rows), f"{prose(30, 7)} {' '.join(copy)} {prose(30, 8)}"))
    rows += [(100 + i, f"{prose(5, i)} {items[k][1]}") for i, k in enumerate([0, 0, 0, 4, 4, 4, 8, 8, 8])]
    wanted = {}
    for d, text in rows:
        for i, item in items:
            score = plain_align(text.lower().split(), item.lower().split())
            if score >= min(leaks.SHARE * len(item.split()), leaks.WORDS):
                wanted[d, i] = score / len(item.split())
    assert {(i, i) for i in range(9)} <= set(wanted)
    tests = spark.createDataFrame(items, "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in leaks.leaks(docs(*rows), tests).collect()} == wanted


def test_leaks_query_against_contained_items(spark):
    found = {(r["doc_id"], r["item_id"]) for r in queries.leaks(spark, DATA).collect()}
    items = spark.read.parquet(f"{DATA}/benchmark.parquet").collect()
    texts = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    assert {(d["doc_id"], i["item_id"]) for d in texts for i in items if i["text"] in d["text"]} <= found


def test_leaks_of_odd_rows(odd, docs, spark):
    tests = spark.createDataFrame([(1, "alpha beta gamma alpha beta"), (1, "alpha beta gamma alpha beta")], "item_id long, text string")
    found = leaks.leaks(odd.withColumn("passage", F.lit("x")), tests.withColumn("words", F.lit(1))).collect()
    assert [(r["doc_id"], r["item_id"], r["score"]) for r in found] == [(7, 1, 1.0)]
    assert leaks.leaks(docs(), tests).count() == 0
    assert leaks.leaks(odd, tests.limit(0)).count() == 0


# --- pipeline --------------------------------------------------------------------


def test_pipeline_against_its_operators(spark):
    documents = {r["doc_id"]: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, DATA).collect()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    good = corpus_pipeline.quality(spark, docs, DATA)
    assert good.columns == docs.columns
    single = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, good, DATA).collect()}
    held = {r["doc_id"] for r in queries.leaks(spark, DATA).collect()}
    assert set(out) == single - held
    for d, r in out.items():
        assert r["n_chars"] == len(r["text"]) and r["n_tokens"] == len(r["ids"])
        assert (r["lang"], r["source"]) == (documents[d]["lang"], documents[d]["source"])


def test_stages_stand_odd_rows(spark, odd):
    rows = odd.withColumn("lang", F.lit(None).cast("string")).withColumn("n_tokens", F.lit("x")).withColumn("kept", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, DATA)
        assert out.columns == rows.columns
        assert out.schema["kept"].dataType == rows.schema["kept"].dataType
        assert stage(spark, rows.limit(0), DATA).count() == 0
        out.collect()
    encoded = corpus_pipeline.encoded(spark, rows, DATA)
    assert encoded.columns == ["doc_id", "text", "lang", "kept", "n_tokens", "ids"]
    assert corpus_pipeline.encoded(spark, rows.limit(0), DATA).count() == 0


def test_quality_stage_keeps_good_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.quality(spark, docs, "/root/testdata/sf0.01").select("doc_id").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    good = [r["doc_id"] for r in labels if r["quality"] == 1]
    bad = [r["doc_id"] for r in labels if r["quality"] == 0]
    assert sum(d in kept for d in good) / len(good) > 0.99
    assert sum(d in kept for d in bad) / len(bad) < 0.1
    assert subword.THRESHOLD == 0.7
