"""Quality, language and personal data: accuracy, brute force, odd rows."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayside.llm import language, queries, skip_chain, subword

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def held_out(doc_id, divisor):
    return zlib.crc32(str(doc_id).encode()) % divisor


# --- quality ---------------------------------------------------------------------


def test_quality_on_held_out_documents(spark):
    found = {r["doc_id"]: r for r in queries.quality(spark, "/root/testdata/sf0.01").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert all(r["held_out"] == (held_out(d, 4) == 2) for d, r in found.items())
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in found.values())
    tested = [(labels[d], r["predicted"]) for d, r in found.items() if d in labels and r["held_out"]]
    assert len(tested) > 50
    assert sum(a == b for a, b in tested) / len(tested) > 0.95


def test_quality_of_odd_rows(spark, odd, docs):
    labels = spark.createDataFrame([(4, 1), (5, 0), (7, 1), (None, 0), (8, None), (99, 1)], "doc_id long, quality int")
    model = subword.learn(subword.labelled(odd, labels, F.lit(True)))
    scores = subword.score(odd.withColumn("score", F.lit("x")), model).collect()
    assert len(scores) == 10
    assert all(0 <= r["score"] <= 1 for r in scores)
    by_id = {r["doc_id"]: r["score"] for r in scores}
    assert by_id[1] == by_id[2]
    assert subword.score(docs(), model).count() == 0
    assert subword.accepted(odd.withColumn("score", F.lit("x")), model, threshold=0.0).count() == 10
    assert subword.accepted(odd, model, threshold=1.1).count() == 0


def test_quality_without_labels(spark, odd, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert subword.learn(subword.labelled(odd, none, F.lit(True))) is None
    assert {r["score"] for r in subword.score(odd, None).collect()} == {0.5}
    assert subword.accepted(odd, None).count() == 10


def test_training_repeats(spark, small):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    sample = subword.labelled(small, labels, F.lit(True))
    first = subword.learn(sample)
    assert np.array_equal(first, subword.learn(sample.orderBy(F.desc("doc_id"))))


# --- language --------------------------------------------------------------------


def test_language_on_held_out_documents(spark):
    found = queries.language(spark, "/root/testdata/sf0.01").collect()
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    tested = [(langs[r["doc_id"]], r["lang_pred"]) for r in found if r["held_out"] and langs[r["doc_id"]]]
    assert all(r["held_out"] == (held_out(r["doc_id"], 5) == 0) for r in found)
    assert sum(a == b for a, b in tested) / len(tested) > 0.97


def test_profiles_count_every_text(spark, docs):
    rows = docs((1, "ab ab"), (2, "ab!cd"), (3, None)).withColumn("lang", F.lit("xx"))
    grams = {}
    for words in (["ab", "ab"], ["ab", "cd"]):
        for w in words:
            for n in (1, 2, 3):
                for i in range(len(w) + 3 - n):
                    g = f" {w} "[i : i + n]
                    if g != " " and (n < 3 or g[1] != " "):
                        grams[g] = grams.get(g, 0) + 1
    keys = {g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g)) for g in grams}
    wanted = sorted(grams, key=lambda g: (-grams[g], keys[g]))
    # A space between two words also ends one and begins the next, as one n-gram of two never does.
    got = [r["gram"] for r in language.profiles(rows).orderBy("rank").collect()]
    assert got == [keys[g] for g in wanted]


def test_language_of_odd_rows(spark, odd, docs):
    learned = language.profiles(docs((1, "alpha beta gamma"), (2, "un deux trois")).withColumn("lang", F.when(F.col("doc_id") == 1, "en").otherwise("fr")))
    found = language.identify(odd.withColumn("lang_pred", F.lit(1)), learned).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == 10
    assert [by_id[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3
    assert by_id[7]["lang_pred"] == "en" and 0 <= by_id[7]["score"] <= 1
    assert language.identify(docs((1, "12 34 !")), learned).first()["lang_pred"] == "und"
    nothing = language.profiles(docs().withColumn("lang", F.lit("x")))
    assert {r["lang_pred"] for r in language.identify(odd, nothing).collect()} == {"und"}
    assert language.identify(docs(), learned).count() == 0


# --- personal data ---------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        total += int(c) if i % 2 == 0 else (2 * int(c) - 9 if c > "4" else 2 * int(c))
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and plain_luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_against_plain_patterns():
    draw = random.Random(4)
    parts = [*"a1 0.+-()@%_é9 5\n", "192.168.0.1", "4111111111111111", "a@b.co", "+1 (974) 555-3436", "00255.", "@@"]
    for _ in range(20_000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 25)))
        assert skip_chain.base_spans(text) == plain_spans(text), text


def test_patterns_take_linear_time():
    for text in ["a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1" * 150_000, "x" * 300_000 + " 1", "@a" * 150_000]:
        skip_chain.base_spans(text)
        assert skip_chain.Graph(text[:2000], []).words is not None


def test_messages_agree_with_enumeration():
    """On a tree of links loopy messages are exact."""
    draw = np.random.default_rng(0)
    field = skip_chain.Field(draw.normal(size=(skip_chain.FEATURES, 5)), draw.normal(size=(5, 5)), draw.normal(size=(5, 5)))
    graph = skip_chain.Graph("call 1234567 then 99 and 1234567", [])
    graph.chain, graph.skip = [(0, 1)], [(0, 2)]
    own = np.array([field.single[f].sum(0) for f in graph.features])
    joint = own[0][:, None, None] + own[1][None, :, None] + own[2][None, None, :] + field.chain[:, :, None] + field.skip[:, None, :]
    joint = np.exp(joint - joint.max())
    joint /= joint.sum()
    wanted = np.stack([joint.sum((1, 2)), joint.sum((0, 2)), joint.sum((0, 1))])
    assert np.allclose(field.marginals(graph), wanted, atol=1e-3)


def test_a_match_pulls_its_other_mentions_along(docs):
    phone = "+1 (974) 555-3436"
    train = [(i, f"call {phone.replace('974', str(100 + i))} now, or write to u{i}@mail.example.com about item {i}") for i in range(60)]
    field = skip_chain.learn(docs(*train))
    base, added = skip_chain.find_spans(f"call {phone} today. She said 555-3436 again", field)
    assert base == [("phone", 5, 5 + len(phone))]
    assert any(k == "phone" for k, _, _ in added)


def test_private_of_odd_rows(spark, odd, docs, small):
    field = skip_chain.learn(small)
    clash = odd.withColumn("spans", F.lit(1))
    digests = skip_chain.digests(skip_chain.spans(clash, field)).collect()
    assert len(digests) == 10
    assert {r["spans"] for r in digests if r["doc_id"] in (1, 2, 3)} == {""}
    assert skip_chain.spans(docs(), field).count() == 0
    text = "a@b.co or 10.0.0.1"
    masked = skip_chain.masked(docs((1, text), (2, None)).withColumn("spans", F.lit("x")), field)
    assert {r["doc_id"]: r["text"] for r in masked.collect()} == {1: "[EMAIL] or [IP]", 2: None}
    assert len(skip_chain.learn(docs()).single) == skip_chain.FEATURES


def test_private_query_against_plain_patterns(spark, small):
    texts = {r["doc_id"]: r["text"] or "" for r in small.collect()}
    for row in queries.private(spark, DATA).collect():
        wanted = plain_spans(texts[row["doc_id"]])
        assert [row[f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in wanted) for k in PATTERNS]
        said = {f"{k}:{a}:{b}" for k, a, b in wanted}
        assert said <= set(row["spans"].split(","))
        assert row["base_sha256"] == skip_chain.base_digest(texts[row["doc_id"]])
