"""Secrets: patterns against plain expressions, and strings that a dictionary does not explain."""

from __future__ import annotations

import hashlib
import random
import re
import string

import pytest
from pyspark.sql import functions as F

from wayside.llm import novelty, queries


def plain(text):
    """The contract's patterns as they are written."""
    out = []
    for m in re.finditer("(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.I | re.A):
        out += [("assign", m.start(), m.end())] * (len(m[2]) >= 6)
    for kind, pattern, least in (("access", "AKIA[A-Z0-9]+", 20), ("hex", "[0-9a-f]+", 24)):
        out += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return sorted(out, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def odd_texts(n=400):
    draw = random.Random(11)
    parts = ["token", "TOKEN", "api_key", "apikey", "secret", "pass", "word", "paſſword", " ", "  ", "=", ":", "==", '"', "'", "abc", "abcdef", "x1_/=", "AKIA", "AKIA" + "A1" * 9, "0af3" * 7, "g", "é", "\n", "0af3" * 5]
    return ["".join(draw.choices(parts, k=draw.randint(1, 14))) for _ in range(n)]


def test_patterns_match_plain_expressions():
    for text in odd_texts():
        assert novelty.base_spans(text) == plain(text), text


@pytest.fixture(scope="module")
def dictionary(spark):
    return novelty.identifiers(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_dictionary_holds_the_most_frequent_parts(spark, dictionary):
    texts = [r[0] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    counts: dict[str, int] = {}
    for text in texts:
        for part in re.findall("[A-Za-z]{4,32}", text):
            counts[part] = counts.get(part, 0) + 1
    wanted = sorted(counts, key=lambda p: (-counts[p], p))[: novelty.PARTS]
    assert dictionary.decode().split() == wanted[::-1]


CONTEXTS = ["credential {}", "Authorization: Bearer {} ", 'client_key: "{}";', "the passphrase is ({})", "SIGNATURE={}"]


def test_planted_strings_are_found(spark, dictionary):
    """Random strings of 20 to 64 characters in sensitive contexts, in prose: at least 95 of 100 with exact ends."""
    draw, measure, hits = random.Random(3), novelty.Novelty(dictionary), 0
    prose = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect() if r[0] and len(r[0]) > 1000]
    for _ in range(100):
        secret = "".join(draw.choice(string.ascii_letters + string.digits) for _ in range(draw.choice([20, 24, 32, 40, 64])))
        text, at = draw.choice(prose), draw.randrange(900)
        text = f"{text[:at]} {draw.choice(CONTEXTS).format(secret)} {text[at:]}"
        hits += any(text[a:b] == secret for a, b, _ in novelty.find_spans(text, measure)[1])
    assert hits >= 95


@pytest.mark.parametrize("harmless", [
    "configuration_connection", "/usr/local/lib/python3/site-packages", "user.name1@example.com", "2024-03-02T10:11:12Z",
    "https://example.com/a/b/c/1234", "your-api-key-goes-here1", "abcdefghijklmnopqrstuvwxyz0123456789", "12345678901234567890", "aaaaaaaa11111111aaaaaaaa",
])
def test_what_the_dictionary_explains_is_left_alone(dictionary, harmless):
    assert novelty.find_spans(f"the credential stands here: {harmless} and so on", novelty.Novelty(dictionary))[1] == []


def test_context_line_and_patterns_bound_a_candidate(dictionary):
    measure, secret = novelty.Novelty(dictionary), "Zk3P9qLx7TtB2mVwQ8"
    assert novelty.find_spans(f"nothing said: {secret}", measure)[1] == []
    assert novelty.find_spans(f"bearer\n{secret}", measure)[1] == []
    assert novelty.find_spans(f"bearer {'and so on ' * 6}{secret}", measure)[1] == []
    base, novel = novelty.find_spans(f"credential token={secret}", measure)
    assert [s[0] for s in base] == ["assign"] and novel == []
    # The same string a second time is as new as the first.
    assert len(novelty.find_spans(f"bearer {secret}\nbearer {secret}", measure)[1]) == 2


def test_spans_and_digests(odd, spark, dictionary):
    rows = [*[(i, t) for i, t in enumerate(odd_texts(60))], (70, "bearer Zk3P9qLx7TtB2mVwQ8 token=abcdefg"), (70, "bearer Zk3P9qLx7TtB2mVwQ8 token=abcdefg"), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"kinds": F.lit(1), "n_hex": F.lit(None), "spans": F.lit("x")})
    got = novelty.digests(novelty.spans(frame, dictionary))
    assert got.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    wanted = []
    for doc, text in rows:
        base = plain(text or "")
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        every = "novel:7:25,assign:26:39" if doc == 70 else said
        wanted.append((doc, *[sum(s[0] == k for s in base) for k in ("assign", "access", "hex")], hashlib.sha256(said.encode()).hexdigest(), every))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, wanted))
    assert novelty.spans(odd, dictionary).count() == odd.count()
    assert novelty.spans(odd.limit(0), dictionary).count() == 0 and novelty.identifiers(odd.limit(0)) == b""


def test_query_covers_every_document(spark):
    frame = queries.QUERIES["op11_zstd_novelty_secrets"](spark, "/root/testdata/sf0.001")
    texts = {r[0]: r[1] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: r for r in frame.collect()}
    assert got.keys() == texts.keys()
    for doc, text in texts.items():
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in plain(text))
        assert got[doc]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(got[doc]["spans"].split(","))
