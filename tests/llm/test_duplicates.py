"""Near-duplicates, repeated passages and components against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from wayside.llm import chosen_path, compact, components, queries

DATA = "/root/testdata/sf0.001"


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def shingles(text, size):
    w = words(text)
    return {tuple(w)} - {()} if len(w) < size else {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def plain_components(texts, size, num, den):
    """Smallest linked id of every (id, text), by comparing all pairs."""
    sets = [(d, shingles(t, size)) for d, t in texts]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and len(x & y) * den >= num * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {d: find(d) for d in root}


def edited(text, draw, n):
    w = text.split()
    for _ in range(n):
        w[draw.randrange(len(w))] = f"new{draw.random()}"
    return " ".join(w)


def family(prose, copies, seed, edits=3, length=120):
    draw = random.Random(seed)
    base = prose(length, seed)
    return [base] + [edited(base, draw, draw.randint(0, edits)) for _ in range(copies)]


def check(found, texts, size, num, den):
    wanted = plain_components([t for t in texts if t[0] is not None], size, num, den)
    assert len(found) == len(texts)
    for row in found:
        if row["doc_id"] is None:
            assert (row["component_id"], row["kept"]) == (None, True)
            continue
        assert row["component_id"] == wanted[row["doc_id"]], row
        assert row["kept"] == (row["doc_id"] == row["component_id"])
    sizes = sorted((d is None, d or 0, len(shingles(t, size))) for d, t in texts)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"]) for r in found) == sizes


def test_near_duplicates_against_all_pairs(docs, prose):
    texts = [t for seed in range(6) for t in family(prose, 12, seed)] + [prose(60, 100 + i) for i in range(30)]
    random.Random(1).shuffle(texts)
    rows = list(enumerate(texts))
    check(chosen_path.near_duplicates(docs(*rows), 3, 85).collect(), rows, 3, 85, 100)
    check(chosen_path.near_duplicates(docs(*rows)).collect(), rows, 5, 80, 100)


def test_large_nodes_and_split_groups(docs, prose, monkeypatch):
    """Small limits, so that nodes are grown on and groups are confirmed in several parts."""
    monkeypatch.setattr(chosen_path, "NODE", 8)
    monkeypatch.setattr(chosen_path, "GROUP", 40)
    rows = list(enumerate(family(prose, 90, 7, edits=1) + [prose(60, 200 + i) for i in range(20)]))
    check(chosen_path.near_duplicates(docs(*rows), 3, 85).collect(), rows, 3, 85, 100)


def test_pairs_inside_a_large_templated_group(docs, prose, monkeypatch):
    """Pages of one template, too unlike to be linked, each with one near copy: no third document links the two."""
    monkeypatch.setattr(chosen_path, "NODE", 8)
    monkeypatch.setattr(chosen_path, "GROUP", 40)
    monkeypatch.setattr(chosen_path, "SHARED", 1, raising=False)
    draw, template = random.Random(4), prose(120, 3)
    pages = [edited(template, draw, 4) for _ in range(120)]
    rows = list(enumerate(pages + [edited(page, draw, 1) for page in pages]))
    check(chosen_path.near_duplicates(docs(*rows), 3, 85).collect(), rows, 3, 85, 100)


def test_large_nodes_of_the_last_level(spark, monkeypatch):
    """Every root holds all documents and no level follows: twins that no chosen document is near to meet by blocks."""
    monkeypatch.setattr(chosen_path, "NODE", 4)
    monkeypatch.setattr(chosen_path, "DEPTH", 0)
    draw = np.random.default_rng(3)
    table = draw.integers(0, 2**32, (40, chosen_path.PLACES), dtype=np.uint32)
    roots = pa.RecordBatch.from_arrays([pa.array([0]), pa.array([table[0].tobytes()], pa.binary())], ["rep", "signature"])
    held = {p for b in chosen_path._roots(1 / (0.85 * chosen_path.PLACES))(iter([roots])) for p in b["path"].to_pylist()}
    for place in range(chosen_path.PLACES):
        changed = table[0].copy()
        changed[place] += 1
        one = pa.RecordBatch.from_arrays([pa.array([0]), pa.array([changed.tobytes()], pa.binary())], ["rep", "signature"])
        if {p for b in chosen_path._roots(1 / (0.85 * chosen_path.PLACES))(iter([one])) for p in b["path"].to_pylist()} != held:
            table[:, place] = table[0, place]
    rows = [(2 * i + twin, table[i].tobytes(), table[i].astype(np.uint8).tobytes()) for i in range(40) for twin in (0, 1)]
    reps = spark.createDataFrame(rows, "rep long, signature binary, short binary")
    found = components.components(chosen_path._gather(reps, 0.85)).collect()
    assert {(2 * i + 1, 2 * i) for i in range(40)} <= {(r["a"], r["b"]) for r in found}


def test_links_to_all_chosen_documents_that_are_near():
    """Near the first chosen document and like the second: both links stay, as the second's own group hangs on it."""
    table = np.zeros((3, chosen_path.PLACES), np.uint32)
    table[1, 80:], table[2, :8] = 1, 2  # shares of 0.62 and 0.94 with the document
    row = lambda i: pa.array([table[i].tobytes()], pa.binary())
    columns = {"path": pa.array([1]), "rep": pa.array([9]), "signature": row(0)}
    for i in range(chosen_path.PIVOTS):
        columns |= {f"rep{i}": pa.array([5 + i % 2]), f"signature{i}": row(1 + i % 2)}
    (out,) = chosen_path._large_nodes(0.6, 0.85, 0.01, False)(iter([pa.RecordBatch.from_pydict(columns)]))
    assert {(a, b) for kind, a, b in zip(*(c.to_pylist() for c in out.columns)) if kind == 0} == {(9, 5), (6, 5)}


def test_near_duplicates_of_odd_rows(odd, docs):
    clash = odd.withColumn("component_id", F.lit("x")).withColumn("rep", F.lit(1))
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    check(chosen_path.near_duplicates(clash, 3, 85).collect(), rows, 3, 85, 100)
    assert chosen_path.near_duplicates(docs()).count() == 0


def test_an_id_with_two_texts_joins_their_groups(docs, prose):
    a, b = prose(30, 1), prose(30, 2)
    found = chosen_path.near_duplicates(docs((5, a), (5, b), (1, a), (9, b))).collect()
    assert {(r["doc_id"], r["component_id"]) for r in found} == {(1, 1), (5, 1), (9, 1)}


def test_one_document_of_each_group_stays(docs, prose):
    a, b = prose(30, 1), prose(30, 2)
    rows = docs((3, a), (1, a), (1, a), (2, b), (None, a), (4, None), (4, None))
    kept = chosen_path.without_near_duplicates(rows.withColumn("kept", F.lit("x")))
    assert kept.columns == ["doc_id", "text", "kept"]
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 1, 2, 4]


def test_components_against_union(spark):
    draw = random.Random(3)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7)]
    root = {x: x for pair in links for x in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {(r["a"], r["b"]) for r in found} == {(x, find(x)) for x in root if find(x) != x}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- passages --------------------------------------------------------------------


def test_windows_are_those_of_the_cartesian_tree():
    draw = np.random.default_rng(2)
    for n, least in [(0, 3), (2, 3), (3, 3), (60, 5), (200, 7)]:
        values = draw.integers(1, 2**63, n, dtype=np.uint64)
        of = np.sort(draw.integers(0, 3, n))

        def tree(a, b):
            if b - a + 1 < least:
                return []
            c = a + int(values[a : b + 1].argmin())
            return [(a, c, b), *tree(a, c - 1), *tree(c + 1, b)]

        wanted = sorted(w for t in range(3) if (of == t).any() for w in tree(*np.flatnonzero(of == t)[[0, -1]].tolist()))
        assert sorted(zip(*(x.tolist() for x in compact.compact_windows(values, of, least)))) == wanted


def shared_documents(texts, length):
    """Ids of documents that hold some run of so many words that another one holds."""
    where = {}
    for d, t in texts:
        w = words(t)
        for i in range(len(w) - length + 1):
            where.setdefault(tuple(w[i : i + length]), set()).add(d)
    return {d for ids in where.values() if len(ids) > 1 for d in ids}


def test_repeats_query_against_all_runs(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    found = queries.repeats(spark, DATA).collect()
    assert shared_documents(texts, 51) <= {r["doc_id"] for r in found}
    by_id = dict(texts)
    for r in found:
        a = words(by_id[r["doc_id"]])[r["start_word"] : r["end_word"]]
        b = words(by_id[r["first_doc"]])[r["first_start"] : r["first_end"]]
        assert min(len(a), len(b)) >= compact.LEAST_WORDS
        x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
        assert len(x & y) >= compact.SIMILARITY * len(x | y)
        assert r["doc_id"] >= r["first_doc"]


def test_a_passage_inside_other_text(docs, prose):
    passage = prose(60, 1)
    rows = [(i, f"{prose(40 + 7 * i, 10 + i)} {passage} {prose(33, 50 + i)}") for i in range(6)] + [(9, prose(200, 99))]
    found = compact.repeats(docs(*rows)).collect()
    assert {r["doc_id"] for r in found} == set(range(6))
    for r in found:
        w = words(dict(rows)[r["doc_id"]])
        assert " ".join(w[r["start_word"] : r["end_word"]]) == passage.lower()


def test_later_copies_beside_a_shortened_first_one(docs, prose):
    """The first document holds 47 of 52 words, two later ones all of them: their repeat is a link of its own."""
    rows = []
    for i in range(20):
        passage = prose(52, 1000 + i)
        rows += [(100 * i + k, f"{prose(30, 2000 + 9 * i + k)} {part} {prose(30, 5000 + 9 * i + k)}") for k, part in enumerate([" ".join(passage.split()[3:50]), passage, passage])]
    found = {(r["doc_id"], r["first_doc"]) for r in compact.repeats(docs(*rows)).collect()}
    assert {(100 * i + 2, 100 * i + 1) for i in range(20)} <= found


def test_windows_of_a_key_all_meet():
    """Classes by content: copies meet the first one, the first ones each other; in one pass, and as tasks by blocks."""
    draw = random.Random(5)
    rows = sorted((key, draw.randrange(40), draw.randrange(12), 8 * draw.randrange(5000), (9 << 32) | 9) for key in range(4) for _ in range(150 if key < 3 else 900))
    first, wanted = {}, set()
    for key, content, doc, *_ in rows:
        first.setdefault((key, content), doc)
    for key, content, doc, *_ in rows:
        wanted |= {(max(doc, d), min(doc, d)) for (k, c), d in first.items() if k == key and d != doc and (c == content or doc == first[key, content])}
    names = ["key", "content", "doc_id", "centre", "reach"]
    for size in (7, 64, 5000):
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + size])], names) for i in range(0, len(rows), size)]
        met = {(a, b) for batch in compact._by_key(iter(batches), True) for a, b in zip(batch["doc_id"].to_pylist(), batch["first_doc"].to_pylist())}
        assert wanted <= met


def test_blocks_of_a_hot_key_meet_like_one_group():
    draw = np.random.default_rng(1)
    units = [np.arange(900), np.zeros(900, bool), draw.permutation(900), 8 * draw.integers(0, 999, 900), np.full(900, (9 << 32) | 9)]
    units += [units[2], units[3], units[4]]
    again = [u[:40].copy() for u in units]
    again[1][:] = True
    pairs = lambda found: sorted((a, b) for m in found for a, b in zip(m["doc_id"].to_pylist(), m["first_doc"].to_pylist()))
    whole = pairs(compact._each_with_each(units, np.array([0]), np.array([900]))) + pairs(compact._crossed(again, units))
    tasks: dict[int, dict[int, list]] = {}
    for batch in compact._dealt(3, units, again):
        assert len(batch) <= compact.BLOCK
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        tasks.setdefault(columns[0][0], {})[columns[1][0]] = columns[2:]
    split = []
    for sides in tasks.values():
        split += pairs(compact._crossed(sides[0], sides[1]) if 1 in sides else compact._each_with_each(sides[0], np.array([0]), np.array([len(sides[0][0])])))
    assert sorted(split) == sorted(whole)


def test_a_line_of_many_documents(docs, prose, monkeypatch):
    """Documents that share a line alone don't meet; others do in all their windows, as if all had met."""
    line = prose(16, 5)
    rows = [(i, f"{prose(60, 1000 + i)} {line} {prose(60, 3000 + i)}") for i in range(240)]
    for i in range(6):
        copy = words(rows[i][1])[25:110]
        rows.append((500 + i, " ".join([prose(20, 6000 + i), *copy[:8], "edited", *copy[9:], prose(20, 7000 + i)])))
    assert {(500 + i, i) for i in range(6)} <= {(r["doc_id"], r["first_doc"]) for r in compact.repeats(docs(*rows)).collect()}
    met = [tuple(r) for r in compact._meetings(docs(*rows)).collect()]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["doc_id", "text"])
    windows = pa.Table.from_batches(list(compact._windows(iter([batch])))).sort_by([(c, "ascending") for c in ("key", "content", "doc_id", "centre")])
    monkeypatch.setattr(compact, "HOT", 10**6)
    every = {m for found in compact._by_key(iter(windows.to_batches()), True) for m in zip(*(c.to_pylist() for c in found.columns))}
    pairs = {m[:2] for m in met}
    assert len(met) == len(set(met)) and set(met) == {m for m in every if m[:2] in pairs}
    assert 10 * len(met) < len(every)


def test_enough_in_common_against_all_pairs():
    draw = random.Random(3)
    line = [draw.randrange(1 << 16) for _ in range(30)]
    sets = []
    for i in range(150):
        own = [draw.randrange(400 if i % 3 else 1 << 16) for _ in range(60)]
        own[10 : 10 + i % 25] = line[: i % 25]
        sets.append(None if i % 40 == 7 else np.array(own if i % 9 else own[:2] * 30, np.uint16).tobytes())

    def enough(a, b):
        if a is None or b is None:
            return True
        a, b = (np.frombuffer(x, np.uint16).tolist() for x in (a, b))
        return compact.PART_OF * len({*a} & {*b}) >= min(len({*x[k : k + 46]}) for x in (a, b) for k in range(len(x) - 45))

    wanted = {(i, j) for i in range(150) for j in range(i + 1, 150) if enough(sets[i], sets[j])}
    assert 1000 < len(wanted) < 8000
    assert sorted((i, j) for x, y in compact._evident(sets) for i, j in zip(x.tolist(), y.tolist())) == sorted(wanted)
    apart = sorted((i, j + 60) for x, y in compact._evident(sets[:60], sets[60:]) for i, j in zip(x.tolist(), y.tolist()))
    assert apart == sorted((i, j) for i, j in wanted if i < 60 <= j)


def test_copies_of_a_repeated_line_with_other_documents_of_it(docs, prose):
    """Meetings beside the diagonal widen both places, and don't move the earlier one."""
    line = prose(12, 5)
    rows = [(1, " ".join([line] * 5)), (2, " ".join([line] * 5)), (3, prose(40, 6) + " " + " ".join([line] * 9))]
    found = {(r["doc_id"], r["first_doc"], r["start_word"], r["end_word"]) for r in compact.repeats(docs(*rows)).collect()}
    assert (2, 1, 0, 60) in found
    table = docs().sparkSession.createDataFrame([(2, 1, -12, 0, 43, 0), (2, 1, 0, 0, 55, 1)], ", ".join(f"{c} long" for c in compact._MEETING))
    assert [tuple(r) for r in compact._candidates(table).collect()] == [(2, 1, 0, 55, 0, 55)]


def test_copies_need_no_second_function(docs):
    """What equal windows say may come from one function: under another, other documents stand for them."""
    table = docs().sparkSession.createDataFrame([(2, 1, 0, 0, 55, 1 | compact.SURE), (4, 3, 0, 0, 55, 1)], ", ".join(f"{c} long" for c in compact._MEETING))
    assert [(r["doc_id"], r["first_doc"]) for r in compact._candidates(table).collect()] == [(2, 1)]


def test_many_diagonals_between_two_meetings(docs, prose):
    """Two meetings of one passage with twelve overlapping ones of other diagonals between them."""
    rows = [(2, 1, 0, 10, 90, 0), *[(2, 1, 1000 * (i + 1), 11 + i, 90, 0) for i in range(12)], (2, 1, 0, 40, 90, 1)]
    table = docs().sparkSession.createDataFrame(rows, ", ".join(f"{c} long" for c in compact._MEETING))
    assert [(r["low"], r["high"]) for r in compact._candidates(table).collect()] == [(10, 90)]


def test_repeats_of_odd_rows(odd, docs, prose):
    assert compact.repeats(odd.withColumn("pair", F.lit("x"))).count() == 0
    assert compact.repeats(docs()).count() == 0
    text = prose(80, 3)
    found = compact.repeats(docs((1, text), (1, text), (None, text), (4, text))).collect()
    assert {(r["doc_id"], r["start_word"], r["end_word"]) for r in found} == {(1, 0, 80), (4, 0, 80)}
