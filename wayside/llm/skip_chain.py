"""Personal data by fixed patterns and a skip-chain conditional random field.

Patterns find e-mail addresses, IP addresses, card and phone numbers. The field then labels
every word that holds a digit or an @: neighbouring words are linked in a chain, and words
of the same digits, the same last digits or the same name are linked however far apart they
stand. Loopy message passing lets an entity that a pattern found pull its other mentions
along, so that labels are consistent over the document.

The potentials are trained piece by piece on a bounded sample of texts in which the
patterns' matches are the labels: a softmax for single words, and the log odds of label
pairs for the two kinds of links.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wayside.llm.batches import by_batch, texts

KINDS = ["email", "ip", "card", "phone"]
LABELS = ["", *KINDS]

# The patterns of the base matches, with equal results in linear time.
_EMAIL_NAME, _EMAIL_HOST = re.compile(r"[A-Za-z0-9._%+-]"), re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
_ANY = re.compile(r"[0-9@]")

#: Texts that training sees at most; the only bound on what is learned from.
SAMPLE = 2000
#: Hashed features, passes and rate of the softmax; rounds and damping of the messages.
FEATURES, EPOCHS, RATE, ROUNDS, DAMPING = 1 << 11, 6, 0.3, 12, 0.3
#: Least probability of an added label, and what a base match adds to its label's potential.
SURE, BASE = 0.8, 6.0
SEED = 3
_SPANS = "doc_id long, kinds array<string>, starts array<int>, ends array<int>, added array<boolean>"


def _luhn(digits: str) -> bool:
    double = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(double) + sum(int(d) for d in digits[-1::-2])) % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and _EMAIL_NAME.match(text[start - 1]):
            start -= 1
        host = _EMAIL_HOST.match(text, at + 1) if start < at else None
        if host:
            out.append((start, host.end()))
            free = host.end()
        else:
            free = max(free, start)
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns' valid matches, by kind and place; end exclusive."""
    if not _ANY.search(text):
        return []
    found = [("email", a, b) for a, b in _emails(text)]
    found += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split("."))]
    for kind, pattern, least, most in (("card", _CARD, 13, 19), ("phone", _PHONE, 9, 15)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if least <= len(digits) <= most and (kind == "phone" or _luhn(digits)):
                found.append((kind, m.start(), m.end()))
    return found


class Graph:
    """The words of a text that may be labelled, their features, base labels and links."""

    def __init__(self, text: str, base: list[tuple[str, int, int]]):
        self.words = [(m.start(), m.end()) for m in _WORD.finditer(text)]
        n = len(self.words)
        self.base = np.zeros(n, int)
        starts = np.array([a for a, _ in self.words])
        for kind, a, b in base:
            i = max(int(np.searchsorted(starts, a, "right")) - 1, 0)
            while i < n and self.words[i][0] < b:
                if self.words[i][1] > a and not self.base[i]:
                    self.base[i] = LABELS.index(kind)
                i += 1
        parts = [self._parts(text[a:b]) for a, b in self.words]
        self.features = [self._features(text, i, parts[i]) for i in range(n)]
        self.chain = [(i, i + 1) for i in range(n - 1) if text[self.words[i][1] : self.words[i + 1][0]].isspace()]
        # A key's words are linked each to the next: as many links as words, however often one repeats.
        last: dict[tuple, int] = {}
        self.skip = []
        for i, (core, digits) in enumerate(parts):
            keys = {("word", core)} if len(core) > 3 else set()
            if len(digits) >= 7:
                keys |= {("digits", digits), ("end", digits[-7:])}
            if "@" in core:
                keys.add(("name", core.split("@")[0]))
            elif len(core) > 3:
                keys.add(("name", core))
            for key in keys:
                if key in last:
                    self.skip.append((last[key], i))
                last[key] = i
        self.skip = sorted(set(self.skip) - set(self.chain))

    @staticmethod
    def _parts(word: str) -> tuple[str, str]:
        core = word.strip(".,;:!?()[]{}<>\"'|").lower()
        return core, re.sub("[^0-9]", "", core)

    def _features(self, text: str, i: int, parts: tuple[str, str]) -> np.ndarray:
        a, b = self.words[i]
        core, digits = parts
        word = text[a:b]
        dotted = core.split(".")
        before = text[max(0, a - 40) : a].split()
        after = text[b : b + 40].split()
        shape = re.sub("[0-9]", "9", re.sub("[a-z]", "a", core[:24]))
        named = [
            "bias", f"digits{min(len(digits), 20)}", f"at{'@' in core}", f"plus{word.startswith('+')}", f"open{'(' in word}",
            f"dots{min(core.count('.'), 5)}", f"dash{min(core.count('-'), 4)}", f"alpha{any(c.isalpha() for c in core)}",
            f"quad{len(dotted) == 4 and all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in dotted)}",
            f"luhn{len(digits) > 12 and _luhn(digits)}", "shape" + re.sub(r"(.)\1+", r"\1+", shape),
            "before" + (re.sub("[0-9]", "9", before[-1].lower()) if before else ""), "after" + (re.sub("[0-9]", "9", after[0].lower()) if after else ""),
        ]
        return np.array([zlib.crc32(f.encode()) % FEATURES for f in named])


class Field:
    """Potentials: single words, chain links, skip links."""

    def __init__(self, single: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.single, self.chain, self.skip = single, chain, skip

    def marginals(self, graph: Graph) -> np.ndarray:
        """Label probabilities of each word by loopy sum-product messages."""
        n = len(graph.words)
        own = np.array([self.single[f].sum(0) for f in graph.features]).reshape(n, len(LABELS))
        held = np.flatnonzero(graph.base)
        own[held, graph.base[held]] += BASE
        links = np.array(graph.chain + graph.skip, int).reshape(-1, 2)
        if len(links):
            weight = np.exp(np.concatenate([np.repeat(self.chain[None], len(graph.chain), 0), np.repeat(self.skip[None], len(graph.skip), 0)]))
            source = np.concatenate([links[:, 0], links[:, 1]])
            target = np.concatenate([links[:, 1], links[:, 0]])
            weight = np.concatenate([weight, weight.transpose(0, 2, 1)])
            back = np.roll(np.arange(len(source)), len(links))
            message = np.zeros((len(source), len(LABELS)))
            for _ in range(ROUNDS):
                belief = own.copy()
                np.add.at(belief, target, message)
                inward = belief[source] - message[back]
                inward = np.exp(inward - inward.max(1, keepdims=True))
                new = np.log(np.einsum("ea,eab->eb", inward, weight))
                message = DAMPING * message + (1 - DAMPING) * (new - new.max(1, keepdims=True))
            np.add.at(own, target, message)
        share = np.exp(own - own.max(1, keepdims=True)) if n else own
        return share / share.sum(1, keepdims=True) if n else share


def _odds(pairs: list[tuple[int, int]]) -> np.ndarray:
    """Log odds of label pairs against independent labels, the same in both directions for equal ones."""
    count = np.full((len(LABELS),) * 2, 0.5)
    for a, b in pairs:
        count[a, b] += 1
    count /= count.sum()
    return np.clip(np.log(count / np.outer(count.sum(1), count.sum(0))), -3, 3)


def _train(rows: list[tuple[int, str]]) -> Field:
    graphs = [Graph(t, base_spans(t)) for _, t in sorted(rows)]
    words = [(f, y) for g in graphs for f, y in zip(g.features, g.base.tolist())]
    single = np.zeros((FEATURES, len(LABELS)))
    draw = np.random.default_rng(SEED)
    for epoch in range(EPOCHS):
        for i in draw.permutation(len(words)):
            features, label = words[i]
            logits = single[features].sum(0)
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[label] -= 1
            single[features] -= RATE / (1 + epoch) * error
    chain = _odds([(g.base[a], g.base[b]) for g in graphs for a, b in g.chain])
    skip = _odds([(g.base[a], g.base[b]) for g in graphs for a, b in g.skip])
    return Field(single, chain, (skip + skip.T) / 2 + np.where(np.eye(len(LABELS)) > 0, 1.0, 0.0))


def learn(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Field:
    """Train on at most `sample` documents with a digit or an @, chosen by a hash of their ids, in one task."""
    rows = texts(df, id_col, text_col).where("doc_id is not null and text rlike '[0-9@]'")
    drawn = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = rows.join(F.broadcast(drawn), "doc_id").repartition(1)

    def train(batches):
        held = [r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        field = _train(held)
        yield pa.RecordBatch.from_pydict({k: pa.array([getattr(field, k).tobytes()], pa.binary()) for k in ("single", "chain", "skip")})

    row = by_batch(chosen, train, "single binary, chain binary, skip binary").first()
    if row is None:
        return _train([])
    return Field(*(np.frombuffer(row[k]).reshape(-1, len(LABELS)) for k in ("single", "chain", "skip")))


def find_spans(text: str, field: Field) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and those that the field adds: words no base match touches, in runs of one label."""
    base = base_spans(text)
    if not _ANY.search(text):
        return base, []
    graph = Graph(text, base)
    if not graph.words:
        return base, []
    share = field.marginals(graph)
    best = share.argmax(1)
    added, neighbours = [], set(graph.chain)
    for i in np.flatnonzero((best > 0) & (share.max(1) >= SURE) & (graph.base == 0)):
        a, b = graph.words[i]
        word = text[a:b]
        a, b = a + len(word) - len(word.lstrip(".,;:!?[]{}<>\"'|")), b - len(word) + len(word.rstrip(".,;:!?[]{}<>\"'|"))
        kind = LABELS[best[i]]
        if added and added[-1][0] == kind and added[-1][3] == i - 1 and (i - 1, i) in neighbours:
            added[-1] = (kind, added[-1][1], b, i)
        elif a < b:
            added.append((kind, a, b, i))
    return base, sorted((k, a, b) for k, a, b, _ in added)


def spans(df: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its spans by kind and place: kinds, starts, ends (code points, end exclusive), and which the field added.

    A null or empty text has no spans. Rows that repeat, also with one id or none, each give
    a row; an empty table gives none; other columns are left behind. A text's work is linear
    in its length: patterns never go back over it, and links are as many as its words.
    """
    held = df.sparkSession.sparkContext.broadcast(field)

    def work(batches):
        for batch in batches:
            out = [find_spans(t, held.value) for t in batch.column(1).to_pylist()]
            every = [sorted([(KINDS.index(k), a, b, False) for k, a, b in x] + [(KINDS.index(k), a, b, True) for k, a, b in y]) for x, y in out]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([[KINDS[s[0]] for s in row] for row in every], pa.list_(pa.string())),
                    pa.array([[s[1] for s in row] for row in every], pa.list_(pa.int32())),
                    pa.array([[s[2] for s in row] for row in every], pa.list_(pa.int32())),
                    pa.array([[s[3] for s in row] for row in every], pa.list_(pa.bool_())),
                ],
                ["doc_id", "kinds", "starts", "ends", "added"],
            )

    return by_batch(texts(df, id_col, text_col), work, _SPANS)


def digests(found: DataFrame) -> DataFrame:
    """Counts and texts of spans: n_<kind> and base_sha256 of base spans, `spans` of all."""
    each = F.transform(F.arrays_zip("kinds", "starts", "ends", "added"), lambda s: F.struct(
        F.concat_ws(":", s["kinds"], s["starts"].cast("string"), s["ends"].cast("string")).alias("said"), s["kinds"].alias("kind"), s["added"].alias("added")
    ))
    rows = found.select("doc_id", each.alias("each"))
    base = F.filter("each", lambda s: ~s["added"])

    def of_kind(kind):
        return F.filter(base, lambda s: s["kind"] == kind)

    return rows.select(
        "doc_id",
        *[F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(F.transform(base, lambda s: s["said"]), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("each", lambda s: s["said"]), ",").alias("spans"),
    )


def masked(df: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """The rows of df with every span replaced by its kind in brackets; spans that overlap become one."""
    held = df.sparkSession.sparkContext.broadcast(field)
    place = df.columns.index(text_col)

    def mask(text):
        if text is None:
            return None
        base, added = find_spans(text, held.value)
        joined: list[list] = []
        for kind, a, b in sorted(base + added, key=lambda s: (s[1], -s[2], s[0])):
            if joined and a < joined[-1][2]:
                joined[-1][2] = max(joined[-1][2], b)
            else:
                joined.append([kind, a, b])
        out, at = [], 0
        for kind, a, b in joined:
            out += [text[at:a], f"[{kind.upper()}]"]
            at = b
        return "".join([*out, text[at:]])

    def work(batches):
        for batch in batches:
            column = pa.array([mask(t) for t in batch.column(place).to_pylist()], batch.schema.field(place).type)
            yield batch.set_column(place, batch.schema.field(place), column)

    return by_batch(df, work, df.schema)


def said(spans: list[tuple[str, int, int]]) -> str:
    """Spans as text, by kind and place."""
    ordered = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def base_digest(text: str) -> str:
    return hashlib.sha256(said(base_spans(text)).encode()).hexdigest()
