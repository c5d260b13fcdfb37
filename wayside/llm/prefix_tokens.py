"""Exact token counts of every prefix of a text, by dynamic programming over its bytes.

A byte-pair encoding is the only sequence of tokens in which no neighbouring pair would
have been merged otherwise. So the last token of a prefix is the one token that ends
there and is stable next to the last token of the shorter prefix it follows; the count
is that prefix's count plus one. Counts of all prefixes come from one pass, and a
truncation or budget is read off them without encoding again.

Works for byte-level BPE files of the `tokenizers` library with its usual split pattern.
"""

from __future__ import annotations

import bisect
import itertools
import json
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from wayside.llm.batches import by_batch, texts

# The split pattern of byte-level BPE, in Unicode classes.
_SPLIT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
# The same for texts in which the quicker engine's classes agree with those above.
_SPLIT_PLAIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_NOT_PLAIN = re.compile("[^\n -~¡-¬®-±´-¸º»¿-ɏ‐-‧]")
_CONTRACTIONS = {"'re", "'ve", "'ll"}

#: Entries a worker's table of pieces may hold before it starts anew.
CACHE_ENTRIES = 250_000
#: Rows whose new pieces are looked up together.
ROWS = 500
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bounded(dict):
    """A table filled on demand that keeps the keys of late and lets older ones go."""

    def __init__(self, make, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.make, self.entries, self.older = make, entries, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self) >= self.entries:
            self.older = dict(self)
            self.clear()
        self[key] = value

    def known(self, key) -> bool:
        return key in self or key in self.older


class PrefixCounter:
    """Prefix counts for one vocabulary file, given as its bytes."""

    def __init__(self, vocabulary: bytes):
        spec = json.loads(vocabulary)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("only byte-level BPE without a normalizer or a prefix space is supported")
        alphabet = _byte_alphabet()
        to_bytes = lambda piece: bytes(alphabet[c] for c in piece)
        self.special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self.tokens = {to_bytes(p) for p in model["vocab"] if p not in self.special}
        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.ranks = {(to_bytes(a), to_bytes(b)): i for i, (a, b) in enumerate(pairs)}
        self.halves = {a + b: (a, b) for a, b in self.ranks}
        self.special_pattern = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        ending: dict[bytes, set[int]] = {}
        for token in self.tokens:
            if len(token) > 2:
                ending.setdefault(token[-3:], set()).add(len(token))
        #: Lengths of the tokens that end in up to three given bytes, longest first.
        self.lengths = {end: (*sorted(found, reverse=True), 2, 1) for end, found in ending.items()}
        self.number = {token: i for i, token in enumerate(self.tokens)}
        self.names = list(self.number)
        # By numbers: a token, or two as one key, the left one times 2 ** 20.
        self.stable = Bounded(lambda pair: self._stable(self.names[pair >> 20], self.names[pair & 0xFFFFF]))
        self.reached = Bounded(lambda n: self._merge(self.names[n]) == [self.names[n]])
        self.counts = Bounded(lambda piece: self._prefixes([piece])[0])
        self.chunks = Bounded(self._chunk)

    def _merge(self, piece: bytes) -> list[bytes]:
        """The encoding by its definition; only ever asked for one or two tokens."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get((a, b), 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _spine(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """The parts of a token at one of its ends, each with the rank of the merge that uses it up."""
        out, until = [], 1 << 60
        while True:
            out.append((token, until))
            parts = self.halves.get(token)
            if parts is None:
                return out
            token, until = parts[side], self.ranks[parts]

    def _stable(self, left: bytes, right: bytes) -> bool:
        """Whether two tokens that are each reached stay apart side by side.

        They don't if, while a part at the end of the left one and a part at the start of
        the right one both stand, the merge of the two comes first; of equal merges the
        leftmost goes first.
        """
        ranks = self.ranks
        for a, until_a in self._spine(left, 1):
            for b, until_b in self._spine(right, 0):
                rank = ranks.get((a, b))
                if rank is not None and rank < until_a and rank <= until_b:
                    return False
        return True

    def _prefixes(self, pieces: list[str]) -> list:
        """Token counts after each character of each pre-token.

        The table of one piece goes on from the bytes it shares with the one before, so
        sorted pieces cost little more than the bytes in which they differ.
        """
        stable, reached, lengths, number = self.stable, self.reached, self.lengths, self.number
        last, count, before, out = [0], [0], b"", []
        for piece in pieces:
            data = piece.encode()
            n = len(data)
            same = 0
            for same, (a, b) in enumerate(zip(data, before)):
                if a != b:
                    break
            else:
                same = min(n, len(before))
            del last[same + 1 :], count[same + 1 :]
            for end in range(same + 1, n + 1):
                for size in lengths.get(data[end - 3 : end], (2, 1)) if end > 2 else (2, 1):
                    start = end - size
                    if start < 0:
                        continue
                    token = number.get(data[start:end])
                    if token is not None and (stable[last[start] << 20 | token] if start else reached[token]):
                        last.append(token)
                        count.append(count[start] + 1)
                        break
            before = data
            if n == len(piece):
                found = count[1:]
            else:
                found = [count[i] for i in range(1, n) if data[i] & 0xC0 != 0x80] + count[-1:]
            out.append(bytes(found) if found[-1] < 256 else tuple(found))
        return out

    def learn(self, texts: list[str]) -> None:
        """Fill the tables with what several texts need, in sorted order."""
        parts = {part for text in texts for special, seg in self._segments(text) if not special for part in self._parts(seg)}
        chunks = {c: self.pieces(c) for c in parts if not self.chunks.known(c)}
        new = sorted({p for held in chunks.values() for p in held if not self.counts.known(p)})
        for piece, counts in zip(new, self._prefixes(new)):
            self.counts.put(piece, counts)
        for chunk, held in chunks.items():
            self.chunks.put(chunk, sum(self.counts[p][-1] for p in held))

    def pieces(self, text: str) -> list[str]:
        return (_SPLIT if _NOT_PLAIN.search(text) else _SPLIT_PLAIN).findall(text)

    def _chunk(self, chunk: str) -> int:
        counts = self.counts
        return sum(counts[p][-1] for p in self.pieces(chunk))

    def _segments(self, text: str) -> Iterator[tuple[bool, str]]:
        """The text cut at special strings: (is special, part)."""
        at = 0
        for m in self.special_pattern.finditer(text) if self.special_pattern else ():
            if m.start() > at:
                yield False, text[at : m.start()]
            yield True, m[0]
            at = m.end()
        if at < len(text):
            yield False, text[at:]

    def _parts(self, segment: str) -> list[str]:
        """Parts that are encoded on their own whatever stands around them.

        A space between two others that are not white space always begins a pre-token;
        texts with other white space are cut into pre-tokens at once.
        """
        if "  " in segment or " \n" in segment or "\n " in segment or _NOT_PLAIN.search(segment):
            return self.pieces(segment)
        first, *rest = segment.split(" ")
        parts = [" " + p for p in rest]
        return [first, *parts] if first else parts

    def measure(self, text: str, limit: int | None = None) -> tuple[int, int]:
        """Tokens of the text, and characters of its longest prefix of at most `limit` tokens."""
        total, fits = 0, None
        chars = 0
        for special, part in self._segments(text):
            parts = [part] if special else self._parts(part)
            counts = [1] if special else list(map(self.chunks.__getitem__, parts))
            more = sum(counts)
            if limit is not None and fits is None and total + more > limit:
                fits = chars + self._fit(parts, counts, limit - total, special)
            total += more
            chars += len(part)
        return total, chars if fits is None else fits

    def _fit(self, parts: list[str], counts: list[int], left: int, special: bool) -> int:
        """Characters of the parts that `left` tokens hold; the parts have more."""
        if special:
            return 0
        sums = list(itertools.accumulate(counts))
        k = bisect.bisect_right(sums, left)
        chars = sum(map(len, parts[:k]))
        left -= sums[k - 1] if k else 0
        for piece in self.pieces(parts[k]):
            fits = [i for i, c in enumerate(self.counts[piece], 1) if c <= left]
            chars += fits[-1] if fits else 0
            if not fits or fits[-1] < len(piece):
                break
            left -= self.counts[piece][-1]
        return chars

    def prefix_counts(self, text: str) -> np.ndarray:
        """Exact token count of text[:i] for every i from 0 to len(text)."""
        out, base, tail = [0], 0, ""
        for special, part in self._segments(text):
            if special:
                held = self.pieces(tail)
                for i in range(1, len(part)):
                    cut = self.pieces(tail + part[:i])
                    same = next((k for k, (a, b) in enumerate(zip(held, cut)) if a != b), min(len(held), len(cut)))
                    changed = sum(self.counts[p][-1] for p in cut[same:]) - sum(self.counts[p][-1] for p in held[same:])
                    out.append(base + changed)
                base, tail = base + 1, ""
                out.append(base)
                continue
            blank = 0  # tokens of the white space that the next piece's first character prolongs
            run = ""
            for piece in self.pieces(part):
                if piece in _CONTRACTIONS:
                    counts = (1, 1 + self.counts[piece[1]][-1], self.counts[piece][-1])
                else:
                    counts = self.counts[piece]
                if run and piece[0].isspace():
                    # A prefix that ends here has all this white space as one piece.
                    joined = self.counts[run + piece[0]][-1]
                    out.append(base - blank + joined)
                    out.extend(base + c for c in counts[1:])
                else:
                    out.extend(base + c for c in counts)
                run = piece if piece.isspace() else ""
                blank = counts[-1] if run else 0
                base += counts[-1]
            tail = part
        return np.array(out)


def token_counts(
    df: DataFrame, vocabulary: str | Path, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: bytes, tokens, whether they pass the limit, and how many characters fit it.

    Tokens are those of the `tokenizers` library without added special tokens; special
    strings in a text count as the one token that the library makes of them. fit_chars is
    the length of the longest prefix whose own encoding has at most `limit` tokens, cut at
    pre-token parts of the whole text.

    A null or empty text has no bytes and no tokens and fits whole. Rows that repeat, also
    with one id or none, each give a row. An empty table gives no rows. Other columns are
    left behind. The work of a text is linear in its length.
    """
    held = df.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())

    def work(batches):
        counter = PrefixCounter(held.value)
        for batch in batches:
            rows = batch.column(1).to_pylist()
            found = []
            for i in range(0, len(rows), ROWS):
                counter.learn(rows[i : i + ROWS])
                found += [counter.measure(t, limit) for t in rows[i : i + ROWS]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t.encode()) for t in rows], pa.int64()),
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([n > limit for n, _ in found], pa.bool_()),
                    pa.array([fits for _, fits in found], pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"],
            )

    return by_batch(texts(df, id_col, text_col), work, SCHEMA)
