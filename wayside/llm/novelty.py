"""Secrets by fixed patterns, and by how little a dictionary helps to compress a string.

Patterns find assignments to a sensitive name, access keys and long hexadecimal strings.
Beside them, every run of printable characters that stands in a sensitive context (behind a
word such as `credential` or `bearer`, in the same line and not far from it) is a candidate.
It is compressed by zstandard with a dictionary of the corpus's frequent identifier parts, of
common names and paths, and of the text around it. The bytes that it adds are its novelty:
what the dictionary holds adds little, a random string adds as many bytes as it has. Those
that stay incompressible are reported as `novel`.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wayside.llm.batches import by_batch, texts

KINDS = ["assign", "access", "hex", "novel"]

# The patterns of the base matches, with equal results in linear time.
_ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
# Words that make a context sensitive.
_CONTEXT = re.compile(
    r"pass(?:word|wd|phrase)|\bpwd\b|secret|token|credential|bearer|authorization|api.?key|access.?key|private.?key|client.?key|signature|session.?id|cookie",
    re.ASCII | re.IGNORECASE,
)
# Strings that many texts hold and no secret is.
_COMMON = (
    "Monday January 2024-01-01T00:00:00.000Z 127.0.0.1 123456789 00000000 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 "
    "https://www.example.com/index.html http://localhost:8080/api/v1/ user.name@example.com @mail.com /usr/local/lib/python3/site-packages/ "
    "/home/user/ /var/log/ /etc/ssl/certs/ C:/Program Files/ your-api-key-goes-here example_value_number placeholder changeme notasecret "
    "configuration connection string session headers content application/json settings environment variable process.env os.environ config.get request.headers"
)
_RUN = re.compile(r"[!#$%&*+./0-9:=?@A-Z^_a-z~-]+")
_PART = re.compile(r"[A-Za-z]{4,32}")

#: Identifier parts in the dictionary, and parts a task counts before it passes them on.
PARTS, _HELD = 4096, 1 << 18
#: Code points between a sensitive word and its candidate at most, and of text around it that the dictionary holds.
REACH, AROUND = 48, 512
#: Code points of a candidate, at least and at most; bytes it must add, and the share of its own bytes; letters it has.
SHORT, LONG, BYTES, SHARE, LETTERS = 16, 512, 14, 0.92, 4
#: Bits a character must have, counted in the candidate itself; level of compression, and known bytes before a candidate.
BITS, LEVEL, KNOWN = 3.0, 3, 64
_SPANS = "doc_id long, kinds array<string>, starts array<int>, ends array<int>, novelty array<double>"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns' valid matches; code points, end exclusive."""
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(found, key=_place)


def _place(span):
    return span[1], KINDS.index(span[0]), span[2]


def identifiers(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = PARTS) -> bytes:
    """The corpus's most frequent identifier parts, the most frequent last, as a dictionary.

    Parts are runs of 4 to 32 letters, so a random string is no part of it, however often its
    document was copied. All texts are counted; only the first `size` parts come to the driver.
    """
    rows = texts(df, id_col, text_col).select("text")

    def work(batches):
        held: Counter[str] = Counter()

        def told():
            parts = pa.RecordBatch.from_pydict({"part": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})
            held.clear()
            return parts

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.update(_PART.findall(text))
                if len(held) >= _HELD:
                    yield told()
        yield told()

    counted = by_batch(rows, work, "part string, n long").groupBy("part").agg(F.sum("n").alias("n"))
    best = counted.orderBy(F.desc("n"), "part").limit(size).collect()
    return " ".join(r["part"] for r in reversed(best)).encode()


class Novelty:
    """Marginal compressed bytes against a dictionary of identifiers and the text around."""

    def __init__(self, dictionary: bytes):
        import zstandard

        self.zstd = zstandard
        self.plain = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
        # Zeros in front keep the content from being taken for a trained dictionary.
        self.dictionary = b"\0" * 8 + _COMMON.encode() + b" " + dictionary + b" "

    def added(self, candidate: str, around: str) -> int:
        """Bytes that a candidate adds to a frame primed with identifiers and the text around it.

        The frame begins with known text, so that what any frame costs is not counted.
        """
        primed = self.zstd.ZstdCompressionDict(self.dictionary + around.encode(), dict_type=self.zstd.DICT_TYPE_RAWCONTENT)
        press = self.zstd.ZstdCompressor(dict_data=primed, compression_params=self.plain).compress
        known = self.dictionary[-KNOWN:]
        return len(press(known + candidate.encode())) - len(press(known))


def _bits(text: str) -> float:
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def find_spans(text: str, novelty: Novelty) -> tuple[list[tuple[str, int, int]], list[tuple[int, int, float]]]:
    """Base spans, and (start, end, added share) of the novel strings that none of them touches."""
    base = base_spans(text)
    found, seen = [], -1
    for said in _CONTEXT.finditer(text):
        line = text.find("\n", said.end(), said.end() + REACH)
        stop = said.end() + REACH if line < 0 else line
        for run in _RUN.finditer(text, max(said.end(), seen)):
            if run.start() >= stop:
                break
            seen = run.end()
            a, b = _inner(text, run.start(), run.end())
            if not SHORT <= b - a <= LONG or any(a < end and start < b for _, start, end in base):
                continue
            candidate = text[a:b]
            if not _mixed(candidate) or _bits(candidate) < BITS:
                continue
            # The text around is taken without the candidate, also where it stands once more.
            around = (text[max(0, a - AROUND) : a] + " " + text[b : b + AROUND]).replace(candidate, " ")
            added = novelty.added(candidate, around)
            if added >= BYTES and added >= SHARE * (b - a):
                found.append((a, b, added / (b - a)))
    return base, found


def _mixed(run: str) -> bool:
    """Letters and digits: neither a word nor a number."""
    return sum(c.isalpha() for c in run) >= LETTERS and any(c.isdigit() for c in run)


def _inner(text: str, a: int, b: int) -> tuple[int, int]:
    """A run without a name and the sign that gives it the value, and without marks at its ends."""
    run = text[a:b]
    for sign in (":=", "=", ":"):
        at = run.find(sign)
        if 0 <= at < len(run) - SHORT and run[:at].replace("_", "a").replace("-", "a").replace(".", "a").isalpha():
            a += at + len(sign)
            break
    run = text[a:b]
    a += len(run) - len(run.lstrip("=.,;:!?*#%&"))
    return a, max(a, b - len(run) + len(run.rstrip(".,;:!?*#%&")))


def spans(df: DataFrame, dictionary: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its spans by place: kinds, starts, ends (code points, end exclusive), novelty (null for patterns).

    A null or empty text has none. Rows that repeat, also with one id or none, each give a row;
    spans that start together are ordered by kind. An empty table gives no rows; other columns
    are left behind. A text's work is in proportion to its length, but for candidates.
    """
    held = df.sparkSession.sparkContext.broadcast(dictionary)

    def work(batches):
        novelty = Novelty(held.value)
        for batch in batches:
            every = []
            for text in batch.column(1).to_pylist():
                base, novel = find_spans(text, novelty)
                every.append(sorted([(*s, None) for s in base] + [("novel", a, b, share) for a, b, share in novel], key=_place))
            columns = [pa.array([[s[i] for s in row] for row in every], pa.list_(kind)) for i, kind in enumerate((pa.string(), pa.int32(), pa.int32(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "kinds", "starts", "ends", "novelty"])

    return by_batch(texts(df, id_col, text_col), work, _SPANS)


def digests(found: DataFrame) -> DataFrame:
    """Counts and texts of spans: n_<kind> and base_sha256 of the patterns' spans, `spans` of all."""
    each = F.transform(F.arrays_zip("kinds", "starts", "ends"), lambda s: F.struct(
        F.concat_ws(":", s["kinds"], s["starts"].cast("string"), s["ends"].cast("string")).alias("said"), s["kinds"].alias("kind")
    ))
    base = F.filter("each", lambda s: s["kind"] != "novel")

    def of_kind(kind):
        return F.filter("each", lambda s: s["kind"] == kind)

    return found.select("doc_id", each.alias("each")).select(
        "doc_id",
        *[F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(F.array_join(F.transform(base, lambda s: s["said"]), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("each", lambda s: s["said"]), ",").alias("spans"),
    )
