"""SentencePiece encoding with the source bytes of every piece, and decoding.

A text is normalised by the longest match in the model's compiled character map; each
normalised byte records the source byte it comes from. Pieces are cut from the
normalised text, and their spans are projected through that record to bytes of the
original. No piece of these models reaches past the white space that begins a word, so
words are encoded apart and a worker keeps what it has seen.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable
from functools import cached_property
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from wayside.llm.batches import by_batch, passes, texts
from wayside.llm.prefix_tokens import Bounded

SPACE = "▁"
CACHE_ENTRIES = 300_000
#: Words of which a worker that gives ids only keeps the ids.
ID_ENTRIES = 100_000
ENCODED = "doc_id long, ids array<int>, starts array<int>, ends array<int>, decoded string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string"

_RUNS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class CharMap:
    """A model's compiled character map: replacements found by longest match."""

    def __init__(self, compiled: bytes):
        self.units, self.values = np.empty(0, np.uint32), b""
        if compiled:
            size = int.from_bytes(compiled[:4], "little")
            self.units = np.frombuffer(compiled[4 : 4 + size], "<u4")
            self.values = compiled[4 + size :]
        self.at = self.units.tolist()
        self.found = Bounded(lambda head: self._starts(head), 100_000)

    def _starts(self, head: str) -> bool:
        """Whether any entry begins with the first byte of a character."""
        return self._step(self._offset(self.at[0]), head.encode()[0]) is not None

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 512) >> 6)

    def _step(self, place: int, byte: int) -> int | None:
        """The unit reached by a byte, if the map has it."""
        if (place ^ byte) >= len(self.at):
            return None
        unit = self.at[place ^ byte]
        return unit if unit & 0x800000FF == byte else None

    def longest(self, data: bytes, start: int) -> tuple[int, bytes] | None:
        """Bytes taken by the longest entry at a place, and what stands for them."""
        if not self.at:
            return None
        place, best = self._offset(self.at[0]), None
        for i in range(start, len(data)):
            unit = self._step(place, data[i])
            if unit is None:
                break
            place = place ^ data[i] ^ self._offset(unit)
            if unit & 256:
                best = i + 1 - start, self.at[place] & 0x7FFFFFFF
        if best is None:
            return None
        return best[0], self.values[best[1] : self.values.index(b"\0", best[1])]

    def apply(self, text: str) -> tuple[bytes, np.ndarray]:
        """Replaced bytes, and the source byte each comes from (with one more for the end)."""
        data = text.encode()
        if not self.at or not any(map(self.found.__getitem__, set(text))):
            return data, np.arange(len(data) + 1)
        out, source, place, n = bytearray(), [], 0, len(data)
        while place < n:
            hit = self.longest(data, place)
            if hit is None:
                head = data[place]
                size = 1 if head < 0x80 else 2 if head < 0xE0 else 3 if head < 0xF0 else 4
                hit = size, data[place : place + size]
            out += hit[1]
            # Bytes of a replacement all stand for the first byte of what they replace.
            source += range(place, place + hit[0]) if hit[1] == data[place : place + hit[0]] else [place] * len(hit[1])
            place += hit[0]
        return bytes(out), np.array([*source, n])


class Normalizer:
    """Normalisation of a model: map, white space, and the marker before the first word."""

    def __init__(self, spec):
        self.map = CharMap(spec.precompiled_charsmap)
        self.prefix, self.collapse, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces

    def apply(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and the source byte of each of its bytes and of its end."""
        data, source = self.map.apply(text)
        end = len(text.encode())
        if self.collapse:
            part = np.frombuffer(data, np.uint8)
            blank = part == 0x20
            keep = ~(blank & np.concatenate([[True], blank[:-1]])) if len(part) else blank
            last = np.flatnonzero(keep & ~blank)
            stop = int(last[-1]) + 1 if len(last) else 0
            keep[stop:] = False
            end = int(source[stop])
            source = np.append(source[:-1][keep], end)
            data = part[keep].tobytes()
        if not data:
            return "", np.array([end])
        plain = data.decode(errors="replace")
        mark = SPACE if self.escape else " "
        if self.escape:
            widths = np.where(np.frombuffer(data, np.uint8) == 0x20, 3, 1)
            source = np.append(np.repeat(source[:-1], widths), end)
            plain = plain.replace(" ", SPACE)
        if self.collapse and plain.endswith(mark):
            # A marker that stood in the text itself goes with the white space at the end.
            plain = plain.rstrip(mark)
            source = source[: len(plain.encode()) + 1]
            if not plain:
                return "", source
        if self.prefix:
            plain = mark + plain
            source = np.concatenate([np.full(len(mark.encode()), source[0]), source])
        return plain, source


class Chunk(NamedTuple):
    """One word's pieces: ids and normalised byte ranges as packed int32, and as text."""

    ids: bytes
    sizes: bytes
    id_text: str
    decoded: str


class PieceCodec:
    """Encoding and decoding for one model file, given as its bytes."""

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(model)
        self.normalizer = Normalizer(spec.normalizer_spec)
        self.pieces = [p.piece for p in spec.pieces]
        self.kinds = [p.type for p in spec.pieces]
        self.unknown = spec.trainer_spec.unk_surface
        self.control, self.byte, self.unk = 3, 6, 2
        self.apart = not any(SPACE in p.lstrip(SPACE) for p in self.pieces) and not spec.trainer_spec.treat_whitespace_as_suffix
        # The merges are the library's; it is given text that is normalised already.
        spec.normalizer_spec.name = "identity"
        spec.normalizer_spec.precompiled_charsmap = b""
        spec.normalizer_spec.add_dummy_prefix = spec.normalizer_spec.remove_extra_whitespaces = False
        self.model = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
        self.words = Bounded(lambda word: self._chunks([SPACE + word])[0], CACHE_ENTRIES)
        self.others = Bounded(lambda chunk: self._chunks([chunk])[0], CACHE_ENTRIES // 10)

    def _chunks(self, chunks: list[str]) -> list[Chunk]:
        out = []
        for chunk, ids in zip(chunks, self.model.encode(chunks, num_threads=1)):
            sizes, data, place = [], chunk.encode(), 0
            for i, n in enumerate(ids):
                if self.kinds[n] == self.byte or self.kinds[n] == self.unk:
                    # Bytes stand for one character; the last of them takes its range.
                    head = data[place]
                    size = 1 if head < 0x80 else 2 if head < 0xE0 else 3 if head < 0xF0 else 4
                    if self.kinds[n] == self.unk:
                        sizes.append(size)
                        place += size
                    else:
                        done = sum(1 for _ in self._bytes_before(ids, i)) + 1
                        sizes.append(size if done % size == 0 else 0)
                        place += sizes[-1]
                else:
                    sizes.append(len(self.pieces[n].encode()))
                    place += sizes[-1]
            out.append(
                Chunk(
                    np.array(ids, np.int32).tobytes(), np.array(sizes, np.int32).tobytes(), ",".join(map(str, ids)),
                    self._surface(ids),
                )
            )
        return out

    def _bytes_before(self, ids, i):
        """Byte pieces before one that belong to the same character."""
        data = []
        k = i - 1
        while k >= 0 and self.kinds[ids[k]] == self.byte:
            value = int(self.pieces[ids[k]][3:5], 16)
            if value < 0x80:
                break
            data.append(k)
            k -= 1
            if value >= 0xC0:
                break
        this = int(self.pieces[ids[i]][3:5], 16)
        return data if 0x80 <= this < 0xC0 else []

    def _surface(self, ids) -> str:
        """Pieces put together again, white space as spaces."""
        out, held = [], bytearray()
        for n in ids:
            if self.kinds[n] == self.byte:
                held.append(int(self.pieces[n][3:5], 16))
                continue
            if held:
                out.append(held.decode(errors="replace"))
                held = bytearray()
            if self.kinds[n] == self.unk:
                out.append(self.unknown)
            elif self.kinds[n] != self.control:
                out.append(self.pieces[n].replace(SPACE, " "))
        if held:
            out.append(held.decode(errors="replace"))
        return "".join(out)

    def chunks(self, plain: str) -> list[Chunk]:
        """Pieces of a normalised text, word by word."""
        if not plain:
            return []
        if not self.apart:
            return [self.others[plain]]
        if plain[0] == SPACE and SPACE * 2 not in plain and len(plain) > 1 and plain[-1] != SPACE:
            return list(map(self.words.__getitem__, plain[1:].split(SPACE)))
        return list(map(self.others.__getitem__, _RUNS.findall(plain)))

    def learn(self, plain: list[str]) -> None:
        """Encode the new words of several texts in one call."""
        if not self.apart:
            return
        new = {w for p in plain for w in p.split(SPACE) if w and not self.words.known(w)}
        new = sorted(new)
        for word, chunk in zip(new, self._chunks([SPACE + w for w in new])):
            self.words.put(word, chunk)

    @cached_property
    def word_ids(self) -> Bounded:
        """Packed ids of words, without their sizes and texts."""
        return Bounded(lambda word: self._packed([SPACE + word])[0], ID_ENTRIES)

    @cached_property
    def run_ids(self) -> Bounded:
        return Bounded(lambda chunk: self._packed([chunk])[0], ID_ENTRIES // 10)

    def _packed(self, chunks: list[str]) -> list[bytes]:
        return [np.array(ids, np.int32).tobytes() for ids in self.model.encode(chunks, num_threads=1)]

    def ids(self, plain: list[str]) -> list[bytes]:
        """Packed ids of several normalised texts, whose new words are encoded in one call."""
        if not self.apart:
            return self._packed(plain)
        new = sorted({w for p in plain for w in p.split(SPACE) if w and not self.word_ids.known(w)})
        for at in range(0, len(new), ID_ENTRIES):
            for word, ids in zip(new[at : at + ID_ENTRIES], self._packed([SPACE + w for w in new[at : at + ID_ENTRIES]])):
                self.word_ids.put(word, ids)
        return [b"".join(self._ids_of(p)) for p in plain]

    def _ids_of(self, plain: str) -> Iterable[bytes]:
        if not plain:
            return ()
        if plain[0] == SPACE and SPACE * 2 not in plain and len(plain) > 1 and plain[-1] != SPACE:
            return map(self.word_ids.__getitem__, plain[1:].split(SPACE))
        return map(self.run_ids.__getitem__, _RUNS.findall(plain))

    def spans(self, chunks: list[Chunk], source: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte and end in the original text of every piece."""
        ends = np.cumsum(np.frombuffer(b"".join([c.sizes for c in chunks]), np.int32))
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        return source[starts], source[ends]

    def decoded(self, chunks: list[Chunk]) -> str:
        """The text of the pieces, without the marker that the encoding put first."""
        whole = "".join([c.decoded for c in chunks])
        if self.normalizer.collapse:
            return whole.lstrip(" ")
        return whole[1:] if self.normalizer.prefix and whole[:1] == " " else whole


def _rows(df, model, id_col, text_col, schema, row):
    held = df.sparkSession.sparkContext.broadcast(Path(model).read_bytes())
    names = [f.split()[0] for f in schema.split(", ")]

    def work(batches):
        codec = PieceCodec(held.value)
        kinds = None
        for batch in batches:
            out = []
            column = batch.column(1)
            for at in range(0, len(column), 500):
                plain = [codec.normalizer.apply(t) for t in column.slice(at, 500).to_pylist()]
                codec.learn([p for p, _ in plain])
                out += [row(codec, p, s) for p, s in plain]
            if kinds is None:
                kinds = _KINDS[schema]
            columns = zip(*out) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(c), k) for c, k in zip(columns, kinds))], names
            )

    return by_batch(texts(df, id_col, text_col), work, schema)


_KINDS = {
    ENCODED: [pa.list_(pa.int32())] * 3 + [pa.string()],
    DIGESTS: [pa.int64(), pa.string(), pa.string(), pa.string()],
}


def _encoded(codec: PieceCodec, plain: str, source: np.ndarray):
    chunks = codec.chunks(plain)
    starts, ends = codec.spans(chunks, source) if chunks else ([], [])
    ids = np.frombuffer(b"".join([c.ids for c in chunks]), np.int32)
    return ids, np.asarray(starts, np.int32), np.asarray(ends, np.int32), codec.decoded(chunks)


def _digest(codec: PieceCodec, plain: str, source: np.ndarray):
    chunks = codec.chunks(plain)
    starts, ends = codec.spans(chunks, source) if chunks else (np.empty(0, np.int64),) * 2
    return (
        sum(len(c.ids) for c in chunks) // 4,
        hashlib.sha256(",".join([c.id_text for c in chunks]).encode()).hexdigest(),
        hashlib.sha256(codec.decoded(chunks).encode()).hexdigest(),
        hashlib.sha256(np.stack([starts, ends]).astype("<i4").tobytes()).hexdigest(),
    )


def encode(df: DataFrame, model: str | Path, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ids, the byte range in the original text of every piece, and the decoded text.

    Ids and decoded text are the library's, without begin or end ids. A character that
    falls back to bytes gives its range to the last of them; the others are empty there.
    The marker put before the first word has no source bytes.

    A null or empty text has no pieces and decodes to an empty text. Rows that repeat,
    also with one id or none, each give a row; an empty table gives none. Other columns
    are left behind.
    """
    return _rows(df, model, id_col, text_col, ENCODED, _encoded)


def digests(df: DataFrame, model: str | Path, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What `encode` gives as one short row per text: count, and SHA-256 of ids, decoded text and spans.

    Ids are hashed as decimal text joined by commas, the decoded text as UTF-8, spans as
    little-endian 32-bit starts followed by ends. Odd rows as in `encode`.
    """
    return _rows(df, model, id_col, text_col, DIGESTS, _digest)


def with_pieces(df: DataFrame, model: str | Path, text_col: str = "text") -> DataFrame:
    """The rows of df, all columns kept, with n_tokens and ids of the text (null: none of either).

    Columns of these names that df has already are replaced.
    """
    kept = df.drop("n_tokens", "ids")
    held = df.sparkSession.sparkContext.broadcast(Path(model).read_bytes())
    place = kept.columns.index(text_col)
    schema = StructType([*kept.schema.fields, StructField("n_tokens", LongType()), StructField("ids", ArrayType(IntegerType()))])

    def work(batches):
        codec = PieceCodec(held.value)
        for batch in batches:
            # Passed on in small parts, so that the ids of a large batch are never held together.
            for at, _, offsets in passes(batch.column(place).fill_null("")):
                part = batch.slice(at, len(offsets) - 1)
                plain = [codec.normalizer.apply(t)[0] for t in part.column(place).fill_null("").to_pylist()]
                ids = codec.ids(plain)
                count = np.array([len(x) // 4 for x in ids], np.int64)
                ends = pa.array(np.append(0, np.cumsum(count)).astype(np.int32))
                whole = pa.array(np.frombuffer(b"".join(ids), np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(count), pa.ListArray.from_arrays(ends, whole)], [*batch.schema.names, "n_tokens", "ids"]
                )

    return by_batch(kept, work, schema)
