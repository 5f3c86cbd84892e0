"""Fill-in-middle transformation over seekable compressed frames.

A text is stored as independent zstandard frames of at most ``FRAME_UNITS`` units each, with
the numbers of units and of characters before every frame. A cut after some unit is found by
bisection in these numbers, and only the frame that holds it is decompressed. The output is
never put together to be digested: its parts stream frame by frame, in the order of the form,
into the digest and into frames of their own, from which the text is rebuilt and digested by
another stream. So a task holds one frame of text at a time beside the compressed ones.

A unit is ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``. The choice of cuts and
form hangs on the seed and doc_id alone. A null text is empty and an empty text stays plain; so
does one that holds a marker. A null doc_id counts as an empty one. Rows repeated with one
doc_id are cut alike if their texts are equal; other columns are not read; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import accumulate, islice

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from factloom.llm.store import stored

#: Units of a frame of text; characters of a frame of output.
FRAME_UNITS, FRAME_CHARS = 4096, 1 << 15
# The markers before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_UNIT = r"(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)"
_UNITS, _FRAME = re.compile(_UNIT), re.compile(_UNIT + "{1,%d}+" % FRAME_UNITS)
_FRAMES = pa.list_(pa.struct([("unit", pa.int64()), ("char", pa.int64()), ("data", pa.binary())]))
STORED = "doc_id long, n long, n_chars long, marked boolean, frames array<struct<unit:long,char:long,data:binary>>"


class Frames:
    """A text in compressed frames: ``units`` and ``chars`` stand before each frame, the totals last."""

    def __init__(self, data: list[bytes], units: list[int], chars: list[int]) -> None:
        self.data, self.units, self.chars = data, units, chars
        self._open: tuple[int, str] = (-1, "")

    @classmethod
    def of_text(cls, text: str, press: zstandard.ZstdCompressor) -> Frames:
        """Frames of whole units."""
        pieces = [m[0] for m in _FRAME.finditer(text)]
        sizes = [FRAME_UNITS] * (len(pieces) - 1) + [len(_UNITS.findall(p)) for p in pieces[-1:]]
        return cls([press.compress(p.encode()) for p in pieces], [0, *accumulate(sizes)], [0, *accumulate(map(len, pieces))])

    @classmethod
    def of_stream(cls, chunks: Iterable[str], press: zstandard.ZstdCompressor) -> Frames:
        """Frames of some ``FRAME_CHARS`` characters; their units are not counted."""
        data, sizes, held, size = [], [], [], 0
        for chunk in chunks:
            held.append(chunk)
            size += len(chunk)
            if size >= FRAME_CHARS:
                data.append(press.compress("".join(held).encode()))
                sizes.append(size)
                held, size = [], 0
        if size:
            data.append(press.compress("".join(held).encode()))
            sizes.append(size)
        return cls(data, [0] * (len(data) + 1), [0, *accumulate(sizes)])

    def frame(self, n: int) -> str:
        if self._open[0] != n:
            self._open = n, zstandard.decompress(self.data[n]).decode()
        return self._open[1]

    def char_of_unit(self, unit: int) -> int:
        """How many characters the first ``unit`` units have."""
        n = bisect_right(self.units, unit) - 1
        inside = unit - self.units[n]
        if not inside:
            return self.chars[n]
        return self.chars[n] + next(islice(_UNITS.finditer(self.frame(n)), inside - 1, inside)).end()

    def read(self, start: int, end: int) -> Iterator[str]:
        """The characters from ``start`` to ``end``, frame by frame."""
        n = bisect_right(self.chars, start) - 1
        while n < len(self.data) and self.chars[n] < end:
            base = self.chars[n]
            yield self.frame(n)[max(start - base, 0) : end - base]
            n += 1

    def find(self, marker: str, start: int) -> int:
        """Where ``marker`` first stands at or after ``start``."""
        tail, at = "", start
        for chunk in self.read(start, self.chars[-1]):
            found = (tail + chunk).find(marker)
            if found >= 0:
                return at - len(tail) + found
            at += len(chunk)
            tail = (tail + chunk)[1 - len(marker) :]
        raise ValueError(f"{marker} is not in the text")


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers of 32 bits that the seed and the id decide."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def plan(text: Frames, marked: bool, doc_id: int | None, seed: int, rate: int, suffix_first: int) -> tuple[str, int, int]:
    """The form, and the characters before the end of prefix and of middle."""
    h = draws(doc_id, seed)
    if not text.data or marked or h[2] % 100 >= rate:
        return "plain", 0, 0
    n = text.units[-1]
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    return "spm" if h[3] % 100 < suffix_first else "psm", text.char_of_unit(first), text.char_of_unit(second)


def output(text: Frames, form: str, first: int, second: int) -> Iterator[str]:
    """The transformed text as a stream."""
    end = text.chars[-1]
    if form == "plain":
        yield from text.read(0, end)
        return
    parts = [(PREFIX, 0, first), (SUFFIX, second, end)]
    for marker, a, b in (parts if form == "psm" else parts[::-1]) + [(MIDDLE, first, second)]:
        yield marker
        yield from text.read(a, b)


def restored(out: Frames, form: str) -> Iterator[str]:
    """The text again, from an output and its form alone."""
    end = out.chars[-1]
    if form == "plain":
        yield from out.read(0, end)
        return
    between = out.find(SUFFIX if form == "psm" else PREFIX, 3)
    middle = out.find(MIDDLE, between + 3)
    parts = [(3, between), (between + 3, middle)]
    prefix, suffix = parts if form == "psm" else parts[::-1]
    for a, b in (prefix, (middle + 3, end), suffix):
        yield from out.read(a, b)


def _digest(chunks: Iterable[str]) -> str:
    digest = hashlib.sha256()
    for chunk in chunks:
        digest.update(chunk.encode())
    return digest.hexdigest()


def store_frames(docs: DataFrame) -> DataFrame:
    """The texts as frames, one row for each row of ``docs``: a table that readers can seek in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            rows = []
            for value in batch.column("text"):
                text = value.as_py() or ""
                made = Frames.of_text(text, press)
                frames = [{"unit": u, "char": c, "data": d} for u, c, d in zip(made.units, made.chars, made.data, strict=False)]
                rows.append((made.units[-1], made.chars[-1], any(m in text for m in (PREFIX, SUFFIX, MIDDLE)), frames))
            kinds = (pa.int64(), pa.int64(), pa.bool_(), _FRAMES)
            made = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], ["doc_id", "n", "n_chars", "marked", "frames"])

    return docs.select("doc_id", "text").mapInArrow(run, STORED)


def transform(frames: DataFrame, seed: int = 42, rate: int = 50, suffix_first: int = 80, keep_output: bool = False) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) for each stored text.

    ``rate`` per cent of the documents are transformed, ``suffix_first`` per cent of these with the
    suffix first (``spm``), the others ``psm``. With ``keep_output`` the output is a column ``output``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            rows = []
            for doc_id, n, chars, marked, held in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "n_chars", "marked", "frames")), strict=True):
                text = Frames([f["data"] for f in held], [*(f["unit"] for f in held), n], [*(f["char"] for f in held), chars])
                form, first, second = plan(text, marked, doc_id, seed, rate, suffix_first)
                digest = _digest(output(text, form, first, second))
                out = Frames.of_stream(output(text, form, first, second), press)
                lengths = (None, None) if form == "plain" else (first, second - first)
                whole = "".join(out.read(0, out.chars[-1])) if keep_output else None
                rows.append((n, form, *lengths, digest, _digest(restored(out, form)), whole))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
            made = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made[: len(names) - 1]], names)

    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256", *(["output"] if keep_output else [])]
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    return frames.select("doc_id", "n", "n_chars", "marked", "frames").mapInArrow(run, schema + (", output string" if keep_output else ""))


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = 50, suffix_first: int = 80, keep_output: bool = False) -> DataFrame:
    """``transform`` over the stored frames of ``docs``."""
    return transform(stored(store_frames(docs), "frames"), seed, rate, suffix_first, keep_output)
