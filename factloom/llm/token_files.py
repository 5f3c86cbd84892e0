"""Token ids as flat binary files with document offsets, and reading them back.

Each partition of documents, in ascending doc_id order, becomes three files in one
folder: ``part-N.bin`` (little-endian unsigned ids, 16 bits where the vocabulary fits),
``part-N.off`` (64-bit offsets into it, one more than documents) and ``part-N.doc``
(64-bit doc_ids). The ids of all partitions before N, its base, are a prefix sum over the
partitions' totals and lie in the table ``bases``. Readers map the files into memory and
add the base. The folder must be a file system that every executor mounts.

A task writes under a name of its own and renames at the end, so a task that runs again
leaves whole files. Partitions are ranges of doc_id of about equal bytes of text: bytes are
counted in cells between quantiles of doc_id and taken to be even within a cell. Rows
with one doc_id lie together, in the order of their text's hash, however many they are. A null
text is an empty one and has only the end id; rows with a null doc_id come before all others, in
the order of their text's hash and in files of their own; an empty table writes no files; other
columns of the input are not read.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm.store import new_path, partitions_for, stored

#: Words that a Python worker remembers.
CACHED = 700_000
#: Ids of one file.
IDS_PER_FILE = 64 << 20
#: Vocabulary files of up to this many ids use 16 bits.
NARROW = 1 << 16
#: Quantiles of doc_id between which bytes of text are counted.
CELLS = 4096
_ENDS = (".bin", ".off", ".doc")
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")


class WordTokenizer:
    """A tokenizer that drops white space, run on each distinct word of a batch.

    The tokenizer splits at white space before all else, so a text's ids are those of its
    words in turn. Printable ASCII words go to the library's model piece by piece, as its
    normalizer and splitter leave nothing else to do; all others take the library's whole way.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._whole.no_truncation()
        self._whole.no_padding()
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        self._special = [t["content"].encode() for t in parts["added_tokens"]]
        steps = [s["type"] for s in parts["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("not a tokenizer that drops white space and lower-cases")
        self.kind = "<u2" if self._whole.get_vocab_size() <= NARROW else "<u4"
        self._code = "H" if self.kind == "<u2" else "I"
        self._pieces: dict[str, bytes] = {}
        self._words: dict[bytes, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        ids = self._pieces.get(piece)
        if ids is None:
            if len(self._pieces) >= CACHED:
                self._pieces.clear()
            ids = self._pieces[piece] = array(self._code, [t.id for t in self._whole.model.tokenize(piece)]).tobytes()
        return ids

    def _remember(self, words: list[bytes]) -> None:
        other = []
        for word in words:
            if word.isalpha():  # ASCII letters are one piece, whose ids words may share
                self._words[word] = self._piece(word.lower().decode())
                continue
            text = word.decode()
            if text.isascii() and text.isprintable() and (b"<" not in word or not any(s in word for s in self._special)):
                self._words[word] = b"".join([self._piece(p) for p in _PIECE.findall(text.lower())])
            else:
                other.append(text)
        for text, found in zip(other, self._whole.encode_batch_fast(other, add_special_tokens=False), strict=True):
            self._words[text.encode()] = array(self._code, found.ids).tobytes()

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text, as bytes of ``kind``."""
        for at in range(0, len(texts), 4096):
            yield from self._encode(pc.fill_null(texts.slice(at, 4096).cast(pa.large_string()), ""))

    def _encode(self, texts: pa.Array) -> Iterator[bytes]:
        split = pc.ascii_split_whitespace(texts)
        listed = pc.list_flatten(split).dictionary_encode()
        words = listed.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        if len(self._words) >= CACHED:
            self._words.clear()
        self._remember([w for w in words if w and w not in self._words])
        ids = [self._words[w] if w else b"" for w in words]
        width = np.dtype(self.kind).itemsize
        flat = np.frombuffer(b"".join(ids), self.kind)
        counts = np.array([len(x) for x in ids], np.int64) // width
        index = listed.indices.to_numpy()
        each = counts[index]
        ends = np.r_[0, np.cumsum(each)]
        first = (np.cumsum(counts) - counts)[index]
        out = flat[np.repeat(first - ends[:-1], each) + np.arange(ends[-1])].tobytes() if len(index) else b""
        cuts = (ends[split.offsets.to_numpy()] * width).tolist()
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            yield out[start:end]


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def encoded(docs: DataFrame, path: str, end_id: int, bounds: list[int], nameless: int = 1) -> DataFrame:
    """(part, doc_id, order, n, kind, ids): each text's ids with ``end_id`` after them, as bytes.

    ``part`` is the number of ``bounds`` up to doc_id. Rows without one have the ``nameless``
    parts below 0, by ranges of their text's hash.
    """
    limits = np.array(bounds, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        end = np.array([end_id], tokenizer.kind).tobytes()
        width = len(end)
        for batch in batches:
            numbers = pc.fill_null(batch.column("doc_id"), 0).to_numpy()
            parts = np.searchsorted(limits, numbers, side="right")
            none = ~pc.is_valid(batch.column("doc_id")).to_numpy(zero_copy_only=False)
            share = batch.column("order").to_numpy()[none] / 2.0**64 + 0.5
            parts[none] = np.minimum(share * nameless, nameless - 1).astype(np.int64) - nameless
            ids = [x + end for x in tokenizer.encode(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.int64()), batch.column("doc_id"), batch.column("order"),
                 pa.array([len(x) // width for x in ids], pa.int64()),
                 pa.array([tokenizer.kind] * len(ids)), pa.array(ids, pa.binary())],
                ["part", "doc_id", "order", "n", "kind", "ids"])

    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("order"), "text")
    return rows.mapInArrow(run, "part long, doc_id long, order long, n long, kind string, ids binary")


def local_folder(path: str) -> str:
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"{path}: memory-mapped files need a mounted file system")
    return parts.path


class _Files:
    """The three files of one part, under names of their own until they are whole."""

    def __init__(self, place: str, part: int) -> None:
        self.part, self.name = part, f"part-{part:06d}" if part >= 0 else f"part-none-{-part:06d}"
        self._place, self._own = place, f"{place}/.{self.name}-{uuid.uuid4().hex}"
        os.makedirs(place, exist_ok=True)
        self._ids, self._offsets, self._docs = (open(self._own + end, "wb") for end in _ENDS)  # noqa: SIM115
        self._offsets.write(np.zeros(1, "<i8").tobytes())
        self.docs = self.ids = 0
        self.kind = ""

    def add(self, rows: pa.RecordBatch) -> None:
        counts = rows.column("n").to_numpy()
        self._offsets.write((self.ids + np.cumsum(counts)).astype("<i8").tobytes())
        self._docs.write(pc.fill_null(rows.column("doc_id"), 0).to_numpy().astype("<i8").tobytes())
        for value in rows.column("ids"):
            self._ids.write(value.as_buffer())
        self.docs += rows.num_rows
        self.ids += int(counts.sum())
        self.kind = rows.column("kind")[0].as_py()

    def done(self) -> pa.RecordBatch:
        for file, end in zip((self._ids, self._offsets, self._docs), _ENDS, strict=True):
            file.close()
            os.replace(self._own + end, f"{self._place}/{self.name}{end}")
        return pa.RecordBatch.from_pydict(
            {"part": [self.part], "docs": [self.docs], "ids": [self.ids], "kind": [self.kind], "name": [self.name]})


def _writing(place: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = None
        for batch in batches:
            parts = batch.column("part").to_numpy()
            cuts = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1], True]) if len(parts) else np.zeros(1, np.int64)
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if files is None or files.part != parts[a]:
                    if files is not None:
                        yield files.done()
                    files = _Files(place, int(parts[a]))
                files.add(batch.slice(a, b - a))
        if files is not None:
            yield files.done()

    return run


def cells(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most CELLS quantiles of doc_id, and the bytes of text without a doc_id, then up to each quantile from the one before."""
    shares = [n / CELLS for n in range(CELLS + 1)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 10 * CELLS)).first()[0]
    limits = np.array(sorted(set(found or [])), np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(limits) + 1, np.int64)
        for batch in batches:
            numbers = pc.fill_null(batch.column(0), 0).to_numpy()
            cell = np.minimum(np.searchsorted(limits, numbers) + 1, len(limits))
            cell[~pc.is_valid(batch.column(0)).to_numpy(zero_copy_only=False)] = 0
            np.add.at(sums, cell, pc.fill_null(batch.column(1), 0).to_numpy())
        kept = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(kept, pa.int64()), "bytes": pa.array(sums[kept], pa.int64())})

    rows = docs.select("doc_id", F.octet_length("text").cast("long")).mapInArrow(count, "cell long, bytes long")
    sizes = np.zeros(len(limits) + 1, np.int64)
    for r in rows.groupBy("cell").agg(F.sum("bytes").alias("bytes")).collect():  # at most CELLS + 1 rows
        sizes[r["cell"]] = r["bytes"]
    return limits, sizes


def even_bounds(limits: np.ndarray, sizes: np.ndarray, each: int) -> list[int]:
    """The doc_ids at which ranges of about ``each`` bytes begin."""
    if not len(limits):
        return []
    ends, bounds, cell = np.cumsum(sizes).tolist(), set(), 0
    for at in range(each, ends[-1], each):
        while ends[cell] <= at:
            cell += 1
        before, low = (ends[cell - 1], int(limits[cell - 1])) if cell else (0, int(limits[0]) - 1)
        bounds.add(low + 1 + (int(limits[cell]) - low) * (at - before) // (ends[cell] - before))
    return sorted(b for b in bounds if b > limits[0])


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int) -> DataFrame:
    """Writes the files; returns the table (part, docs, ids, base, kind, name)."""
    place = local_folder(folder)
    limits, sizes = cells(docs)
    total = int(sizes.sum())
    # an id stands for some two bytes of text or more
    files = max(partitions_for(total, 2 * IDS_PER_FILE), min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), partitions_for(total, 1 << 22)))
    each = max(1, total // files)
    bounds, nameless = even_bounds(limits, sizes[1:], each), partitions_for(int(sizes[0]), each)
    rows = encoded(docs, path, end_id, bounds, nameless)
    placed = rows.repartitionById(len(bounds) + 1 + nameless, (F.col("part") + nameless).cast("int"))
    ordered = placed.sortWithinPartitions("part", "doc_id", "order")
    parts = stored(ordered.mapInArrow(_writing(place), "part long, docs long, ids long, kind string, name string"), "token-parts")
    # one row for each file
    return parts.selectExpr("part", "docs", "ids", "sum(ids) OVER (ORDER BY part) - ids AS base", "kind", "name")


def read_token_files(bases: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the mapped files."""
    place = local_folder(folder)

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in parts:
            for r in rows.itertuples():
                ids = np.memmap(f"{place}/{r.name}.bin", r.kind, "r")
                offsets = np.memmap(f"{place}/{r.name}.off", "<i8", "r")
                doc_ids = np.memmap(f"{place}/{r.name}.doc", "<i8", "r")
                for at in range(0, len(doc_ids), 10_000):
                    cut = offsets[at : at + 10_001]
                    sums = [zlib.crc32(ids[i:j].astype("<u4").tobytes()) for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
                    ids_of = pd.array(doc_ids[at : at + 10_000], "Int64")
                    if r.part < 0:
                        ids_of[:] = pd.NA
                    yield pd.DataFrame({"doc_id": ids_of, "start": cut[:-1] + r.base,
                                        "n_tokens": np.diff(cut), "ids_crc32": np.array(sums, np.int64)})

    n = int(bases.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = bases.repartitionById(n, F.pmod("part", F.lit(n)).cast("int"))
    return spread.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def new_folder(spark: SparkSession) -> str:
    return new_path(spark, "token-files")
