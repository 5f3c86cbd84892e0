"""Duplicate passages across documents, found by FM-indexes over shards of passages.

A window is ``WINDOW`` consecutive words. Of the word grams of a window, the one with the
least hash is its anchor, so equal windows have equal anchors. The job:

1. Anchors of all documents meet by hash. An anchor that only one document has cannot lie
   in a shared window and is dropped. Occurrences travel packed by chunk of documents, and a
   gram that several documents of a chunk share is sent once, so frequent ones are no hot key.
2. Documents cut out the windows around the anchors that are left: runs of windows with
   one anchor are a segment of words. Segments go to the shard of their anchor, each
   distinct one of a group of documents once, with its smallest doc_id. Windows of very
   frequent anchors go one by one, to shards by the whole window.
3. Each shard builds an FM-index of its distinct segments. Their windows are streamed
   through it by backward search; where all words match in more than one place, the
   smallest doc_id of these places is the window's first document.
4. The answers return to the documents' groups, and a word goes if a window over it has
   a first document smaller than its own.

Words are compared as text in the index; hashes only choose where windows meet. Words are
``[^\\x20\\x09-\\x0D]+``, unchanged. A null text has no words. A row with a null doc_id
is compared with none and keeps all; rows of one doc_id are not smaller than each other;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.llm.fm_index import FMIndex
from factloom.llm.store import partitions_for, stored

WINDOW = 13
GRAM = 4
_SPAN = WINDOW - GRAM + 1  # grams of a window
CHUNK_BYTES = 3 << 20
#: Text for one bucket of anchors, one group of documents, one shard of segments.
BUCKET_BYTES, GROUP_BYTES, SHARD_BYTES = 48 << 20, 6 << 20, 12 << 20
#: Anchors with more occurrences have their windows dealt one by one. There are at most
#: as many of these as MOST_HOT, which bounds what is broadcast.
HOT, MOST_HOT = 20_000, 1_000_000
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_KEPT = "input_"


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words, the words of all texts as places in them, and each text's first."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    listed = pc.list_flatten(split).dictionary_encode()
    codes, words = listed.indices.to_numpy().astype(np.int64), listed.dictionary
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)[codes] if len(codes) else np.zeros(0, bool)
    ends = np.r_[0, np.cumsum(real)][split.offsets.to_numpy()]
    return words, codes[real], ends


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MULTIPLY
    return h ^ (h >> np.uint64(29))


def _anchors(hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows' starts, the place of each one's anchor, and the hashes of all grams."""
    n = len(hashes) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    gram = hashes[: len(hashes) - GRAM + 1].copy()
    for k in range(1, GRAM):
        gram = gram * _MULTIPLY + hashes[k : k + len(gram)]
    gram = _mixed(gram)
    least = gram[:n].copy()
    for j in range(1, _SPAN):
        np.minimum(least, gram[j : j + n], out=least)
    offset = np.zeros(n, np.int64)
    for j in range(_SPAN - 1, -1, -1):
        offset[gram[j : j + n] == least] = j
    starts = np.arange(n)
    row = np.searchsorted(ends[1:], starts, side="right")
    inside = starts + WINDOW <= ends[1:][row]
    starts = starts[inside]
    return starts, starts + offset[inside], gram


def _hashes(words: pa.Array) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w) for w in words.cast(pa.large_binary()).to_pylist()], np.uint64)


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as bytes."""
    body = b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return pa.compress(body, codec="zstd", asbytes=True) if body else b""


def _unpacked(data: bytes, n: int, *kinds: str) -> list[np.ndarray]:
    sizes = [n * np.dtype(k).itemsize for k in kinds]
    body = pa.decompress(data, sum(sizes), codec="zstd", asbytes=True) if n else b""
    cuts = np.r_[0, np.cumsum(sizes)]
    return [np.frombuffer(body[a:b], k) for a, b, k in zip(cuts[:-1], cuts[1:], kinds, strict=True)]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut to about CHUNK_BYTES of text."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy().astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, before + CHUNK_BYTES, side="right")))
            yield batch.slice(at, end - at)
            at = end


_PLACES = "key long, n long, data binary"


def _out(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.Table:
    return pa.table({c: pa.array([r[i] for r in rows], k) for i, (c, k) in enumerate(zip(names, kinds, strict=True))})


def _places(row: np.ndarray, pos: np.ndarray, groups: int) -> Iterator[tuple[int, int, bytes]]:
    """Anchors' places, packed for each group of documents; keys of groups are negative."""
    group = (row.view(np.uint64) % np.uint64(groups)).astype(np.int64)
    order = np.lexsort((pos, row, group))
    group, row, pos = group[order], row[order], pos[order]
    cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True]) if len(group) else np.zeros(1, np.int64)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield -1 - int(group[a]), b - a, _packed(row[a:b], pos[a:b])


def _send_anchors(buckets: int, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            words, codes, ends = _words(batch.column("text"))
            starts, places, gram = _anchors(_hashes(words)[codes], ends)
            if not len(starts):
                continue
            places = places[np.r_[True, places[1:] != places[:-1]]]
            of = np.searchsorted(ends[1:], places, side="right")
            row = batch.column("row").to_numpy()[of]
            pos = (places - ends[of]).astype(np.int32)
            key = gram[places]
            order = np.argsort(key, kind="stable")
            key, row, pos = key[order], row[order], pos[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            count = np.diff(np.r_[first, len(key)])
            shared = np.minimum.reduceat(row, first) != np.maximum.reduceat(row, first)
            everywhere = np.repeat(shared, count)
            rows = list(_places(row[everywhere], pos[everywhere], groups))
            send = ~everywhere
            send[first[shared]] = True  # one for all of this chunk
            weight = np.ones(len(key), np.int32)
            weight[first[shared]] = -count[shared]
            key, row, pos, weight = key[send], row[send], pos[send], weight[send]
            bucket = ((key >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((pos, row, bucket))
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in range(buckets):
                at = order[cuts[b] : cuts[b + 1]]
                if len(at):
                    ids, index = np.unique(row[at], return_inverse=True)
                    body = _packed(key[at].astype(np.uint32), weight[at], pos[at], index.astype(np.int32))
                    rows.append((b, len(at), len(ids).to_bytes(8, "little") + ids.tobytes() + body))
            yield from _out(rows, ["key", "n", "data"], [pa.int64(), pa.int64(), pa.binary()]).to_batches()

    return run


def _shared_anchors(groups: int, hot: int):
    """Of one bucket's anchors, the places of those in several documents; very frequent ones as key ``groups``."""

    def run(table: pa.Table) -> pa.Table:
        names, kinds = ["key", "n", "data"], [pa.int64(), pa.int64(), pa.binary()]
        if not table.num_rows or table["key"][0].as_py() < 0:
            return table.select(names)
        parts = []
        for n, data in zip(table["n"].to_pylist(), table["data"].to_pylist(), strict=True):
            size = int.from_bytes(data[:8], "little")
            ids = np.frombuffer(data[8 : 8 + 8 * size], np.int64)
            key, weight, pos, index = _unpacked(data[8 + 8 * size :], n, "u4", "i4", "i4", "i4")
            parts.append((key, weight, pos, ids[index]))
        key, weight, pos, row = (np.concatenate([p[k] for p in parts]) for k in range(4))
        order = np.argsort(key, kind="stable")
        key, weight, pos, row = key[order], weight[order], pos[order], row[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        count = np.diff(np.r_[first, len(key)])
        shared = (np.minimum.reduceat(row, first) != np.maximum.reduceat(row, first)) | (np.minimum.reduceat(weight, first) < 0)
        total = np.add.reduceat(np.abs(weight.astype(np.int64)), first)
        keep = np.repeat(shared, count) & (weight > 0)
        rows = list(_places(row[keep], pos[keep], groups))
        frequent = key[first[shared & (total > hot)]].astype(np.int64) | (table["key"][0].as_py() << 32)
        if len(frequent):
            rows.append((groups, len(frequent), _packed(frequent)))
        return _out(rows, names, kinds)

    return run


_REQUEST = "group long, shard long, n long, size long, words binary, first binary, m long, where binary"
_REQUEST_NAMES = ["group", "shard", "n", "size", "words", "first", "m", "where"]
_REQUEST_KINDS = [*[pa.int64()] * 4, pa.binary(), pa.binary(), pa.int64(), pa.binary()]


def _cut_segments(buckets: int, shards: int, hot: np.ndarray):
    """Segments of a group's documents, distinct for each shard, and where they are."""

    def run(docs: pa.Table, places: pa.Table) -> pa.Table:
        empty = _out([], _REQUEST_NAMES, _REQUEST_KINDS)
        if not docs.num_rows or not places.num_rows:
            return empty
        found = [_unpacked(d, n, "i8", "i4") for n, d in zip(places["n"].to_pylist(), places["data"].to_pylist(), strict=True)]
        at_row, at_pos = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        order = np.lexsort((at_pos, at_row))
        at_row, at_pos = at_row[order], at_pos[order].astype(np.int64)
        docs = docs.filter(pc.is_in(docs["row"], pa.array(np.unique(at_row)))).combine_chunks()
        group, rows = docs["group"][0].as_py() if docs.num_rows else 0, []
        for batch in _slices(docs.to_batches()):
            words, codes, ends = _words(batch.column("text"))
            starts, anchors, gram = _anchors(_hashes(words)[codes], ends)
            if not len(starts):
                continue
            row_ids, doc_ids = batch.column("row").to_numpy(), batch.column("doc_id").to_numpy()
            of = np.searchsorted(ends[1:], starts, side="right")
            # the windows whose anchor is among the places found
            wanted = np.zeros(len(codes), bool)
            for i, r in enumerate(row_ids.tolist()):
                a, b = np.searchsorted(at_row, [r, r + 1])
                spots = ends[i] + at_pos[a:b]
                wanted[spots[spots < ends[i + 1]]] = True
            keep = wanted[anchors]
            starts, anchors, of = starts[keep], anchors[keep], of[keep]
            if not len(starts):
                continue
            key = gram[anchors]
            address = ((key >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64) << 32 | (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
            alone = np.isin(address, hot)
            new = np.r_[True, (anchors[1:] != anchors[:-1]) | (starts[1:] != starts[:-1] + 1)] | alone
            begin = np.flatnonzero(new)
            count = np.diff(np.r_[begin, len(starts)])
            seg_start, seg_words = starts[begin], count + WINDOW - 1
            target = key[begin]
            if alone.any():
                whole = np.zeros(len(begin), np.uint64)
                h = _hashes(words)
                for k in range(WINDOW):
                    whole = whole * _MULTIPLY + h[codes[seg_start + k]]
                target = np.where(alone[begin], _mixed(whole), target)
            shard = (_mixed(target) % np.uint64(shards)).astype(np.int64)
            texts = words.to_pylist()
            listed = codes.tolist()
            for s in np.unique(shard).tolist():
                mine = np.flatnonzero(shard == s)
                distinct: dict[str, int] = {}
                which = np.empty(len(mine), np.int32)
                for i, (a, n) in enumerate(zip(seg_start[mine].tolist(), seg_words[mine].tolist(), strict=True)):
                    which[i] = distinct.setdefault(" ".join([texts[c] for c in listed[a : a + n]]), len(distinct))
                least = np.full(len(distinct), np.iinfo(np.int64).max)
                segment_of = of[begin[mine]]
                np.minimum.at(least, which, doc_ids[segment_of])
                body = "\n".join(distinct).encode()
                where = _packed(row_ids[segment_of], doc_ids[segment_of], (seg_start[mine] - ends[segment_of]).astype(np.int32), which)
                rows.append((group, s, len(distinct), len(body), pa.compress(body, codec="zstd", asbytes=True), _packed(least), len(mine), where))
        return _out(rows, _REQUEST_NAMES, _REQUEST_KINDS)

    return run


def _search_shard(table: pa.Table) -> pa.Table:
    """For each request of one shard, the first document of every window of its segments, in order."""
    kinds = [*[pa.int64()] * 3, pa.binary()]
    segments: list[str] = []
    least: list[np.ndarray] = []
    for n, size, data, first in zip(*(table[c].to_pylist() for c in ("n", "size", "words", "first")), strict=True):
        segments += pa.decompress(data, size, codec="zstd", asbytes=True).decode().split("\n")
        least += _unpacked(first, n, "i8")
    if not segments:
        return _out([], ["request", "shard", "windows", "answer"], kinds)
    coded = pa.array(segments, pa.large_string()).dictionary_encode()
    which = coded.indices.to_numpy()
    own = np.full(len(coded.dictionary), np.iinfo(np.int64).max)
    np.minimum.at(own, which, np.concatenate(least))
    _, codes, ends = _words(coded.dictionary)
    lengths = np.diff(ends)
    # the text of the index: segments with a separator after each
    text = np.zeros(len(codes) + len(lengths), np.int32)
    of = np.repeat(np.arange(len(lengths)), lengths)
    text[np.arange(len(codes)) + of] = np.unique(codes, return_inverse=True)[1] + 1
    begins = ends[:-1] + np.arange(len(lengths))
    index = FMIndex(text, WINDOW)
    segment_at = np.repeat(np.arange(len(lengths)), lengths + 1)
    in_order = own[segment_at[index.places]]
    windows = lengths - WINDOW + 1
    base = np.r_[0, np.cumsum(windows)]
    starts = np.repeat(begins - base[:-1], windows) + np.arange(base[-1])
    answer = np.repeat(own, windows)
    for at in range(0, len(starts), 1 << 17):
        matched, low, high = index.matching(text, starts[at : at + (1 << 17)], WINDOW)
        full = np.flatnonzero(matched == WINDOW)
        if len(full):
            bounds, back = np.unique(np.stack([low[full], high[full]], 1), axis=0, return_inverse=True)
            flat = np.minimum(bounds.ravel(), len(in_order) - 1)
            mins = np.minimum.reduceat(in_order, flat)[::2]
            last = bounds[:, 1] == len(in_order)
            for k in np.flatnonzero(last):
                mins[k] = in_order[bounds[k, 0] :].min()
            answer[at + full] = mins[back.ravel()]
    rows, at = [], 0
    for request, n in zip(table["request"].to_pylist(), table["n"].to_pylist(), strict=True):
        mine = which[at : at + n]
        at += n
        part = np.concatenate([answer[base[s] : base[s + 1]] for s in mine.tolist()])
        counts = windows[mine].astype(np.int32)
        body = _packed(part)
        rows.append((request, table["shard"][0].as_py(), len(part), len(body).to_bytes(8, "little") + body + _packed(counts)))
    return _out(rows, ["request", "shard", "windows", "answer"], kinds)


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the places of each request, the windows with a smaller first document, as ranges of words."""
    for batch in batches:
        rows = []
        for group, n, m, where, windows, answer in zip(*(batch.column(c).to_pylist() for c in ("group", "n", "m", "where", "windows", "answer")), strict=True):
            row, doc, start, which = _unpacked(where, m, "i8", "i8", "i4", "i4")
            size = int.from_bytes(answer[:8], "little")
            (first,) = _unpacked(answer[8 : 8 + size], windows, "i8")
            (counts,) = _unpacked(answer[8 + size :], n, "i4")
            base = np.r_[0, np.cumsum(counts)]
            each = counts[which]
            place = np.repeat(np.arange(m), each)
            inner = np.arange(len(place)) - np.repeat(np.cumsum(each) - each, each)
            hit = first[base[which[place]] + inner] < doc[place]
            place, inner = place[hit], inner[hit]
            if len(place):
                rows.append((group, len(place), _packed(row[place], (start[place] + inner).astype(np.int32))))
        if rows:
            yield from _out(rows, ["group", "n", "data"], [pa.int64(), pa.int64(), pa.binary()]).to_batches()


def _removed(keep_text: bool, keep: list[str]):
    """Documents of one group without their covered words, and the columns that ride along."""

    def run(docs: pa.Table, places: pa.Table) -> pa.Table:
        found = [_unpacked(d, n, "i8", "i4") for n, d in zip(places["n"].to_pylist(), places["data"].to_pylist(), strict=True)]
        row, pos = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, t) for k, t in ((0, np.int64), (1, np.int32)))
        order = np.lexsort((pos, row))
        row, pos = row[order], pos[order]
        keys = docs["row"].to_numpy()
        lows, highs = np.searchsorted(row, keys), np.searchsorted(row, keys, side="right")
        rows = []
        for doc_id, text, a, b in zip(docs["doc_id"].to_pylist(), docs["text"], lows.tolist(), highs.tolist(), strict=True):
            value = text.as_py()
            words = (value or "").encode().split()
            gone = 0
            if b > a and doc_id is not None:
                change = np.zeros(len(words) + 1, np.int32)
                np.add.at(change, pos[a:b], 1)
                np.add.at(change, pos[a:b] + WINDOW, -1)
                kept_at = np.cumsum(change[:-1]) == 0
                gone = len(words) - int(kept_at.sum())
                kept = b" ".join([words[i] for i in np.flatnonzero(kept_at).tolist()])
            else:
                kept = b" ".join(words)
            rows.append((doc_id, len(words) , gone, hashlib.sha256(kept).hexdigest(), kept.decode() if gone else value))
        names, kinds = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"], [*[pa.int64()] * 3, pa.string(), pa.string()]
        if not keep_text:
            names = names[:4]
        out = _out(rows, names, kinds[: len(names)])
        for c in keep:
            out = out.append_column(f"{_KEPT}{c}", docs[f"{_KEPT}{c}"])
        return out

    return run


def remove_repeats(docs: DataFrame, keep_text: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for each row; with ``keep_text`` also ``kept``.

    ``kept`` is the text as it was if nothing is removed, else the kept words joined by a space.
    Columns named in ``keep`` come along with their own row, as ``input_`` and their name.
    """
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets, groups, shards = (partitions_for(size, each) for each in (BUCKET_BYTES, GROUP_BYTES, SHARD_BYTES))
    frequent = max(HOT, size // 6 // MOST_HOT)
    carried = [F.col(f"`{c}`").alias(f"{_KEPT}{c}") for c in keep]
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("row"), *carried)
    keyed = rows.select("doc_id", "text", "row")
    # Python's % on the unsigned row, in SQL
    group = F.pmod(F.pmod(F.shiftrightunsigned("row", 1), F.lit(groups)) * 2 + F.col("row").bitwiseAND(F.lit(1)), F.lit(groups)).alias("group")
    grouped = keyed.select("*", group)
    names = ["key", "n", "data"]
    anchors = keyed.where("doc_id IS NOT NULL").mapInArrow(_send_anchors(buckets, groups), _PLACES)
    places = stored(anchors.groupBy("key").applyInArrow(_shared_anchors(groups, frequent), _PLACES), "anchors")
    hot_rows = places.where(F.col("key") == groups).select(*names).collect()  # at most MOST_HOT numbers
    hot = np.concatenate([_unpacked(bytes(r["data"]), r["n"], "i8")[0] for r in hot_rows]) if hot_rows else np.zeros(0, np.int64)
    near = places.where("key < 0").select((-1 - F.col("key")).alias("group"), "n", "data")
    cut = (
        grouped.where("doc_id IS NOT NULL").groupBy("group").cogroup(near.groupBy("group"))
        .applyInArrow(_cut_segments(buckets, shards, hot), _REQUEST)
    )
    requests = stored(cut.withColumn("request", F.monotonically_increasing_id()), "requests")
    answers = (
        requests.select("request", "shard", "n", "size", "words", "first").groupBy("shard")
        .applyInArrow(_search_shard, "request long, shard long, windows long, answer binary")
    )
    covered = stored(
        requests.select("request", "group", "n", "m", "where").join(answers.drop("shard"), "request")
        .mapInArrow(_covered, "group long, n long, data binary"), "covered")
    schema = T.StructType.fromDDL("doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept string" if keep_text else ""))
    for c in keep:
        schema.add(f"{_KEPT}{c}", docs.schema[c].dataType)
    return rows.select("*", group).groupBy("group").cogroup(covered.groupBy("group")).applyInArrow(_removed(keep_text, list(keep)), schema)
