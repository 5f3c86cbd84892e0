"""Byte-level BPE as a bounded-lookahead streaming transducer, and its inverse.

The merge list fixes how far to the right a token can depend on what follows: a merge is
only stopped by an earlier one that takes the right part's end first, which in turn only
depends on still earlier ones. ``lookahead`` sums that chain for the whole list. A token
that ends more than that many bytes before the end of the buffer is stable and is emitted
at once, so the encoder's memory does not grow with the text or with a single word of it.

Text is split before the merges as the vocabulary's tokenizer does: contractions, runs of
letters, numbers or other signs with one leading space, and white space. The splitter is
streaming too: it holds back only a short tail of its input.

Decoding looks up each token's bytes and turns them into text with an incremental UTF-8
decoder; bytes that are no UTF-8 become U+FFFD.

A null text is an empty one; an empty text has no tokens; texts of any length are read
whole; repeated rows keep theirs; other columns of the input are not read.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: The tokenizer's split pattern. Fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SPLIT = regex.compile(PATTERN)
#: Pieces up to this many bytes are encoded in one go and remembered, up to CACHED of them.
WHOLE = 48
CACHED = 300_000
#: Characters that are split at a time.
STEP = 1 << 16
#: A piece of more characters is encoded as it comes.
LONGEST = 1 << 12


def byte_signs() -> dict[int, str]:
    """The printable sign that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {b: chr(b) for b in plain}
    rest = [b for b in range(256) if b not in signs]
    return signs | {b: chr(256 + n) for n, b in enumerate(rest)}


class Vocabulary:
    """Ids, merges and special tokens of a byte-level BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        of_sign = {s: b for b, s in byte_signs().items()}
        to_bytes = lambda token: bytes(of_sign[c] for c in token)
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.ids = {to_bytes(t): i for t, i in data["model"]["vocab"].items() if t not in self.special}
        self.token = {i: b for b, i in self.ids.items()} | {i: s.encode() for s, i in self.special.items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        merges = [(to_bytes(a), to_bytes(b)) for a, b in pairs]
        self.rank = {pair: n for n, pair in reversed(list(enumerate(merges)))}
        self.lookahead = sufficient_lookahead(merges)
        # the same merges on ids, sorted by pair: for many short pieces at once
        self._of_byte = np.array([self.ids.get(bytes([b]), 0) for b in range(256)], np.int64)
        pair = np.array([(self.ids[a] << 32) | self.ids[b] for a, b in self.rank], np.int64)
        order = np.argsort(pair)
        self._pairs = pair[order]
        self._ranks = np.array([*self.rank.values()], np.int64)[order]
        self._made = np.array([self.ids[a + b] for a, b in self.rank], np.int64)[order]
        if any(bytes([b]) not in self.ids for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")


    def short(self, pieces: list[bytes]) -> list[list[int]]:
        """``merged`` for many pieces of at most WHOLE bytes: one merge of each in every round."""
        out: list[list[int]] = [[]] * len(pieces)
        sizes = np.array([len(p) for p in pieces])
        none = len(self._ranks)
        for width in range(8, WHOLE + 8, 8):
            rows = np.flatnonzero((sizes > width - 8) & (sizes <= width))
            if not len(rows):
                continue
            raw = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in rows), np.uint8).reshape(-1, width)
            length = sizes[rows]
            ids = self._of_byte[raw]
            at = np.arange(width)
            rank = np.full(ids.shape, none)
            rank[:, :-1] = self._look_up(ids[:, :-1], ids[:, 1:])[0]
            rank[at[None, :] >= (length - 1)[:, None]] = none
            live = np.arange(len(rows))
            while len(live):
                first = rank[live].argmin(1)
                more = rank[live, first] < none
                live, first = live[more], first[more]
                if not len(live):
                    break
                ids[live, first] = self._look_up(ids[live, first], ids[live, first + 1])[1]
                move = np.minimum(at[None, :] + (at[None, :] > first[:, None]), width - 1)
                ids[live] = np.take_along_axis(ids[live], move, 1)
                ranks = np.take_along_axis(rank[live], np.minimum(at[None, :] + (at[None, :] >= first[:, None]), width - 1), 1)
                length[live] -= 1
                for spot in (first - 1, first):
                    ok = np.flatnonzero((spot >= 0) & (spot + 1 < length[live]))
                    ranks[ok, spot[ok]] = self._look_up(ids[live[ok], spot[ok]], ids[live[ok], spot[ok] + 1])[0]
                ranks[at[None, :] >= (length[live] - 1)[:, None]] = none
                rank[live] = ranks
            for i, row, n in zip(rows.tolist(), ids.tolist(), length.tolist(), strict=True):
                out[i] = row[:n]
        return out

    def _look_up(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each pair, or the number of ranks, and the id it makes."""
        pair = (a << 32) | b
        at = np.minimum(np.searchsorted(self._pairs, pair), len(self._pairs) - 1)
        return np.where(self._pairs[at] == pair, self._ranks[at], len(self._ranks)), self._made[at]


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes after a token's end that decide whether it stays.

    In the order of the list, ``reach[x]`` is how far beyond x an earlier merge with left
    part x may look. A merge (u, v) can be stopped by an earlier one whose left part is v
    or a part on the right edge of v, so it looks over v and as far as those do.
    """
    parts: dict[bytes, tuple[bytes, bytes]] = {}
    reach: dict[bytes, int] = {}
    most = 0
    for u, v in merges:
        edge, far = v, reach.get(v, 0)
        while edge in parts:
            edge = parts[edge][1]
            far = max(far, reach.get(edge, 0))
        reach[u] = max(reach.get(u, 0), len(v) + far)
        most = max(most, reach[u])
        parts.setdefault(u + v, (u, v))
    return most


def _short(parts: list[bytes], rank: dict[tuple[bytes, bytes], int]) -> list[bytes]:
    """``merged`` for a few parts."""
    get, none = rank.get, len(rank)
    while len(parts) > 1:
        ranks = [get(p, none) for p in zip(parts, parts[1:], strict=False)]
        best = min(ranks)
        if best == none:
            break
        i = ranks.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


def merged(piece: bytes, rank: dict[tuple[bytes, bytes], int]) -> list[bytes]:
    """The tokens of one piece: the earliest merge of the list first, of equal ones the leftmost."""
    parts: list[bytes | None] = [piece[i : i + 1] for i in range(len(piece))]
    n = len(parts)
    if n <= WHOLE:
        return _short(parts, rank)
    following, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = [(r, i) for i in range(n - 1) if (r := rank.get((parts[i], parts[i + 1]))) is not None]
    heapify(queue)
    while queue:
        r, i = heappop(queue)
        if parts[i] is None or (j := following[i]) >= n or rank.get((parts[i], parts[j])) != r:
            continue  # one of the two has been merged meanwhile
        parts[i] += parts[j]
        parts[j] = None
        following[i] = after = following[j]
        if after < n:
            before[after] = i
            if (r := rank.get((parts[i], parts[after]))) is not None:
                heappush(queue, (r, i))
        if (left := before[i]) >= 0 and (r := rank.get((parts[left], parts[i]))) is not None:
            heappush(queue, (r, left))
    return [p for p in parts if p is not None]


#: What a piece goes on with, by its last character.
_RUNS = [regex.compile(p) for p in (r"\s+", r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+")]


class Encoder:
    """A streaming encoder: ``feed`` text and take the ids that are stable, then ``finish``."""

    def __init__(self, vocabulary: Vocabulary, memory: dict[str, list[int]] | None = None) -> None:
        self.vocabulary = vocabulary
        self._memory = {} if memory is None else memory
        self._guard = max(map(len, vocabulary.special), default=1) - 1
        self._held = ""  # may still become a special token
        self._pending = ""  # not split into pieces yet
        self._run: regex.Pattern | None = None  # what a piece longer than LONGEST goes on with
        self._bytes = b""  # the unstable end of a long piece

    def feed(self, text: str) -> list[int]:
        out: list[int] = []
        self._held += text
        while found := min(((at, -len(s), s) for s in self.vocabulary.special if (at := self._held.find(s)) >= 0), default=None):
            at, _, special = found
            self._split(self._held[:at], True, out)
            out.append(self.vocabulary.special[special])
            self._held = self._held[at + len(special) :]
        safe = max(0, len(self._held) - self._guard)
        self._split(self._held[:safe], False, out)
        self._held = self._held[safe:]
        return out

    def all_of(self, pieces: list[str]) -> list[int]:
        """The ids of a whole text that is split already."""
        memory, out = self._memory, []
        for p in pieces:
            ids = memory.get(p)
            out += self._piece(p) if ids is None else ids
        return out

    def finish(self) -> list[int]:
        out: list[int] = []
        self._split(self._held, True, out)
        self._held = ""
        return out

    def _split(self, text: str, last: bool, out: list[int]) -> None:
        """Splits what is pending; a piece is certain when three more characters follow it."""
        self._pending += text
        if self._run:
            self._go_on(last, out)
            if self._run:
                return
        pieces = _SPLIT.findall(self._pending)
        left = 0
        while not last and pieces and left < 3:
            left += len(pieces.pop())
        memory = self._memory
        for p in pieces:
            ids = memory.get(p)
            out += self._piece(p) if ids is None else ids
        self._pending = self._pending[len(self._pending) - left :] if left else ""
        if len(self._pending) > LONGEST:
            first = _SPLIT.match(self._pending).group()
            self._run = next(r for r in _RUNS if r.match(first[-1]))
            self._long(first[:-1].encode(), out)
            self._pending = self._pending[len(first) - 1 :]
            self._go_on(last, out)

    def _go_on(self, last: bool, out: list[int]) -> None:
        """The long piece takes what belongs to it; its last character so far waits."""
        m = self._run.match(self._pending)
        end = m.end() if m else 0
        ended = last or end < len(self._pending)
        if not ended or (self._run is _RUNS[0] and end < len(self._pending)):
            end -= 1  # of white space before a sign, the last one starts the next piece
        self._long(self._pending[:end].encode(), out)
        self._pending = self._pending[end:]
        if ended:
            out += [self.vocabulary.ids[t] for t in merged(self._bytes, self.vocabulary.rank)]
            self._bytes, self._run = b"", None

    def _piece(self, piece: str) -> list[int]:
        raw = piece.encode()
        ids = self.vocabulary.ids
        if len(raw) > WHOLE:
            out: list[int] = []
            self._long(raw, out)
            out += [ids[t] for t in merged(self._bytes, self.vocabulary.rank)]
            self._bytes = b""
            return out
        found = [ids[t] for t in merged(raw, self.vocabulary.rank)]
        self._memory[piece] = found
        return found

    def _long(self, data: bytes, out: list[int]) -> None:
        """Adds to a long piece and emits the tokens that can no longer change."""
        ahead = self.vocabulary.lookahead
        step = 4 * (ahead + WHOLE)
        for at in range(0, len(data), step):
            self._bytes += data[at : at + step]
            done = 0
            for token in merged(self._bytes, self.vocabulary.rank):
                if done + len(token) + ahead > len(self._bytes):
                    break
                done += len(token)
                out.append(self.vocabulary.ids[token])
            self._bytes = self._bytes[done:]


class Decoder:
    """A streaming decoder: ids to text, holding back the bytes of an unfinished character."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self._token = vocabulary.token
        self._text = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self._text.decode(b"".join(map(self._token.__getitem__, ids)))

    def finish(self) -> str:
        return self._text.decode(b"", True)


def chunks(text: str) -> Iterator[str]:
    return (text[i : i + STEP] for i in range(0, len(text), STEP))


def prepare(texts: list[str], vocabulary: Vocabulary, memory: dict[str, list[int]]) -> list[list[str] | None]:
    """The pieces of each text that one step holds, with the new ones among them encoded together.

    A longer text, or one with a special token, has None: it is streamed.
    """
    special = vocabulary.special
    split = [None if len(t) > STEP or any(s in t for s in special) else _SPLIT.findall(t) for t in texts]
    if len(memory) > CACHED:
        memory.clear()
    new = list({p for pieces in split if pieces for p in pieces if p not in memory and len(p.encode()) <= WHOLE})
    memory.update(zip(new, vocabulary.short([p.encode() for p in new]), strict=True))
    return split


def encode(text: str, vocabulary: Vocabulary, memory: dict[str, list[int]] | None = None, pieces: list[str] | None = None) -> Iterator[list[int]]:
    """The ids of a text, in batches as they become stable."""
    encoder = Encoder(vocabulary, memory)
    if pieces is not None:
        yield encoder.all_of(pieces)
        return
    for chunk in chunks(text):
        yield encoder.feed(chunk)
    yield encoder.finish()


@lru_cache(maxsize=2)
def _loaded(path: str) -> tuple[Vocabulary, dict[str, list[int]], dict[int, str]]:
    vocabulary = Vocabulary(path)
    return vocabulary, {}, {i: f"{i}," for i in vocabulary.token}


def _split_batch(texts: pa.Array, vocabulary: Vocabulary, memory: dict[str, list[int]]) -> Iterator[tuple[str, list[str] | None]]:
    """Each text with its pieces, some 4 MB of text at a time."""
    held: list[str] = []
    size = 0
    for n, text in enumerate(texts, 1):
        held.append(text.as_py() or "")
        size += len(held[-1])
        if size > 1 << 22 or n == len(texts):
            yield from zip(held, prepare(held, vocabulary, memory), strict=True)
            held, size = [], 0


def round_trip(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """For each row its number of ids, the digests of the ids and of the decoded text.

    With ``keep_ids`` the ids and the decoded text themselves are columns too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, memory, decimal = _loaded(path)
        for batch in batches:
            rows = []
            for text, pieces in _split_batch(batch.column("text"), vocabulary, memory):
                n, ids_sha, text_sha = 0, hashlib.sha256(), hashlib.sha256()
                decoder, all_ids, decoded = Decoder(vocabulary), [], []
                for ids in encode(text, vocabulary, memory, pieces):
                    digits = "".join(map(decimal.__getitem__, ids))
                    # every id but the very last is followed by a comma
                    ids_sha.update((("," if n else "") + digits[:-1]).encode() if ids else b"")
                    n += len(ids)
                    back = decoder.feed(ids)
                    text_sha.update(back.encode())
                    if keep_ids:
                        all_ids += ids
                        decoded.append(back)
                decoded.append(decoder.finish())
                text_sha.update(decoded[-1].encode())
                rows.append((n, ids_sha.hexdigest(), text_sha.hexdigest(), all_ids, "".join(decoded)))
            made = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made[: 5 if keep_ids else 3]], names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if keep_ids else [])]
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if keep_ids else "")
    return docs.select("doc_id", "text").mapInArrow(run, schema)
