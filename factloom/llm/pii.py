"""Personal data: patterns, and terms that reveal what the patterns protect.

The values of the base patterns (email, ip, card, phone) are the protected entities. How much
a term tells of an entity is estimated from the corpus: with N documents, the entity in n_e of them,
the term in n_t and both in n_te, the term gives PMI = log2(N * n_te / (n_t * n_e)) of the entity's
information log2(N / n_e). A term that gives the share ``DISCLOSURE`` of it or more is disclosing
and becomes a span of kind ``term`` wherever it stands, if

- it was met with the entity in ``SUPPORT`` documents that are no copies of each other (they differ in
  each of three MinHash values of their shingles, so a copied passage is one witness), and
- chance would do the same with a probability below 2 ** -``EVIDENCE`` (Chernoff's bound).

``keep_text`` also gives the sanitised text: entities become their kind, disclosing terms are
generalised to the longest of their prefixes (as ``pref*``, counted as one class of all terms that
begin so) that discloses none of their entities, and removed where no prefix of three characters does.

A term is a run of letters and digits outside the base spans, lower-cased. Entities travel
as digests. Every count is over all documents; repeated rows count as often as they stand
there, but are one witness. A null text is empty; null ids keep their rows; an empty table
gives an empty result; other columns are not read.

The texts are read three times: for the rows with entities, whose terms are stored; for the
counts of the terms that these rows leave in question, and of their prefixes, looked up as whole columns
of distinct words and summed in each task; and for the spans. Only texts that hold what every base span holds are searched for spans.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.store import broadcast_if_small, stored

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
DISCLOSURE, SUPPORT, EVIDENCE = 0.8, 3, 30.0
LEAST_PREFIX = 3
#: Keys (8 bytes each), four for a digest or a candidate, or terms that workers are given whole; beyond them the tables are joined by shuffle.
MOST_KEYS, MOST_TERMS = 2_000_000, 200_000
#: Rows that Python gives at once.
MOST_ROWS = 50_000
#: Bytes of text that are split into words at once.
PIECE = 8 << 20
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# only the first digit of a run may begin an address, which keeps long runs linear
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W_]+")
_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)

#: Every base span holds one of these.
_TRACE = r"@|\+[0-9]|[0-9]\.[0-9]+\.[0-9]+\.[0-9]|(?:[0-9][ -]?){15}[0-9]"
#: A-Z in lower case, other ASCII signs but letters and digits as spaces; and 6 bits for each of these, none for a space.
_SPACED = bytes(c if c > 127 else ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(256))
_CLASS = bytes(0 if c == 32 else 63 if c > 127 else 1 + "abcdefghijklmnopqrstuvwxyz0123456789".index(chr(c)) for c in _SPACED)
#: Bytes that are no part of an ASCII sign or a Latin-1 letter (or of one of few of these): only such may end a word.
_ODD = bytes(c in (0x97, 0xB7) or (c >= 0xC0 and c != 0xC3) for c in range(256))

Span = tuple[int, int]


def _emails(text: str) -> list[Span]:
    """As the whole pattern finds them, but from the signs outwards: linear on long runs."""
    found, free = [], 0
    at = text.find("@")
    while at >= 0:
        if m := _DOMAIN.match(text, at):
            start = free + len(text[free:at].rstrip(_LOCAL))
            if start < at:
                found.append((start, m.end()))
        # no local part reaches over a sign, nor into an address found
        free = max(at + 1, found[-1][1] if found else 0)
        at = text.find("@", free)
    return found


def _luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(doubled) + sum(int(d) for d in digits[::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_ip(text: str) -> bool:
    return all(len(p) <= 3 and int(p) <= 255 for p in (part.lstrip("0") or "0" for part in text.split(".")))


def _is_card(text: str) -> bool:
    return 16 <= len(text) <= 37 and 16 <= len(d := _digits(text)) <= 19 and _luhn(d)


def base_spans(text: str) -> dict[str, list[Span]]:
    """The spans of each kind, by start; an end is exclusive."""
    found = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = _emails(text)
    found["ip"] = [m.span() for m in _IP.finditer(text) if _is_ip(m[0])]
    found["card"] = [m.span() for m in _CARD.finditer(text) if _is_card(m[0])]
    if "+" in text:
        found["phone"] = [m.span() for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return found


def _entities(text: str, spans: dict[str, list[Span]]) -> list[bytes]:
    """Digests of the distinct values, however they are written."""
    values = {
        f"{kind}:{(text[a:b].lower() if kind in ('email', 'ip') else _digits(text[a:b]))}" for kind, of in spans.items() for a, b in of}
    return [hashlib.blake2b(v.encode(), digest_size=16).digest() for v in sorted(values)]


def _words(text: str, spans: dict[str, list[Span]]) -> Iterator[tuple[int, int, str]]:
    """The terms outside the base spans with their places."""
    covered = sorted(s for of in spans.values() for s in of)
    k, reach = 0, 0
    for m in _WORD.finditer(text):
        while k < len(covered) and covered[k][0] < m.end():
            reach = max(reach, covered[k][1])
            k += 1
        if m.start() >= reach:
            yield m.start(), m.end(), m[0].lower()


def _outside(text: str, spans: dict[str, list[Span]]) -> str:
    """The text without the base spans and the words that reach into them."""
    out, at = [], 0
    for a, b in sorted(s for of in spans.values() for s in of):
        if b <= at:
            continue
        while a > at and text[a - 1].isalnum() and text[a].isalnum():
            a -= 1
        while b < len(text) and text[b - 1].isalnum() and text[b].isalnum():
            b += 1
        if a > at:
            out.append(text[at:a])
        at = b
    return " ".join([*out, text[at:]])


def _terms(text: str, spans: dict[str, list[Span]]) -> set[str]:
    """The distinct terms that ``_words`` gives, from the distinct runs between white space."""
    runs = set((_outside(text, spans) if any(spans.values()) else text).split())
    plain = {r for r in runs if r.isalnum()}
    plain.update(_WORD.findall(" ".join(runs - plain)))
    return {w.lower() for w in plain}


def _marked(texts: pa.Array) -> pa.Array:
    """Which texts may have base spans: the others have none."""
    return pc.match_substring_regex(pc.fill_null(texts, ""), _TRACE)


def _heads(terms: Iterable[str]) -> np.ndarray:
    """At the classes of the first three bytes of a word: whether a term begins so."""
    table = np.zeros((64, 64, 64), bool)
    for head in {t[:LEAST_PREFIX] for t in terms}:
        if head.isascii():
            table[tuple(head.encode().ljust(LEAST_PREFIX).translate(_CLASS))] = True
        else:
            table[63], table[:, 63], table[:, :, 63] = True, True, True
    return table.ravel()


def _begun(data: bytes, heads: np.ndarray) -> bytes | np.ndarray:
    """The runs that begin as ``heads`` says or hold odd bytes; spaces for the rest. The last byte is a space."""
    signs = np.append(np.frombuffer(data.translate(_CLASS), np.uint8), np.uint8(0))
    inside = signs[:-1] > 0
    starts = np.flatnonzero(inside[1:] > inside[:-1]) + 1
    if inside[:1].any():
        starts = np.insert(starts, 0, 0)
    if not len(starts):
        return data
    second = signs[starts + 1].astype(np.int32)
    third = np.where(second > 0, signs[starts + 2], np.uint8(0))
    odd = np.maximum.reduceat(np.frombuffer(data.translate(_ODD), np.uint8), starts) > 0
    wanted = heads[signs[starts].astype(np.int32) << 12 | second << 6 | third] | odd
    # what lies between runs is spaces already
    kept = np.repeat(np.insert(wanted, 0, False), np.diff(starts, prepend=0, append=len(data)))
    return np.where(kept, np.frombuffer(data, np.uint8), np.uint8(32))


def _runs(texts: pa.Array, heads: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.Array]]:
    """(first row, where each row's runs begin, numbers of the runs, the distinct runs), part by part.

    A run has no ASCII signs but small letters and digits; with ``heads`` only those that these leave in question are given.
    """
    size = max(1, len(texts) * PIECE // max(1, texts.nbytes))
    for start in range(0, len(texts), size):
        # each text ends with a space, so that no run reaches into the next
        part = pc.fill_null(texts.slice(start, size).cast(pa.large_string()), "")
        part = pc.binary_join_element_wise(part, pa.scalar("", part.type), pa.scalar(" ", part.type))
        offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
        data = part.buffers()[2][offsets[0] : offsets[-1]].to_pybytes().translate(_SPACED)
        data = data if heads is None else _begun(data, heads)
        spaced = pa.Array.from_buffers(pa.large_string(), len(part), [None, pa.py_buffer(offsets - offsets[0]), pa.py_buffer(data)])
        split = pc.ascii_split_whitespace(spaced)
        runs = pc.list_flatten(split).dictionary_encode()
        yield start, split.offsets.to_numpy() - split.offsets[0].as_py(), runs.indices.to_numpy(), runs.dictionary


def _judged(
    texts: pa.Array, judge: Callable[[list[str]], list], heads: np.ndarray | None = None, among: pa.Array | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray, dict[int, list]]]:
    """(rows, numbers of runs, what ``judge`` gives for a run's terms) of the runs for which it gives any, part by part.

    Each distinct run is judged once; with ``among`` an ASCII one only if it is a term of these.
    """
    for start, begins, index, distinct in _runs(texts, heads):
        asked = np.arange(len(distinct))
        if among is not None:
            asked = asked[_flags(pc.or_(pc.is_in(distinct, value_set=among), pc.invert(pc.string_is_ascii(distinct))))]
        kept = {}
        for n, run in zip(asked.tolist(), distinct.take(pa.array(asked)).to_pylist(), strict=True):
            if mine := judge([w.lower() for w in ((run,) if run.isalnum() else _WORD.findall(run))]):
                kept[n] = mine
        own = np.zeros(len(distinct), bool)
        own[list(kept)] = True
        places = np.flatnonzero(own[index])
        yield np.searchsorted(begins, places, side="right") - 1 + start, index[places], kept


def _flags(of: pa.Array) -> np.ndarray:
    return of.to_numpy(zero_copy_only=False)


def _once(keys: np.ndarray) -> np.ndarray:
    """The distinct keys in order."""
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys


def _ranges(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of ranges, one range after the other."""
    return np.repeat(begins - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


def _holding(texts: pa.Array, keep: Callable[[str], bool], heads: np.ndarray | None = None, among: pa.Array | None = None) -> dict[int, set[str]]:
    """The terms that ``keep`` takes (only such as are ``among`` these) of each row that has any, in or outside the base spans."""
    found: dict[int, set[str]] = {}
    for rows, runs, kept in _judged(texts, lambda terms: [t for t in terms if keep(t)], heads, among):
        for row, n in zip(rows.tolist(), runs.tolist(), strict=True):
            found.setdefault(row, set()).update(kept[n])
    return found


def _documents(texts: pa.Array, judge: Callable[[list[str]], list], heads: np.ndarray | None = None) -> Counter:
    """In how many rows each of the values stands that ``judge`` gives for the terms of the rows' runs."""
    total: Counter = Counter()
    for rows, runs, kept in _judged(texts, judge, heads):
        if not len(rows):
            continue
        numbers: dict = {}
        lists = [np.array([numbers.setdefault(v, len(numbers)) for v in values], np.int64) for values in kept.values()]
        lengths = np.array([len(v) for v in lists])
        begins, values, place = np.cumsum(lengths) - lengths, np.concatenate(lists), np.zeros(max(kept) + 1, np.int64)
        place[list(kept)] = np.arange(len(kept))
        # a run once a row, then all its values
        once = _once(rows.astype(np.int64) * len(lists) + place[runs])
        row, of = np.divmod(once, len(lists))
        pairs = _once(np.repeat(row, lengths[of]) * len(numbers) + values[_ranges(begins[of], lengths[of])])
        counts = np.bincount(pairs % len(numbers), minlength=len(numbers)).tolist()
        total.update(dict(zip(numbers, counts, strict=True)))
    return total


def _levels(terms: Iterable[str], prefixes: Iterable[str]) -> tuple[list[str], list[tuple[int | None, int, pa.Array]]]:
    """The values, numbered, and (length, first number, values) of the terms, without a length, and of the prefixes of each length."""
    values, levels = sorted(terms), []
    levels.append((None, 0, pa.array(values, pa.large_string())))
    for size, of in itertools.groupby(sorted(prefixes, key=lambda p: (len(p), p)), key=len):
        of = list(of)
        levels.append((size, len(values), pa.array(of, pa.large_string())))
        values += of
    return values, levels


def _valued(words: pa.Array, levels: list[tuple[int | None, int, pa.Array]]) -> tuple[np.ndarray, np.ndarray]:
    """(place, number): the values that each word is or begins with. Of a prefix, all shorter ones of ``LEAST_PREFIX`` or more must be given too."""
    places, numbers, left = [], [], np.arange(len(words))
    for size, first, of in levels:
        at = pc.index_in(words if size is None else pc.utf8_slice_codeunits(words, 0, size), value_set=of)
        has = at.is_valid()
        numbers.append(first + at.drop_null().to_numpy().astype(np.int64))
        places.append(left[_flags(has)])
        if size is not None:  # the next prefix is longer
            words, left = words.filter(has), places[-1]
    return np.concatenate(places), np.concatenate(numbers)


def _met(texts: pa.Array, levels: list[tuple[int | None, int, pa.Array]], heads: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, number of a value) once for each value that a term of the row is or begins with, part by part."""
    total = sum(len(of) for *_, of in levels)
    for start, begins, index, distinct in _runs(texts, heads):
        plain = pc.string_is_ascii(distinct)
        odd = zip(np.flatnonzero(~_flags(plain)).tolist(), distinct.filter(pc.invert(plain)).to_pylist(), strict=True)
        terms = [(n, w.lower()) for n, run in odd for w in _WORD.findall(run)]
        words = pa.concat_arrays([distinct.filter(plain), pa.array([w for _, w in terms], distinct.type)])
        owners = np.concatenate([np.flatnonzero(_flags(plain)), np.array([n for n, _ in terms], np.int64)])
        places, numbers = _valued(words, levels)
        order = np.argsort(owners[places], kind="stable")
        numbers, many = numbers[order], np.bincount(owners[places], minlength=len(distinct))
        # a run once a row, then all its values
        held = np.flatnonzero(many[index])
        if not len(held):
            continue
        once = _once((np.searchsorted(begins, held, side="right") - 1) * len(distinct) + index[held])
        row, of = np.divmod(once, len(distinct))
        row, number = np.divmod(_once(np.repeat(row, many[of]) * total + numbers[_ranges((np.cumsum(many) - many)[of], many[of])]), total)
        yield row + start, number


def _gathered(columns: Iterable[pa.Array]) -> Iterator[pa.Array]:
    """Columns joined to ``PIECE`` bytes and more: each lookup hashes all values anew."""
    held, size = [], 0
    for column in columns:
        held.append(column)
        size += column.nbytes
        if size >= PIECE:
            yield pa.concat_arrays(held)
            held, size = [], 0
    if held:
        yield pa.concat_arrays(held)


def _least_hashes(text: str) -> list[int]:
    """Three MinHash values of the three-word shingles."""
    words = text.lower().split()
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = np.array([xxhash.xxh64_intdigest(s) for s in shingles], np.uint64)
    return [int((h * seed).min().astype(np.int64)) for seed in _SEEDS]


def _pair(entity: bytes, doc_id: int | None, text: str) -> int:
    return xxhash.xxh64_intdigest(entity + f"{doc_id}:{text}".encode()) - 2**63


def _mapped(docs: DataFrame, of_batches: Callable[[Iterator[tuple[pa.Array, pa.Array]]], Iterator[list[tuple]]], schema: str) -> DataFrame:
    """The rows that ``of_batches`` yields for a task's batches of doc_id and text."""
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string(), "array<string>": pa.list_(pa.string()), "array<binary>": pa.list_(pa.binary()), "array<long>": pa.list_(pa.int64())}
    types = [kinds[c.split()[1]] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in of_batches((batch.column("doc_id"), batch.column("text")) for batch in batches):
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _one_by_one(each, marked: bool = False):
    """A batch's rows as ``each`` yields them for a doc_id and text; ``marked`` leaves out texts without base spans."""

    def of_batches(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[list[tuple]]:
        for ids, texts in batches:
            if marked:
                keep = _marked(texts)
                ids, texts = ids.filter(keep), texts.filter(keep)
            for part in range(0, len(ids), 256):  # terms take more room than texts
                given = zip(ids.slice(part, 256).to_pylist(), texts.slice(part, 256).to_pylist(), strict=True)
                yield [r for i, t in given for r in each(i, t or "")]

    return of_batches


def _given(df: DataFrame, column: str, most: int):
    """The values of a column, broadcast as a set, or None if there are more than ``most``."""
    spark = df.sparkSession
    if df.count() > most:
        return None
    return spark.sparkContext.broadcast(frozenset(v if isinstance(v, str) else bytes(v) for (v,) in df.select(column).collect()))


def _has(given, value) -> bool:
    return given is None or value in given.value


def _disclosure(n: int):
    """Columns disclosure and evidence from n_te, n_t, n_e and support among ``n`` documents."""
    share, base = F.least(F.col("n_te") / F.col("n_t"), F.lit(1.0)), F.col("n_e") / F.lit(float(n))
    information = -F.log2(base)
    gained = F.log2(share / base)
    apart = share * gained + F.when(share < 1, (1 - share) * F.log2((1 - share) / (1 - base))).otherwise(0.0)
    return F.when(information > 0, gained / information).otherwise(0.0), F.when(gained > 0, F.col("support") / share * apart).otherwise(0.0)


def disclosing_terms(
    docs: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT, evidence: float = EVIDENCE
) -> DataFrame:
    """(term, general): the terms that reveal an entity and the prefix they are generalised to, if any."""
    spark = docs.sparkSession
    none = spark.createDataFrame([], "term string, general string")

    def mention(doc_id: int | None, text: str):
        spans = base_spans(text)
        if found := _entities(text, spans):
            yield found, [_pair(e, doc_id, text) for e in found], *_least_hashes(text), sorted(_terms(text, spans))

    rows = "entities array<binary>, pairs array<long>, m1 long, m2 long, m3 long, terms array<string>"
    bearing = stored(_mapped(docs, _one_by_one(mention, marked=True), rows), "mentions")
    mentions = bearing.select(F.explode(F.arrays_zip("entities", "pairs")).alias("e"), "m1", "m2", "m3", "terms").selectExpr(
        "e.entities AS entity", "e.pairs AS pair", "m1", "m2", "m3", "terms")
    # witnesses: documents that no two share a MinHash value
    first = mentions.groupBy("entity", "m1").agg(F.min(F.struct("pair", "m2", "m3")).alias("w")).select("entity", "w.*")
    second = first.groupBy("entity", "m2").agg(F.min(F.struct("pair", "m3")).alias("w")).select("entity", "w.*")
    third = second.groupBy("entity", "m3").agg(F.min("pair").alias("pair")).select("entity", "pair")
    recurring = third.groupBy("entity").agg(F.count("*").alias("witnesses")).where(F.col("witnesses") >= support)
    often = stored(mentions.groupBy("entity").agg(F.count("*").alias("n_e")).join(recurring, "entity").select("entity", "n_e"), "entities")
    if often.isEmpty():
        return none
    n = docs.count()
    rows = mentions.groupBy("entity", "pair").agg(F.count("*").alias("copies"))
    chosen = stored(
        third.join(rows, ["entity", "pair"]).join(often, "entity", "left_semi").select("entity", "pair", (1.0 / F.col("copies")).alias("weight")), "witnesses")
    known = _given(often, "entity", MOST_KEYS // 4)
    held = mentions if known is None else mentions.join(F.broadcast(often.select("entity")), "entity", "left_semi")
    witnesses = broadcast_if_small(chosen, chosen.count(), MOST_KEYS // 4)
    # a term is sent on only with a witness or not: rows are summed before they are shuffled
    met = (
        held.select("entity", "pair", "terms").join(witnesses, ["entity", "pair"], "left")
        .select("entity", F.coalesce("weight", F.lit(0.0)).alias("weight"), F.explode("terms").alias("term"))
        .groupBy("entity", "term").agg(F.count("*").alias("n_te"), F.round(F.sum("weight")).cast("long").alias("support"))
        .where(F.col("support") >= support))
    # the rows with entities hold a term no oftener than all rows do, and both measures fall as it grows
    told, sure = _disclosure(n)
    least = bearing.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    near = (told >= disclosure - 1e-9) & (sure >= evidence - 1e-6)
    likely = stored(met.join(least, "term").join(often, "entity").where(near).drop("n_t", "n_e"), "met")
    candidates = likely.select("term").distinct()
    if likely.isEmpty():
        return none
    wanted = _given(candidates, "term", MOST_KEYS // 4)
    prefixes = _given(_prefixes(likely).select("prefix").distinct(), "prefix", MOST_TERMS)
    once, nothing = wanted is not None and prefixes is not None, spark.sparkContext.broadcast(frozenset())
    seen = stored(_seen(docs, wanted, prefixes, known), "classes") if once else _seen(docs, wanted, nothing, known)
    counted = seen.where("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("n_t"))
    flagged = stored(
        likely.join(counted, "term").join(often, "entity").where((told >= disclosure) & (sure >= evidence)).select("term", "entity"), "flagged")
    if flagged.isEmpty():
        return none
    if not once:
        prefixes = _given(_prefixes(flagged).select("prefix").distinct(), "prefix", MOST_TERMS)
        seen = stored(_seen(docs, nothing, prefixes, known), "classes")
    return stored(_generalised(seen, flagged, often, n, disclosure), "disclosing")


def _prefixes(terms: DataFrame) -> DataFrame:
    """(term, entity, size, prefix): the prefixes that are shorter than the term."""
    lengths = F.when(F.length("term") > LEAST_PREFIX, F.sequence(F.lit(LEAST_PREFIX), F.length("term") - 1)).otherwise(F.array().cast("array<int>"))
    return terms.select("term", "entity", F.explode(lengths).alias("size")).select(
        "term", "entity", "size", F.expr("substring(term, 1, size)").alias("prefix"))


def _seen(docs: DataFrame, wanted, prefixes, known) -> DataFrame:
    """(term, prefix, entity, n): in how many of a task's or batch's documents a term, a prefix, or a prefix and an entity of the given sets stand; None gives all."""
    of_batches = _every(wanted, prefixes, known)
    if wanted is not None and prefixes is not None:
        heads = docs.sparkSession.sparkContext.broadcast(_heads(t for of in (wanted, prefixes) for t in of.value))
        of_batches = _given_ones(wanted, prefixes, known, heads)
    return _mapped(docs, of_batches, "term string, prefix string, entity binary, n long")


def _given_ones(wanted, prefixes, known, heads):
    """For ``_seen``, with both sets given: sums for each task."""

    def of_batches(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[list[tuple]]:
        values, levels = _levels(wanted.value, prefixes.value)
        terms, alone = len(wanted.value), np.zeros(len(values), np.int64)
        both: Counter = Counter()
        numbers: dict[bytes, int] = {}

        def with_entities() -> list[tuple]:
            names = list(numbers)
            return [(None, values[k >> 32], names[k & 0xFFFFFFFF], n) for k, n in both.items()]

        for texts in _gathered(texts for _, texts in batches):
            marked, outside, entities = _marked(texts), [], []
            for text in texts.filter(marked).to_pylist():
                spans = base_spans(text)
                outside.append(_outside(text, spans))
                entities.append([numbers.setdefault(e, len(numbers)) for e in _entities(text, spans) if _has(known, e)])
            lengths = np.array([len(e) for e in entities], np.int64)
            begins, flat = np.cumsum(lengths) - lengths, np.array([e for of in entities for e in of], np.int64)
            plain = texts.filter(pc.invert(marked))
            for rows, held in _met(pa.concat_arrays([plain, pa.array(outside, plain.type)]), levels, heads.value):
                alone += np.bincount(held, minlength=len(alone))
                own = (rows >= len(plain)) & (held >= terms)
                of = rows[own] - len(plain)
                pairs = np.repeat(held[own], lengths[of]) << 32 | flat[_ranges(begins[of], lengths[of])]
                keys, counts = np.unique(pairs, return_counts=True)
                both.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
            if len(both) > MOST_TERMS:
                yield with_entities()
                both.clear()
                numbers.clear()
        yield with_entities()
        found = np.flatnonzero(alone)
        for part in (found[k : k + MOST_ROWS].tolist() for k in range(0, len(found), MOST_ROWS)):
            yield [(values[k] if k < terms else None, None if k < terms else values[k], None, n) for k, n in zip(part, alone[part].tolist(), strict=True)]

    return of_batches


def _every(wanted, prefixes, known):
    """For ``_seen``, with a set that is too large to be given: sums for each batch."""

    def begun(terms: Iterable[str]) -> set[str]:
        if prefixes is not None and not prefixes.value:
            return set()
        return {p for t in terms for k in range(LEAST_PREFIX, len(t) + 1) if _has(prefixes, p := t[:k])}

    def held(terms: Iterable[str]) -> list[tuple]:
        return [(t, None, None) for t in terms if _has(wanted, t)] + [(None, p, None) for p in begun(terms)]

    def of_batches(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[list[tuple]]:
        for _, texts in batches:
            marked = _marked(texts)
            counts = _documents(texts.filter(pc.invert(marked)), held)
            for text in texts.filter(marked).to_pylist():
                spans = base_spans(text)
                terms = _terms(text, spans)
                mine = held(terms)
                counts.update(mine)
                entities = [e for e in _entities(text, spans) if _has(known, e)]
                counts.update((None, p, e) for _, p, _ in mine if p is not None for e in entities)
                if len(counts) > MOST_TERMS:
                    yield [(*key, n) for key, n in counts.items()]
                    counts.clear()
            yield [(*key, n) for key, n in counts.items()]

    return of_batches


def _generalised(seen: DataFrame, flagged: DataFrame, often: DataFrame, n: int, disclosure: float) -> DataFrame:
    """Each flagged term with the longest prefix that discloses none of the term's entities."""
    wide = _prefixes(flagged)
    each = seen.where("prefix IS NOT NULL").join(wide.select("prefix").distinct(), "prefix", "left_semi")
    alone = each.where("entity IS NULL").groupBy("prefix").agg(F.sum("n").alias("n_t"))
    both = each.where("entity IS NOT NULL").groupBy("prefix", "entity").agg(F.sum("n").alias("n_te"))
    told, _ = _disclosure(n)
    judged = (
        wide.join(alone, "prefix").join(both, ["prefix", "entity"]).join(often, "entity").withColumn("support", F.col("n_te"))
        .groupBy("term", "size", "prefix").agg(F.max(told).alias("told")).where(F.col("told") < disclosure)
        .groupBy("term").agg(F.max(F.struct("size", "prefix")).alias("best")))
    return flagged.select("term").distinct().join(judged, "term", "left").select("term", F.col("best.prefix").alias("general"))


def _sanitised(text: str, spans: dict[str, list[Span]], terms: list[tuple[int, int, str | None]]) -> str:
    """The text with entities named by kind and terms generalised or removed."""
    changes = sorted([(a, b, f"<{kind.upper()}>") for kind, of in spans.items() for a, b in of] + [(a, b, f"{g}*" if g else "") for a, b, g in terms])
    out, at = [], 0
    for a, b, put in changes:
        if a >= at:  # what overlaps an earlier entity is a part of it
            out += [text[at:a], put]
        at = max(at, b)
    return "".join([*out, text[at:]])


def find(
    docs: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT, evidence: float = EVIDENCE, keep_text: bool = False
) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for each row; with ``keep_text`` also ``sanitised``.

    ``spans`` lists ``kind:start:end``, joined by commas, in code points with an exclusive end, by
    kind and start, disclosing terms last; ``base_sha256`` is the digest of the same without these.
    """
    terms = disclosing_terms(docs, disclosure, support, evidence)
    size = terms.count()
    few = size <= MOST_TERMS
    table = dict(terms.collect()) if few else {}
    shared = docs.sparkSession.sparkContext.broadcast(table)
    heads = docs.sparkSession.sparkContext.broadcast(_heads(table))
    rows = docs.select("doc_id", "text") if few else _with_terms(docs, terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        among = pa.array(list(shared.value), pa.large_string())
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            texts, size = batch.column("text"), batch.num_rows
            found = _holding(texts, shared.value.__contains__, heads.value, among) if shared.value else {}
            marked = _flags(_marked(texts))
            own = [None] * size if few else batch.column("terms").to_pylist()
            counts, bases, wholes = np.zeros((len(KINDS), size), np.int64), [nothing] * size, [""] * size
            sanitised = pc.fill_null(texts, "").to_pylist() if keep_text else None
            # the other texts have no spans
            asked = [n for n in range(size) if marked[n] or n in found or own[n]]
            for n, text in zip(asked, texts.take(pa.array(asked, pa.int64())).to_pylist(), strict=True):
                text = text or ""
                spans = base_spans(text) if marked[n] else {k: [] for k in KINDS}
                known = shared.value if few else {t["term"]: t["general"] for t in own[n] or []}
                extra = []
                if known and (not few or n in found):
                    extra = [(a, b, known[w]) for a, b, w in _words(text, spans) if w in known]
                base = [f"{k}:{a}:{b}" for k in KINDS for a, b in spans[k]]
                counts[:, n] = [len(spans[k]) for k in KINDS]
                bases[n] = hashlib.sha256(",".join(base).encode()).hexdigest()
                wholes[n] = ",".join(base + [f"{TERM}:{a}:{b}" for a, b, _ in extra])
                if keep_text:
                    sanitised[n] = _sanitised(text, spans, extra)
            made = [*map(pa.array, counts), *(pa.array(of, pa.string()) for of in (bases, wholes, *([sanitised] if keep_text else [])))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], names)

    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", *(["sanitised"] if keep_text else [])]
    schema = ", ".join(["doc_id long", *(f"n_{k} long" for k in KINDS), "base_sha256 string", "spans string"])
    return rows.mapInArrow(run, schema + (", sanitised string" if keep_text else ""))


def _with_terms(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Each row with the disclosing terms of its text, where these are too many to broadcast."""

    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("pair"))

    def held(pair: int, text: str):
        yield pair, sorted(_terms(text, base_spans(text)))

    of = (
        _mapped(keyed.select(F.col("pair").alias("doc_id"), "text"), _one_by_one(held), "pair long, terms array<string>").distinct()
        .select("pair", F.explode("terms").alias("term")).join(terms, "term")
        .groupBy("pair").agg(F.collect_list(F.struct("term", "general")).alias("terms")))  # no more than the text has
    return keyed.join(of, "pair", "left").select("doc_id", "text", "terms")
