"""Language identification by language-bitmask n-gram filters.

Each language has a Bloom filter of its characteristic n-grams. The filters are
bit-sliced: one array of slots, in which bit l of a slot belongs to language l, so one
lookup (the AND of ``PROBES`` slots) returns all languages that hold an n-gram. A text's
hits are counted for each language, corrected for the filter's false positives, and the
largest corrected share decides. A document is ``und`` if its text is null or has no
letter; its score is 0.

The model is fitted on a bounded sample: about ``sample`` labelled documents for each
language, chosen by a hash of doc_id, whole texts. Rows whose label or text is null
teach nothing. Repeated rows, empty tables (every answer is ``und``) and other columns
are fine; lang, source and doc_id are never read by a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of an n-gram.
GRAM = 4
PROBES = 2
SLOT_BITS = 18
#: Bounds of the model: documents read and n-grams kept for each language.
SAMPLE = 3000
GRAMS = 12_000
#: An n-gram is characteristic of a language if it is this often as frequent as in the one that has it most.
RATIO = 0.25
UNKNOWN = "und"
#: A text with a lower score is in none of the languages.
LEAST_SCORE = 0.05

#: ASCII bytes that are no letters become spaces.
_SPACED = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256))
_MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_CHUNK = 1 << 20


def _bytes_of(text: str) -> bytes:
    return b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_SPACED).split()) + b" "


def _grams(data: np.ndarray) -> np.ndarray:
    """The n-grams of a byte array, each as one number."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.empty(0, np.uint32)
    out = data[:n].astype(np.uint32)
    for k in range(1, GRAM):
        out = (out << np.uint32(8)) | data[k : k + n]
    return out


def _slots(grams: np.ndarray) -> list[np.ndarray]:
    wide = grams.astype(np.uint64)
    return [((wide * m) >> np.uint64(64 - SLOT_BITS)).astype(np.int64) for m in _MULTIPLIERS[:PROBES]]


@dataclass
class Model:
    """Bit-sliced filters: ``slots`` has a row of 64-bit masks for each slot, a column for 64 languages."""

    languages: list[str]
    slots: np.ndarray
    false_rate: np.ndarray
    #: The language with most training rows; a text without hits gets it.
    common: int = 0

    @classmethod
    def fitted(cls, grams: dict[str, np.ndarray], common: str | None = None) -> Model:
        languages = sorted(grams)
        slots = np.zeros((1 << SLOT_BITS, max(1, -(-len(languages) // 64))), np.uint64)
        for n, language in enumerate(languages):
            for at in _slots(grams[language].astype(np.uint32)):
                slots[at, n // 64] |= np.uint64(1 << (n % 64))
        bits = [(slots[:, n // 64] >> np.uint64(n % 64)) & np.uint64(1) for n in range(len(languages))]
        return cls(languages, slots, np.array([float(b.mean()) ** PROBES for b in bits]),
                   languages.index(common) if common in languages else 0)

    def hits(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For each text its n-grams, and for each language how many of them its filter holds."""
        lengths = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(lengths)
        counts = np.maximum(lengths - GRAM + 1, 0)
        held = np.zeros((len(texts), len(self.languages)), np.int64)
        data = np.frombuffer(b"".join(texts), np.uint8)
        for start in range(0, len(data), _CHUNK):
            piece = data[start : start + _CHUNK + GRAM - 1]
            grams = _grams(piece)
            if not len(grams):
                continue
            owner = np.searchsorted(ends, np.arange(start, start + len(grams)), side="right")
            whole = np.arange(start, start + len(grams)) + GRAM <= ends[owner]
            found = [self.slots[at] for at in _slots(grams)]
            masks = found[0]
            for other in found[1:]:
                masks = masks & other
            begins = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            for n in range(len(self.languages)):
                bit = ((masks[:, n // 64] >> np.uint64(n % 64)) & np.uint64(1)).astype(np.int64) * whole
                held[owner[begins], n] += np.add.reduceat(bit, begins)
        return counts, held

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        known = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if self.languages else []
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if known:
            counts, held = self.hits([_bytes_of(texts[i]) for i in known])
            expected = counts[:, None] * self.false_rate
            share = (held - expected) / np.maximum(counts[:, None] * (1 - self.false_rate), 1e-9)
            best = np.where(share.max(1) > 0, share.argmax(1), self.common)
            top = np.clip(share[np.arange(len(known)), best], 0.0, 1.0)
            for i, b, s in zip(known, best, top, strict=True):
                names[i], scores[i] = self.languages[b], s
        return names, scores


def held_out(doc_id: Column) -> Column:
    """Documents that teach nothing."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _gram_counts(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        for lang, rows in part.groupby("lang"):
            data = np.frombuffer(b"".join(_bytes_of(t) for t in rows["text"]), np.uint8)
            grams, n = np.unique(_grams(data), return_counts=True)
            yield pd.DataFrame({"lang": lang, "gram": grams.astype(np.int64), "n": n})


def fit(docs: DataFrame, sample: int = SAMPLE, grams: int = GRAMS) -> Model:
    """A model of the languages in ``docs.lang``, from the rows that are not held out."""
    labelled = docs.select("doc_id", "lang", "text").where(
        ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return Model.fitted({})
    part = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    share = F.element_at(F.create_map(*[F.lit(x) for k, v in sizes.items() for x in (k, sample / v)]), F.col("lang"))
    chosen = labelled.where(part < share).select("lang", "text")
    counts = (
        chosen.mapInPandas(_gram_counts, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rates = counts.join(F.broadcast(totals), "lang").withColumn("rate", F.col("n") / F.col("total"))
    most = rates.groupBy("gram").agg(F.max("rate").alias("most"))
    kept = rates.join(most, "gram").where(f"n > 1 AND rate >= {RATIO} * most")
    ranked = kept.selectExpr("lang", "gram", "row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS place")
    found = ranked.where(F.col("place") <= grams).select("lang", "gram").toPandas()  # at most ``grams`` a language
    return Model.fitted({lang: found.loc[found["lang"] == lang, "gram"].to_numpy() for lang in sizes},
                        common=max(sizes, key=lambda k: (sizes[k], k)))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """The rows and columns of ``docs`` with ``lang_pred`` and ``score``."""
    known = docs.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in docs.columns if c not in ("lang_pred", "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = known.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in rest], pa.array(names, pa.string()), pa.array(scores)],
                [*rest, "lang_pred", "score"])

    schema = docs.select(*rest).schema.add("lang_pred", "string").add("score", "double")
    return docs.select(*rest).mapInArrow(run, schema)
