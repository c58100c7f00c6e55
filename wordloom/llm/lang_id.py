"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram's vector binds its letters: each letter's
vector is rolled by its place and the vectors are multiplied. A text's vector bundles (sums) those of
its n-grams, a language's prototype bundles its texts, and a text has the language whose prototype
has the largest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIM = 512
GRAM = 3
SEED = 11
UNKNOWN = "und"
#: Characters of text handled at a time; a longer text is bundled piece by piece, with the same n-grams.
PIECE = 1 << 19
#: Most languages that prototypes are broadcast for; more are refused.
MAX_LANGUAGES = 10_000


@lru_cache(1)
def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


@lru_cache(1 << 13)
def _letter_vector(code: int) -> np.ndarray:
    """The random vector of a letter, the same in every task; 32 stands for all that is between words."""
    return np.random.default_rng([SEED, code]).integers(0, 2, DIM, np.int8) * 2 - 1


def _codes(points: np.ndarray) -> np.ndarray:
    """The n-grams of letters and single blanks, numbered by their letters."""
    n = len(points) - GRAM + 1
    if n < 1:
        return points[:0]
    codes = np.zeros(n, np.int64)
    for k in range(GRAM):
        codes = codes << 21 | points[k : k + n]
    return codes


def gram_codes(text: str) -> np.ndarray:
    """The n-grams of a lower-cased text; what lies between words is one blank."""
    return np.concatenate(list(gram_pieces(text)))


def gram_vectors(codes: np.ndarray) -> np.ndarray:
    """One bound vector per n-gram number."""
    out = np.ones((len(codes), DIM), np.int8)
    for k in range(GRAM):
        letters, at = np.unique(codes >> 21 * (GRAM - 1 - k) & 0x1FFFFF, return_inverse=True)
        out *= np.roll(np.array([_letter_vector(int(c)) for c in letters], np.int8).reshape(-1, DIM), GRAM - 1 - k, 1)[at]
    return out


def gram_pieces(text: str) -> Iterator[np.ndarray]:
    """The n-grams of a text, those of ``PIECE`` characters at a time; the ones over a cut belong to the later piece."""
    text, tail = text.lower(), np.array([32], np.int64)
    for k in range(0, max(1, len(text)), PIECE):
        end = " " if k + PIECE >= len(text) else ""
        points = np.frombuffer((text[k : k + PIECE] + end).encode("utf-32-le", "surrogatepass"), np.uint32)
        points = np.concatenate([tail, np.where(_letters()[points], points, 32).astype(np.int64)])
        points = points[np.concatenate([[True], (points[1:] != 32) | (points[:-1] != 32)])]
        yield _codes(points)
        tail = points[-(GRAM - 1) :]


def bundles(texts: list[str]) -> np.ndarray:
    """The vector of each text; zero for a text without letters."""
    out = np.zeros((len(texts), DIM), np.float32)
    queue: list[tuple[int, np.ndarray, np.ndarray]] = []

    def settle() -> None:
        if queue:
            known = np.unique(np.concatenate([codes for _, codes, _ in queue]))
            vectors = gram_vectors(known).astype(np.float32)
            for k, codes, n in queue:
                out[k] += n.astype(np.float32) @ vectors[np.searchsorted(known, codes)]
            queue.clear()

    held = 0
    for k, text in enumerate(texts):
        for codes in gram_pieces(text):
            if held + len(codes) > PIECE:
                settle()
                held = 0
            queue.append((k, *np.unique(codes, return_counts=True)))
            held += len(codes)
    settle()
    return out


def _bundle_languages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One sum per language and task: n-grams are counted first, each is bound once per batch."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        texts = np.array(batch.column(1).to_pylist(), object)
        for lang in set(langs):
            total, n, held = {}, 0, []
            for text in texts[langs == lang]:
                for grams in gram_pieces(text):
                    held.append(grams)
                    n += len(held[-1])
                    if n > PIECE:
                        _count(total, held)
                        n = 0
            _count(total, held)
            codes = np.fromiter(total, np.int64, len(total))
            counts = np.fromiter(total.values(), np.float64, len(total))
            vector = sums.setdefault(lang, np.zeros(DIM))
            for k in range(0, len(codes), 1 << 14):
                vector += counts[k : k + (1 << 14)] @ gram_vectors(codes[k : k + (1 << 14)]).astype(np.float64)
    vectors = [v.astype(np.int64) for v in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(vectors, pa.list_(pa.int64()))], ["lang", "vector"])


def _count(total: dict, held: list[np.ndarray]) -> None:
    if held:
        for code, n in zip(*(x.tolist() for x in np.unique(np.concatenate(held), return_counts=True)), strict=True):
            total[code] = total.get(code, 0) + n
        held.clear()


def prototypes(labelled: DataFrame) -> dict[str, np.ndarray]:
    """A unit vector per language from (lang, text); rows with a null in either are skipped.

    Sums of whole numbers are exact, so the order of the rows does not matter.
    """
    rows = labelled.where("lang is not null and text is not null").select(F.col("lang").cast("string"), F.col("text").cast("string"))
    parts = rows.mapInArrow(_bundle_languages, "lang string, vector array<bigint>").select("lang", F.posexplode("vector"))
    sums = parts.groupBy("lang", "pos").agg(F.sum("col").alias("v")).groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("pos", "v"))).alias("v"))
    found = sums.select("lang", F.col("v.v").alias("v")).limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    vectors = {r.lang: np.array(r.v, np.float64) for r in sorted(found, key=lambda r: r.lang)}
    return {lang: v / np.linalg.norm(v) for lang, v in vectors.items() if np.any(v)}


def _predict(batches: Iterator[pa.RecordBatch], names: list[str], matrix: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = bundles([t or "" for t in batch.column(1).to_pylist()])
        norms = np.linalg.norm(vectors, axis=1)
        cosines = vectors @ matrix.T / np.maximum(norms, 1e-30)[:, None]
        best = cosines.argmax(1) if names else np.zeros(len(vectors), int)
        known = (norms > 0) & bool(names)
        score = np.where(known, np.clip(cosines[np.arange(len(best)), best], 0, 1) if names else 0.0, 0.0)
        lang = [names[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score.astype(np.float64))], ["doc_id", "lang_pred", "score"])


def predict(docs: DataFrame, learned: dict[str, np.ndarray]) -> DataFrame:
    """(doc_id, lang_pred, score) per row of ``docs`` (doc_id, text, any other columns).

    ``score`` is the cosine, at least 0. A null text, or one without a letter, is ``und`` with score 0,
    and so is every text where nothing was learned; ties go to the first language by name. Repeated rows
    give equal rows; an empty table none.
    """
    matrix = np.array(list(learned.values()), np.float32).reshape(-1, DIM)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(partial(_predict, names=list(learned), matrix=matrix), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def held_out(doc_id: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder."""
    return F.crc32(F.col(doc_id).cast("string")) % parts == part
