"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram is bound by multiplying its letters' vectors, each
permuted (rotated) by its place; a text is the bundle (sum) of its n-grams, a language the bundle of its
texts. A document gets the language whose prototype has the largest cosine with it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.text import free_name, slabs, whole_text

UNKNOWN = "und"
#: Length of the vectors, letters per n-gram, and letters that have a vector of their own: lower-case letters up to
#: this code point; later ones share vectors by code point.
DIMENSIONS = 1024
GRAM = 3
LETTERS = 1024
SEED = 7
#: Distinct n-grams that are held as vectors at once.
BLOCK = 4096

_tables: dict[str, np.ndarray] = {}


def letter_table() -> np.ndarray:
    """For every code point: 0 if it is no letter, else the number of its lower-case letter."""
    if "letters" not in _tables:
        table = np.zeros(0x110000, np.int16)
        for c in range(0x110000):
            if unicodedata.category(chr(c))[0] == "L":
                low = chr(c).lower()
                table[c] = 1 + (ord(low) if len(low) == 1 else c) % (LETTERS - 1)
        _tables["letters"] = table
    return _tables["letters"]


def letter_vectors() -> np.ndarray:
    if "vectors" not in _tables:
        _tables["vectors"] = np.random.default_rng(SEED).integers(0, 2, (LETTERS, DIMENSIONS), dtype=np.int8) * 2 - 1
    return _tables["vectors"]


def gram_vectors(codes: np.ndarray) -> np.ndarray:
    """The bound vectors of n-grams, one row each."""
    vectors, out = letter_vectors(), None
    for place in range(GRAM):
        letter = (codes >> np.int64(10 * place)) & (LETTERS - 1)
        turned = np.roll(vectors, place, axis=1)[letter]
        out = turned if out is None else out * turned
    return out.astype(np.float32)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of each text as (text, code, count). Everything between letters counts as one blank."""
    lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts)) + 2  # a blank before and after each text
    points = np.frombuffer((" " + "  ".join(texts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = letter_table()[points]
    keep = letters > 0
    keep[:-1] |= keep[1:]  # a blank stays where a letter comes next
    ends = np.cumsum(lengths) - 1
    has = np.add.reduceat(letters > 0, ends + 1 - lengths) > 0 if len(texts) else np.empty(0, bool)
    keep[ends[has]] = True  # and at the end
    letters = letters[keep].astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)[keep]
    if len(letters) < GRAM:
        return (np.empty(0, np.int64),) * 3
    code = np.zeros(len(letters) - GRAM + 1, np.int64)
    for place in range(GRAM):
        code |= letters[GRAM - 1 - place : len(letters) - place] << np.int64(10 * place)
    same = owner[GRAM - 1 :] == owner[: len(code)]
    both = (owner[: len(code)][same] << np.int64(10 * GRAM)) | code[same]
    both.sort()
    first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.empty(0, np.int64)
    counts = np.diff(np.concatenate([first, [len(both)]]))
    return both[first] >> np.int64(10 * GRAM), both[first] & np.int64((1 << 10 * GRAM) - 1), counts


def bundles(doc: np.ndarray, code: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """The bundle of each of ``n`` texts."""
    out = np.zeros((n, DIMENSIONS), np.float32)
    distinct, at = np.unique(code, return_inverse=True)
    for low in range(0, len(distinct), BLOCK):
        here = (at >= low) & (at < low + BLOCK)
        counts = np.zeros((n, min(BLOCK, len(distinct) - low)), np.float32)
        counts[doc[here], at[here] - low] = count[here]
        out += counts @ gram_vectors(distinct[low : low + BLOCK])
    return out


@dataclass(frozen=True)
class Profiles:
    """Prototypes of the languages, ordered by name. A few KB for each language, whatever the corpus."""

    languages: tuple[str, ...]
    vectors: np.ndarray


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for slab in slabs(batches):
        langs = slab.column(1).to_pylist()
        names = sorted(set(langs))
        doc, code, count = grams(slab.column(0).to_pylist())
        group = np.array([names.index(x) for x in langs], np.int64)[doc]
        both, at = np.unique((group << np.int64(10 * GRAM)) | code, return_inverse=True)
        totals = np.bincount(at, count, len(both))
        whole = np.zeros((len(names), DIMENSIONS), np.float64)
        for low in range(0, len(both), BLOCK):
            part = both[low : low + BLOCK]
            weights = np.zeros((len(names), len(part)))
            weights[part >> np.int64(10 * GRAM), np.arange(len(part))] = totals[low : low + BLOCK]
            whole += weights @ gram_vectors(part & np.int64((1 << 10 * GRAM) - 1))
        for name, row in zip(names, whole, strict=True):
            sums[name] = sums.get(name, 0) + row
    for name, row in sums.items():
        yield pa.RecordBatch.from_pydict({"lang": [name] * DIMENSIONS, "place": np.arange(DIMENSIONS, dtype=np.int32), "total": row.astype(np.int64)})


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Prototypes from all rows whose language is given. Sums are of integers, so reruns agree to the last bit.

    Each task bundles its texts to one vector per language; only these sums are shuffled and returned.
    Null texts and texts without letters add nothing; rows without a language are left out; an empty table
    gives no languages.
    """
    rows = labelled.where(F.col(f"`{lang_col}`").isNotNull()).select(
        whole_text(text_col).alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")
    )
    sums = rows.mapInArrow(_learn, "lang string, place int, total long").groupBy("lang", "place").agg(F.sum("total").alias("total"))
    vectors: dict[str, np.ndarray] = {}
    for r in sums.collect():
        vectors.setdefault(r["lang"], np.zeros(DIMENSIONS))[r["place"]] = r["total"]
    names = tuple(sorted(n for n, v in vectors.items() if v.any()))
    table = np.array([vectors[n] / np.linalg.norm(vectors[n]) for n in names], np.float32).reshape(len(names), DIMENSIONS)
    return Profiles(names, table)


def predict(docs: DataFrame, profiles: Profiles, text_col: str = "text") -> DataFrame:
    """``docs`` with two more columns: ``lang_pred`` and ``score``, the cosine with that language, 0 to 1.

    A text that is null or has no letter is ``und`` with score 0, and so is every text if no language was learned.
    Equal cosines go to the first language by name. Other columns pass through; if they bear one of the two names, they
    are replaced. An empty table gives no rows. Only the text is looked at.
    """
    languages, vectors = profiles.languages, profiles.vectors

    def run(batches):
        for slab in slabs(batches, mark):
            texts = slab.column(mark).to_pylist()
            doc, code, count = grams(texts)
            found, score = np.full(len(texts), -1), np.zeros(len(texts))
            if len(languages) and len(doc):
                bundle = bundles(doc, code, count, len(texts))
                norm = np.linalg.norm(bundle, axis=1)
                cosine = (bundle @ vectors.T) / np.maximum(norm, 1e-30)[:, None]
                some = np.bincount(doc, minlength=len(texts)) > 0
                found[some] = cosine.argmax(axis=1)[some]
                score[some] = np.clip(cosine.max(axis=1), 0, 1)[some]
            names = [languages[i] if i >= 0 else UNKNOWN for i in found]
            kept = [slab.column(i) for i, c in enumerate(slab.schema.names) if c != mark]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(names, pa.string()), pa.array(score)], names=[*columns, "lang_pred", "score"])

    mark = free_name(docs, "langid_text")
    plain = docs.drop("lang_pred", "score")
    columns = plain.columns
    schema = plain.schema.add("lang_pred", "string").add("score", "double")
    return plain.withColumn(mark, whole_text(text_col)).mapInArrow(run, schema)


def identify(docs: DataFrame, training: Column, text_col: str = "text", lang_col: str = "lang", keep: tuple[Column, ...] = ()) -> DataFrame:
    """Learn from the rows for which ``training`` holds, then predict all rows; returns ``keep``, ``lang_pred``, ``score``."""
    profiles = learn(docs.where(training), text_col, lang_col)
    name = free_name(docs.select(*keep), "text")
    return predict(docs.select(*keep, F.col(f"`{text_col}`").alias(name)), profiles, name).drop(name)
