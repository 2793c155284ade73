"""Language ID by rank-order profiles.

*Fit.* For each language the first ``SAMPLE`` labelled documents by a hash of their id (a documented bound) are read
whole; their n-grams of one to ``GRAMS`` letters, words padded by a space, are counted, and the ``TOP`` most frequent,
ties by code, are the language's profile.

*Predict.* A document's own ``TOP`` most frequent n-grams are ranked the same way. Its distance to a language is the
mean, over its n-grams, of how far the ranks are apart, and ``TOP`` for an n-gram that the profile lacks (out of place).
The nearest language is the answer (ties: first by name); ``score`` is one less its distance over ``TOP``.

Texts are taken whole, lower-cased, and only letters count. A text without a letter, empty or null is ``und`` with score
0, and so is every text if there is nothing to learn from. Rows that repeat an id are rows like others; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoweave.llm.keyed import ddl
from chronoweave.llm.vector import batch_of, table_rows

GRAMS, TOP, SAMPLE = 3, 300, 500
UNKNOWN = "und"
_LETTER = np.zeros(0x110000, dtype=bool)
_READY = False

_COUNT = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
_SAID = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def _letters() -> np.ndarray:
    global _READY
    if not _READY:
        _LETTER[[i for i in range(0x110000) if not 0xD800 <= i < 0xE000 and chr(i).isalpha()]] = True
        _READY = True
    return _LETTER


def grams(text: str) -> np.ndarray:
    """Codes of the n-grams of a text: runs of letters with a space before and after, 21 bits a place."""
    code = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[code]
    if not letter.any():
        return np.zeros(0, dtype=np.int64)
    code = np.where(letter, code, 32).astype(np.int64)
    code = code[np.append(letter[1:] | letter[:-1], True)]
    out, x, solid = [code[code != 32]], code, code != 32
    for n in range(2, GRAMS + 1):
        x = (x[:-1] << 21) | code[n - 1 :]
        good = solid[: len(x)] | solid[1 : len(x) + 1]
        for i in range(1, n - 1):  # a space stands only at an end
            good &= solid[i : i + len(x)]
        out.append(x[good])
    return np.concatenate(out)


def ranked(codes: np.ndarray, top: int) -> np.ndarray:
    """The most frequent codes, most frequent first, ties by code."""
    names, n = np.unique(codes, return_counts=True)
    if len(names) > top:
        least = np.partition(n, len(n) - top)[len(n) - top]
        names, n = names[n >= least], n[n >= least]
    return names[np.lexsort((names, -n))][:top]


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = {}
    for lang, text in table_rows(batches):
        names, n = np.unique(grams(text), return_counts=True)
        held.setdefault(lang, []).append((names, n))
    for lang, parts in held.items():
        names, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        n = np.bincount(at, np.concatenate([p[1] for p in parts]), len(names)).astype(np.int64)
        yield batch_of(_COUNT, [[lang] * len(names), names, n])


def first_ids(known: DataFrame, sample: int) -> DataFrame:
    """(doc_id, lang): the ``sample`` ids of each language with the least hashes, or all if it has fewer.

    Hashes are even, so those below eight times the share that is wanted hold enough; only they are ranked, a few thousand for a
    language however large it is. A language that repeats ids so often that they don't is looked through with a wider share.
    """
    ids = known.filter("doc_id is not null").select(F.col("doc_id"), "lang")
    share = F.shiftrightunsigned(F.xxhash64("doc_id"), 1) / F.lit(float(2**63))
    counts = {r["lang"]: r["n"] for r in ids.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    wide = {lang: 8.0 * sample / n for lang, n in counts.items()}
    while True:
        below = F.create_map(*[F.lit(x) for lang, w in wide.items() for x in (lang, w)]) if wide else F.create_map().cast("map<string,double>")
        some = ids.filter(share < F.element_at(below, F.col("lang"))).distinct()
        ranked_ids = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))).filter(F.col("rank") <= sample)
        held = {r["lang"]: r["n"] for r in ranked_ids.groupBy("lang").agg(F.count("*").alias("n")).collect()}
        few = [lang for lang, w in wide.items() if w < 1 and held.get(lang, 0) < sample]
        if not few:
            return ranked_ids.select("doc_id", "lang")
        wide |= {lang: 8 * wide[lang] for lang in few}


def fit(labelled: DataFrame, sample: int = SAMPLE, top: int = TOP) -> dict[str, np.ndarray]:
    """Profiles from (doc_id, text, lang); rows without a language or a text teach nothing."""
    known = labelled.filter("lang is not null and text is not null").select("doc_id", "text", "lang")
    ids = first_ids(known, sample)
    # langs * sample rows of two short columns
    chosen = known.join(F.broadcast(ids), ["doc_id", "lang"], "left_semi")
    counts = chosen.select("lang", F.col("text").cast("string")).mapInArrow(_count, ddl(_COUNT)).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    rows = counts.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).select("lang", "gram", "rank").collect()
    out: dict[str, list] = {}
    for lang, gram, _ in sorted(rows, key=lambda r: (r[0], r[2])):
        out.setdefault(lang, []).append(gram)
    return {lang: np.array(x, dtype=np.int64) for lang, x in sorted(out.items())}


def _judge(profiles: dict[str, np.ndarray], top: int):
    """A function of a text: its language and score."""
    names = list(profiles)
    every = np.unique(np.concatenate(list(profiles.values()))) if profiles else np.zeros(0, dtype=np.int64)
    place = np.full((len(names), len(every) + 1), -1, dtype=np.int32)
    for i, x in enumerate(profiles.values()):
        place[i, np.searchsorted(every, x)] = np.arange(len(x))

    def judge(text: str | None) -> tuple[str, float]:
        own = ranked(codes, top) if len(names) and text and len(codes := grams(text)) else None
        if own is None:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(every, own), len(every) - 1)
        at = np.where(every[at] == own, at, len(every))
        there = place[:, at]
        far = np.where(there < 0, top, np.abs(there - np.arange(len(own)))).sum(axis=1)
        i = int(np.argmin(far))
        return names[i], 1.0 - float(far[i]) / (top * len(own))

    return judge


def _say(batches: Iterable[pa.RecordBatch], profiles: dict[str, np.ndarray], top: int) -> Iterator[pa.RecordBatch]:
    judge = _judge(profiles, top)
    for batch in batches:
        if len(batch):
            yield batch_of(_SAID, list(zip(*((doc_id, *judge(text)) for doc_id, text in table_rows([batch])), strict=True)))


def _add(batches: Iterable[pa.RecordBatch], profiles: dict[str, np.ndarray], top: int, text: str, added: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    judge = _judge(profiles, top)
    for batch in batches:
        if len(batch):
            said = [judge(t) for t in batch[text].to_pylist()]
            langs, scores = zip(*said, strict=True)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*batch.schema.names, *added])


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], top: int = TOP) -> DataFrame:
    """doc_id, lang_pred, score for each document, from its text alone."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(lambda it: _say(it, profiles, top), ddl(_SAID))


def annotate(docs: DataFrame, profiles: dict[str, np.ndarray], top: int = TOP, text: str = "text", names: tuple[str, str] = ("_lang_pred", "_lang_score")) -> DataFrame:
    """The documents, all columns, with the language and its score under two ``names`` that no column has."""
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    return docs.mapInArrow(lambda it: _add(it, profiles, top, text, names), schema)
