"""Quality rules: base rules, then a log-likelihood ratio of hashed n-grams between trusted text and the whole corpus.

Base rules count words, their characters, symbols, repeated lines and words in repeated five-word windows; a document
with under ``MIN_WORDS`` words, or over ``MAX_REPEAT`` per cent repeated words, fails.

Every document's character n-grams (``GRAM`` code points of the text with white space made one space) are hashed to
``BUCKETS`` buckets. Two multinomials with add-one smoothing are counted from them: *raw* from all documents, *trusted*
from all those whose id is labelled good, found by a join on the cluster: no list of ids is held anywhere. A document's score
is the sum of log(trusted / raw) over its n-grams divided by their number. It is kept if it passes the base rules and its score
is at least the mean of all documents labelled good less some standard deviations of theirs; every document meets the same
threshold, and equal texts the same verdict.

How many deviations is read from all labelled documents that pass the base rules: of 0 to ``SPREAD`` in steps of 1 / ``STEPS``, the
number with the greatest share of labelled bad documents refused less the share of good ones refused, and of equal ones the least.
A good document's score is taken here without its own n-grams among the trusted, as that of a document like it but without a label.
Only numbers count at which (good ones refused + 1) / (good ones + 1) is at most one in ``SPREAD`` squared: no more documents like the
trusted are then refused, whatever the spread of their scores. Where none counts (under 63 good documents, say), it is ``SPREAD``, which
promises the same by Chebyshev's inequality but refuses only what lies far off. A caller may give a number instead.

Null and empty texts have no words and fail. With no trusted document the ratio is 0 for all and the base rules decide.
Rows that repeat an id are rows like others; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.keyed import ddl
from chronoweave.llm.store import settle
from chronoweave.llm.vector import SPACE, Words, batch_of, lean, mixed, parcels, rolling, run_bounds, table_rows

MIN_WORDS, MAX_REPEAT = 10, 20
GRAM, BUCKETS, TRUSTED, SPREAD, STEPS = 3, 1 << 14, 20_000, 8, 16
PIECE_BYTES, PARTS = 1 << 20, 16

SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

_SCORED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("score", pa.float64()), ("unseen", pa.float64())])
_COUNTED = pa.schema([("part", pa.int32()), ("counts", pa.binary())])


def grams(text: str) -> np.ndarray:
    """The buckets of a text's n-grams."""
    code = np.frombuffer(" ".join(text.split()).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if len(code) < GRAM:
        return np.zeros(0, dtype=np.int64)
    x = code[: len(code) - GRAM + 1].copy()
    for i in range(1, GRAM):
        x = (x << np.uint64(21)) | code[i : len(code) - GRAM + 1 + i]
    return (mixed(x) >> np.uint64(50)).astype(np.int64) % BUCKETS


def base_counts(texts: list[bytes]) -> np.ndarray:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    words = Words(texts)
    n = np.diff(words.first)
    head = (words.buf & 0xC0) != 0x80
    solid = np.concatenate([[0], np.cumsum(head & ~SPACE[words.buf])])
    symbols = np.concatenate([[0], np.cumsum(SYMBOL[words.buf])])
    a, b = words.doc_start[:-1], words.doc_start[1:]
    lines = []
    for t in texts:
        own = [x for x in t.split(b"\n") if x.strip(b" \t\r\x0b\x0c")] if b"\n" in t else ()
        lines.append(len(own) - len(set(own)))
    doc = np.repeat(np.arange(len(texts)), n)
    five = rolling(words.hash, 5)
    whole = np.flatnonzero(doc[: len(five)] == doc[4:]) if len(five) else np.zeros(0, dtype=np.int64)
    order = whole[np.lexsort((five[whole], doc[whole]))]
    same = (five[order][1:] == five[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    many = np.zeros(len(order), dtype=bool)
    many[1:] |= same
    many[:-1] |= same
    cover = np.zeros(len(doc) + 1, dtype=np.int32)
    np.add.at(cover, order[many], 1)
    np.add.at(cover, order[many] + 5, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
    return np.stack([n, solid[b] - solid[a], symbols[b] - symbols[a], np.array(lines, dtype=np.int64), covered[words.first[1:]] - covered[words.first[:-1]]], axis=1)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts of a task's texts, ``PARTS`` rows at most: a part of the buckets, and its counts one after another."""
    total = np.zeros(BUCKETS, dtype=np.int64)
    for rows in parcels(table_rows(batches), lambda r: len(r[0]) + 64, PIECE_BYTES):
        total += np.bincount(np.concatenate([grams(t) for (t,) in rows]), minlength=BUCKETS)
    parts = [(i, x.tobytes()) for i, x in enumerate(total.reshape(PARTS, -1)) if x.any()]
    if parts:
        yield batch_of(_COUNTED, list(zip(*parts, strict=True)))


def _sum(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the counts of each part that has come to this task."""
    total: dict[int, np.ndarray] = {}
    for part, counts in table_rows(batches):
        total[part] = total.get(part, 0) + np.frombuffer(counts, dtype=np.int64)
    if total:
        yield batch_of(_COUNTED, [list(total), [x.tobytes() for x in total.values()]])


def unseen_by(g: np.ndarray, good: np.ndarray) -> float:
    """What a trusted text's score changes by when its n-grams are taken out of the trusted counts, which are one more than seen."""
    if not len(g):
        return 0.0
    x, n, total = np.bincount(g, minlength=BUCKETS), len(g), good.sum()
    b = np.flatnonzero(x)
    # Texts that are not trusted have no use for this; the bounds only keep their logarithms finite.
    return float((x[b] * np.log1p(-np.minimum(x[b], good[b] - 1) / good[b])).sum() / n - np.log1p(-min(n, total - BUCKETS) / total))


def _score(batches: Iterable[pa.RecordBatch], ratio: np.ndarray, good: np.ndarray, min_words: int, max_repeat: int) -> Iterator[pa.RecordBatch]:
    lean()
    for rows in parcels(table_rows(batches), lambda r: len(r[1]) + 64, PIECE_BYTES):
        counts = base_counts([t.encode() for _, t in rows])
        score = np.zeros((len(rows), 2))
        for i, (_, t) in enumerate(rows):
            g = grams(t)
            score[i] = float(ratio[g].mean()) if len(g) else 0.0
            score[i, 1] += unseen_by(g, good)
        failed = (counts[:, 0] < min_words) | (100 * counts[:, 4] > max_repeat * counts[:, 0])
        yield batch_of(_SCORED, [[r[0] for r in rows], *counts.T, failed, *score.T])


def _labelled(labels: DataFrame, quality: int) -> DataFrame:
    return labels.filter((F.col("quality") == quality) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()


def trusted_ids(labels: DataFrame, most: int = TRUSTED) -> np.ndarray:
    """Ids labelled good (quality 1), ``most`` of them at most, the first by hash: a bounded list to look at. The fit reads all ids."""
    rows = _labelled(labels, 1).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()
    return np.sort(np.array([r[0] for r in rows], dtype=np.int64))


def gram_counts(texts: DataFrame) -> np.ndarray:
    """How often the n-grams of each bucket stand in all texts."""
    out = np.zeros((PARTS, BUCKETS // PARTS))
    for r in texts.select("text").mapInArrow(_count, ddl(_COUNTED)).repartition("part").mapInArrow(_sum, ddl(_COUNTED)).collect():
        out[r["part"]] = np.frombuffer(r["counts"], dtype=np.int64)
    return out.reshape(-1)


def fitted_spread(good: DataFrame, bad: DataFrame, mean: float, wide: float) -> float:
    """The number of deviations under the mean that best tells good documents, scored as unseen, from bad ones."""
    # A document of step s is refused at fewer than s steps; the last step stands for all that lies further off.
    last = SPREAD * STEPS + 1
    both = good.select(F.col("unseen").alias("score"), F.lit(1).alias("ok")).unionAll(bad.select("score", F.lit(0).alias("ok")))
    off = (F.lit(mean) - F.col("score")) * STEPS / F.lit(wide)
    step = F.ceil(F.greatest(F.lit(0.0), F.least(off, F.lit(float(last))))).alias("step")
    rows = both.groupBy(step, "ok").count().collect()
    n = np.zeros((2, last + 1))
    for r in rows:
        n[r["ok"], r["step"]] = r["count"]
    refused = n.sum(axis=1, keepdims=True) - np.cumsum(n, axis=1)[:, :last]
    gain = refused[0] / max(1, n[0].sum()) - refused[1] / n[1].sum()
    gain[(refused[1] + 1) * SPREAD**2 > n[1].sum() + 1] = -np.inf
    return int(np.argmax(gain)) / STEPS if np.isfinite(gain).any() else SPREAD


def quality_rules(docs: DataFrame, labels: DataFrame, min_words: int = MIN_WORDS, max_repeat: int = MAX_REPEAT, spread: float | None = None) -> DataFrame:
    """Counts, base_failed, kept and score for each document."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # The same plan at every size, and one that doesn't sort texts: they stream past the ids of their partition.
    seen = gram_counts(texts.join(_labelled(labels, 1).hint("shuffle_hash"), "doc_id", "left_semi"))
    raw, good = gram_counts(texts) + 1, seen + 1
    # Buckets seen nowhere in either carry no weight; scores of trusted documents follow from the same table.
    ratio = np.log(good / good.sum()) - np.log(raw / raw.sum()) if seen.any() else np.zeros(BUCKETS)
    scored = texts.mapInArrow(lambda it: _score(it, ratio, good, min_words, max_repeat), ddl(_SCORED))
    least = float("-inf")
    if seen.any():
        # Scored once: the threshold and the result read the same narrow rows.
        scored = settle(scored, "scored")
        fit = scored.filter("not base_failed").select("doc_id", "score", "unseen")
        own = fit.join(_labelled(labels, 1), "doc_id", "left_semi")
        mean, wide = own.agg(F.avg("score"), F.stddev_pop("score")).first()
        if mean is not None:
            if spread is None:
                spread = fitted_spread(own, fit.join(_labelled(labels, 0), "doc_id", "left_semi"), mean, wide) if wide > 0 else 0.0
            least = mean - spread * wide
    kept = scored.withColumn("kept", ~F.col("base_failed") & (F.round("score", 9) >= F.lit(round(least, 9))))
    return kept.select(*[c for c in kept.columns if c not in ("score", "unseen")], "score")
