"""Substring dedup by fixed-block anchors: words of passages that occur more than once are removed everywhere.

A window is ``window`` consecutive words of one document. Any window holds a whole block of ``(window + 1) // 2``
words that starts at a multiple of that length in its document, so:

1. *Index and probe.* Each document's non-overlapping blocks are indexed by hash, and every rolling window of
   block length, of every document, probes the index. Keys are dealt to buckets by hash; what travels is one
   sorted, compressed blob for each map batch and bucket, never a row for each probe. A batch sends a key twice at
   most (twice is all a repeat needs) and settles blocks that repeat within it, so a passage that fills a third
   of the corpus costs one entry for each batch.
2. *Extend.* A block with a second occurrence anywhere is a hit. Around its hits each document forms the windows
   that hold the whole hit block; those are compared by an 80-bit hash, again by buckets of blobs. The windows found
   twice, joined where they overlap, are exactly the maximal repeats of at least ``window`` words.
3. *Cut.* Words covered by a repeated window go.

Nulls and empty texts have no words; texts shorter than a window lose nothing. Each row is a document: rows that
repeat a text, with the same id or another, are copies and lose the windows they share. Extra columns are ignored,
whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.keyed import bucket_bits, by_group, ddl, deltas, pack, settled, task_part, total_bytes, unpack, with_key
from chronoweave.llm.vector import Words, batch_of, lean, mixed, parcels, rolling, run_bounds, table_rows

WINDOW = 35
#: Bytes of text whose keys one bucket holds, and that one map batch gathers before it sends its blobs.
BUCKET_BYTES = 8 << 20
FLUSH_BYTES = 6 << 20
PIECE_BYTES = 512 << 10

_PROBE = pa.schema([("bucket", pa.int64()), ("probes", pa.binary()), ("blocks", pa.binary()), ("k1", pa.int64()), ("did", pa.int64()), ("block", pa.int32())])
_HIT = pa.schema([("k1", pa.int64()), ("did", pa.int64()), ("block", pa.int32())])
_WINDOW = pa.schema([("bucket", pa.int64()), ("part", pa.int64()), ("found", pa.binary()), ("docs", pa.binary())])
_FOUND = pa.schema([("part", pa.int64()), ("found", pa.binary()), ("docs", pa.binary())])
_RUNS = pa.schema([("k1", pa.int64()), ("did", pa.int64()), ("runs", pa.binary())])
_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("n_spans", pa.int64()), ("kept", pa.string())])


def _doc_of_word(words: Words) -> np.ndarray:
    return np.repeat(np.arange(len(words)), np.diff(words.first))


def _whole(words: Words, n: int) -> np.ndarray:
    """Which rolling windows of n words lie within one document."""
    doc = _doc_of_word(words)
    return doc[: max(0, len(doc) - n + 1)] == doc[n - 1 :]


def _dealt(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the buckets in sorted hashes, and the numbers of those that have any."""
    bounds = np.searchsorted(hashes >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
    return bounds, np.flatnonzero(np.diff(bounds))


def _send_probes(batches: Iterable[pa.RecordBatch], size: int, bits: int) -> Iterator[pa.RecordBatch]:
    def flush(rows: list, part: int) -> Iterator[pa.RecordBatch]:
        probes, keys, ids, numbers, blocks = [], [], [], [], []
        for piece in parcels(rows, lambda r: len(r[2]), PIECE_BYTES):
            words = Words([r[2] for r in piece])
            hashes = rolling(words.hash, size)
            whole = _whole(words, size)
            probes.append(hashes[whole])
            doc = _doc_of_word(words)[: len(hashes)]
            place = np.arange(len(hashes)) - words.first[doc]
            at = np.flatnonzero(whole & (place % size == 0))
            blocks.append(hashes[at])
            numbers.append((place[at] // size).astype(np.int32))
            keys.append(np.array([r[0] for r in piece], dtype=np.int64)[doc[at]])
            ids.append(np.array([r[1] for r in piece], dtype=np.int64)[doc[at]])
        low = np.uint64(64 - bits - 32)
        probe = np.sort(np.concatenate(probes) >> low)
        block = np.concatenate(blocks) >> low
        key, ident, number = np.concatenate(keys), np.concatenate(ids), np.concatenate(numbers)
        many = np.searchsorted(probe, block, "right") - np.searchsorted(probe, block, "left") >= 2
        here = [np.flatnonzero(many), np.flatnonzero(~many)]
        if len(here[0]):
            blank = [None] * len(here[0])
            yield batch_of(_PROBE, [settled(len(blank), part), blank, blank, key[here[0]], ident[here[0]], number[here[0]]])
        third = np.zeros(len(probe), dtype=bool)
        third[2:] = probe[2:] == probe[:-2]
        probe = probe[~third]
        alone = here[1][np.argsort(block[here[1]], kind="stable")]
        block, key, ident, number = block[alone], key[alone], ident[alone], number[alone]
        bounds, used = _dealt(probe << low, bits)
        cuts = np.searchsorted(block >> np.uint64(32), np.arange((1 << bits) + 1, dtype=np.uint64))
        mask = np.uint64(0xFFFFFFFF)
        out = [[], [], []]
        for b in used:
            i, j = cuts[b], cuts[b + 1]
            out[0].append(int(b))
            out[1].append(pack(deltas((probe[bounds[b] : bounds[b + 1]] & mask).astype(np.uint32))))
            out[2].append(pack((block[i:j] & mask).astype(np.uint32), key[i:j], ident[i:j], number[i:j]) if j > i else None)
        if used.size:
            blank = [None] * len(out[0])
            yield batch_of(_PROBE, [*out, blank, blank, blank])

    lean()
    rows = ((k1, did, text.encode()) for did, k1, text in table_rows(batches))
    for n, held in enumerate(parcels(rows, lambda r: len(r[2]) + 64, FLUSH_BYTES)):
        yield from flush(held, task_part(n))


def _match_probes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one bucket: the blocks whose key occurs at two places or more. What a map batch settled passes through."""
    probes, blocks = [], []
    for batch in batches:
        done = batch.filter(pa.compute.less(batch["bucket"], 0))
        if len(done):
            yield done.select(_HIT.names).cast(_HIT)
    for bucket, probe, block, *_ in table_rows(batches):
        if bucket < 0:
            continue
        probes.append(np.cumsum(unpack(probe)[0], dtype=np.uint32))
        if block is not None:
            blocks.append(unpack(block))
    if blocks:
        probe = np.sort(np.concatenate(probes))
        block, key, ident, number = (np.concatenate(x) for x in zip(*blocks, strict=True))
        many = np.searchsorted(probe, block, "right") - np.searchsorted(probe, block, "left") >= 2
        yield batch_of(_HIT, [key[many], ident[many], number[many]])


def _send_windows(batches: Iterable[pa.RecordBatch], size: int, window: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Windows around hits. Within a batch, a window is (index of its first word among the batch's words)."""

    def flush(rows: list, part: int) -> Iterator[pa.RecordBatch]:
        hashes, more, where, starts, base = [], [], [], [], 0
        for piece in parcels(rows, lambda r: len(r[2]), PIECE_BYTES):
            words = Words([r[2] for r in piece])
            count = np.diff(words.first)
            starts.append(base + words.first[:-1])
            near = np.zeros(len(words.start) + 1, dtype=np.int32)
            for d, (_, _, _, hits) in enumerate(piece):
                q = np.array(hits, dtype=np.int64) * size
                np.add.at(near, words.first[d] + np.maximum(q + size - window, 0), 1)
                np.add.at(near, words.first[d] + np.minimum(q, count[d] - 1) + 1, -1)
            whole = _whole(words, window)
            at = np.flatnonzero((np.cumsum(near)[: len(whole)] > 0) & whole)
            hashes.append(rolling(words.hash, window)[at])
            more.append((rolling(mixed(words.hash ^ np.uint64(0x5851F42D4C957F2D)), window)[at] >> np.uint64(48)).astype(np.uint16))
            where.append(base + at)
            base += len(words.start)
        found, low, at = np.concatenate(hashes), np.concatenate(more), np.concatenate(where).astype(np.uint32)
        order = np.lexsort((low, found))
        found, low, at = found[order], low[order], at[order]
        first = np.ones(len(found), dtype=bool)
        first[1:] = (found[1:] != found[:-1]) | (low[1:] != low[:-1])
        again = ~first
        again[:-1] |= ~first[1:]
        table = pack(np.array([r[0] for r in rows], dtype=np.int64), np.array([r[1] for r in rows], dtype=np.int64), np.concatenate(starts).astype(np.int64))
        yield batch_of(_WINDOW, [settled(1, part), [part], [pack(np.sort(at[again]))], [table]])
        found, low, at = found[first], low[first], at[first]
        bounds, used = _dealt(found, bits)
        out = []
        for b in used:
            i, j = bounds[b], bounds[b + 1]
            by_place = i + np.argsort(at[i:j])
            out.append(pack(found[by_place], low[by_place], deltas(at[by_place])))
        if out:
            yield batch_of(_WINDOW, [used.astype(np.int64), [part] * len(out), out, [None] * len(out)])

    lean()
    rows = ((k1, did, text.encode(), hits) for did, k1, _, text, hits in table_rows(batches))
    for n, held in enumerate(parcels(rows, lambda r: len(r[2]) + 64, FLUSH_BYTES)):
        yield from flush(held, task_part(n))


def _match_windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one bucket: the windows that two batches or more have, by batch. What a batch settled passes through."""
    parts, found, low, at = [], [], [], []
    for bucket, part, blob, docs in table_rows(batches):
        if bucket < 0:
            yield batch_of(_FOUND, [[part], [blob], [docs]])
            continue
        f, x, d = unpack(blob)
        parts.append(np.full(len(f), part, dtype=np.int64))
        found.append(f)
        low.append(x)
        at.append(np.cumsum(d, dtype=np.uint32))
    if not parts:
        return
    parts, found, low, at = map(np.concatenate, (parts, found, low, at))
    order = np.lexsort((low, found))
    f, x = found[order], low[order]
    same = (f[1:] == f[:-1]) & (x[1:] == x[:-1])
    many = np.zeros(len(f), dtype=bool)
    many[1:] |= same
    many[:-1] |= same
    chosen = order[many]
    chosen = chosen[np.lexsort((at[chosen], parts[chosen]))]
    names, cuts = np.unique(parts[chosen], return_index=True)
    cuts = np.append(cuts, len(chosen))
    out = [pack(at[chosen[cuts[i] : cuts[i + 1]]]) for i in range(len(names))]
    if out:
        yield batch_of(_FOUND, [names, out, [None] * len(out)])


def _runs_of(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Of one map batch: for each document with repeats, its maximal runs of covered words."""
    table, found = None, []
    for _, blob, docs in table_rows(batches):
        found.append(unpack(blob)[0])
        if docs is not None:
            table = unpack(docs)
    at = np.unique(np.concatenate(found)).astype(np.int64)
    if not len(at):
        return
    key, ident, start = table
    doc = np.searchsorted(start, at, "right") - 1
    new = np.ones(len(at), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + window)
    head = np.flatnonzero(new)
    tail = np.append(head[1:] - 1, len(at) - 1)
    doc, begin, end = doc[head], at[head] - start[doc[head]], at[tail] + window - start[doc[head]]
    names, cuts = np.unique(doc, return_index=True)
    cuts = np.append(cuts, len(doc))
    out = [np.stack([begin[cuts[i] : cuts[i + 1]], end[cuts[i] : cuts[i + 1]]]).astype(np.int64).tobytes() for i in range(len(names))]
    yield batch_of(_RUNS, [key[names], ident[names], out])


def _cut_words(batches: Iterable[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for _, _, doc_id, text, runs in table_rows([batch]):
            words = text.encode().split()
            spans = np.frombuffer(runs, dtype=np.int64).reshape(2, -1).T if runs is not None else ()
            kept, at, removed = [], 0, 0
            for i, j in spans:
                kept += words[at:i]
                removed += int(j - i)
                at = j
            kept = b" ".join(kept + words[at:] if at else words)
            out.append((doc_id, len(words), removed, hashlib.sha256(kept).hexdigest(), len(spans), kept.decode() if with_text else None))
        if out:
            yield batch_of(_KEPT, list(zip(*out, strict=True)))


def substring_dedup(docs: DataFrame, window: int = WINDOW, with_text: bool = False, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, n_spans and, if asked for, the kept text, for each document.

    ``window`` is 3 words at least. The plan shuffles the texts once (both joins use one exchange).
    """
    size = (window + 1) // 2
    keyed = with_key(docs)
    bits = bucket_bits(total_bytes(docs), bucket_bytes)
    sent = keyed.select("did", "k1", "text").mapInArrow(lambda it: _send_probes(it, size, bits), ddl(_PROBE))
    hits = by_group(sent, "bucket", _match_probes, _HIT).groupBy("did", "k1").agg(F.collect_list("block").alias("hits"))
    near = keyed.join(hits.hint("merge"), ["did", "k1"])
    windows = near.mapInArrow(lambda it: _send_windows(it, size, window, bits), ddl(_WINDOW))
    found = by_group(windows, "bucket", _match_windows, _FOUND)
    runs = by_group(found, "part", lambda it: _runs_of(it, window), _RUNS).groupBy("did", "k1").agg(F.first("runs").alias("runs"))
    cut = keyed.join(runs.hint("merge"), ["did", "k1"], "left").mapInArrow(lambda it: _cut_words(it, with_text), ddl(_KEPT))
    return cut if with_text else cut.drop("kept")
