"""Suffix-array dedup: every byte covered by a string of ``length`` bytes that also starts earlier is removed.

"Earlier" is a smaller doc_id, or an earlier start in the same document; strings are compared on the input and never
cross documents.

All suffixes of a corpus with the bytes that decide their order would be a hundred times the corpus, so the suffix
array is *sparse*: of the k-grams in a window, the one with the least hash (leftmost on ties) is its anchor. Equal windows
have equal anchors at equal places, so it is enough to sort the suffixes that start at anchors. Consecutive windows with
one anchor travel as one string of ``length`` + (windows - 1) bytes.

1. *Sampled splitters* range-partition the anchored suffixes by their leading bytes. A map batch first drops strings
   that repeat within it (they are removed bytes already), so a hot passage costs one string for each batch. K-grams that
   the sample shows to be frequent are anchors only of windows that hold nothing else, so that a common phrase, whose
   suffixes must all meet, doesn't bring all that surrounds it into one bucket.
2. *Buckets sort locally by multikey quicksort*, eight bytes at a time and only where suffixes still tie; strings that
   tie to their ends are copies, of which the earliest stays. Neighbours' common prefixes tell which of the others
   can share a window at all; their windows are compared one by one.
3. *Across boundaries*: splitters are whole leading k-grams, so suffixes that share a k-gram never stand on two sides of
   a boundary. A window that two strings share holds the k-gram of both, but not what follows it, so strings apart after the
   k-gram must still meet: a boundary within a k-gram's suffixes would have to be compared with all of them, not with neighbours.

Null texts are empty; texts shorter than ``length`` lose nothing; of rows that share a doc_id, the text's hash decides
which is earlier, and rows that repeat id and text are one document whose result all of them get; a null id comes
before all others; extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.keyed import bucket_bits, by_group, ddl, deltas, pack, settled, task_part, total_bytes, unpack, with_key
from chronoweave.llm.ranks import ranked_within
from chronoweave.llm.store import settle
from chronoweave.llm.vector import BYTE_CODE, batch_of, lean, parcels, rolling, runs_union, sliding_min, table_rows

LENGTH = 100
ANCHOR = 16
#: Bytes of text whose suffixes one bucket sorts; that one map batch gathers; that numpy works on at a time.
BUCKET_BYTES = 4 << 20
FLUSH_BYTES = 12 << 20
PIECE_BYTES = 1 << 20
#: Bytes of text sampled for each splitter, about 50 suffixes; a k-gram that is a HOT part of as many is frequent.
SAMPLE_BYTES, HOT = 8 << 10, 0.5
HOT_BITS = 22

_SENT = pa.schema([("bucket", pa.int64()), ("part", pa.int64()), ("places", pa.binary()), ("strings", pa.binary()), ("docs", pa.binary())])
_RUN = pa.schema([("part", pa.int64()), ("found", pa.binary()), ("docs", pa.binary())])
_RUNS = pa.schema([("k1", pa.int64()), ("did", pa.int64()), ("runs", pa.binary())])
_KEPT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def _chunks(rows: list, length: int) -> Iterator[tuple[int, int, bytes]]:
    """(document, its first byte here, bytes): long documents in pieces that overlap by length - 1."""
    for d, row in enumerate(rows):
        text = row[2]
        for at in range(0, max(1, len(text) - length + 1), PIECE_BYTES):
            yield d, at, text[at : at + PIECE_BYTES + length - 1] if len(text) > PIECE_BYTES else text


def hot_map(leads: list[bytes]) -> np.ndarray | None:
    """Which low bits of a k-gram's hash stand for a frequent one. Others may share them: that moves an anchor, never a result."""
    if not leads:
        return None
    out = np.zeros(1 << HOT_BITS, dtype=np.uint8)
    for lead in leads:
        out[int(rolling(BYTE_CODE[np.frombuffer(lead, dtype=np.uint8)], len(lead))[0]) & ((1 << HOT_BITS) - 1)] = 1
    return out


def _strings(piece: list, length: int, k: int, hot: np.ndarray | None = None) -> tuple:
    """The anchored strings of a piece: buffer, document, start in it, bounds in the buffer, anchor."""
    raw = b"\n".join(x[2] for x in piece)
    buf = np.frombuffer(raw, dtype=np.uint8)
    size = np.array([len(x[2]) for x in piece], dtype=np.int64)
    first = np.cumsum(size + 1) - size - 1
    grams = rolling(BYTE_CODE[buf], k)
    keys = (grams & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(grams), dtype=np.uint64)
    if hot is not None:
        keys = (keys & np.uint64(0x7FFFFFFFFFFFFFFF)) | (hot[grams & np.uint64((1 << HOT_BITS) - 1)].astype(np.uint64) << np.uint64(63))
    least = sliding_min(keys, length - k + 1)
    have = np.maximum(size - length + 1, 0)
    total = int(have.sum())
    at = np.repeat(first - (np.cumsum(have) - have), have) + np.arange(total)
    anchor = (least[at] & np.uint64(0xFFFFFF)).astype(np.int64)
    new = np.ones(total, dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], total) - 1 if total else head
    begin, end = at[head], at[tail] + length
    which = np.searchsorted(first, begin, "right") - 1
    doc = np.array([x[0] for x in piece], dtype=np.int64)[which]
    start = begin - first[which] + np.array([x[1] for x in piece], dtype=np.int64)[which]
    return raw, buf, doc, start, begin, end, anchor[head]


def _leading(buf: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(buf, k)[at]).view(f"S{k}").ravel()


def _sample(batches: Iterable[pa.RecordBatch], length: int, k: int) -> Iterator[pa.RecordBatch]:
    for rows in parcels(((0, 0, t.encode()) for (t,) in table_rows(batches)), lambda r: len(r[2]), PIECE_BYTES):
        for piece in parcels(_chunks(rows, length), lambda x: len(x[2]), PIECE_BYTES):
            _, buf, *_, anchor = _strings(piece, length, k)
            if len(anchor):
                yield pa.RecordBatch.from_arrays([pa.array([bytes(x) for x in np.lib.stride_tricks.sliding_window_view(buf, k)[anchor[::4]]], pa.binary())], ["lead"])


def _send(batches: Iterable[pa.RecordBatch], length: int, k: int, splitters: np.ndarray, hot: list[bytes], ties: bool) -> Iterator[pa.RecordBatch]:
    def flush(rows: list, part: int) -> Iterator[pa.RecordBatch]:
        rows = sorted({r[:2]: r for r in rows}.values(), key=lambda r: r[:2])
        seen: dict[bytes, None] = {}
        kept, texts, again = [], [], []
        for piece in parcels(_chunks(rows, length), lambda x: len(x[2]), PIECE_BYTES):
            raw, buf, doc, start, begin, end, anchor = _strings(piece, length, k, frequent)
            fresh = np.zeros(len(doc), dtype=bool)
            for i, (b, e) in enumerate(zip(begin.tolist(), end.tolist(), strict=True)):
                text = raw[b:e]
                if text not in seen:
                    seen[text] = None
                    fresh[i] = True
            stale = ~fresh
            again.append(np.stack([doc[stale], start[stale], (start + end - begin)[stale]]))
            if fresh.any():
                bucket = np.searchsorted(splitters, _leading(buf, anchor[fresh], k), "right").astype(np.int64)
                kept.append((bucket, doc[fresh], start[fresh], (end - begin)[fresh].astype(np.uint8), (anchor - begin)[fresh].astype(np.uint8)))
        texts = list(seen)
        did = np.array([r[0] for r in rows], dtype=np.int64)
        k1 = np.array([r[1] for r in rows], dtype=np.int64)
        yield batch_of(_SENT, [settled(1, part), [part], [np.concatenate(again, axis=1).tobytes() if again else b""], [None], [pack(did, k1)]])
        if not kept:
            return
        bucket, doc, start, size, anchor = (np.concatenate(x) for x in zip(*kept, strict=True))
        order = np.argsort(bucket, kind="stable")
        names, cuts = np.unique(bucket[order], return_index=True)
        out = []
        for chosen in np.split(order, cuts[1:]):
            d = doc[chosen]
            tie = k1[d] if ties else np.zeros(len(d), dtype=np.int64)
            places = pack(deltas(d.astype(np.uint32)), deltas(did[d]), tie, start[chosen].astype(np.uint32), size[chosen], anchor[chosen])
            out.append((places, zstandard.ZstdCompressor(level=6).compress(b"".join([texts[i] for i in chosen.tolist()]))))
        yield batch_of(_SENT, [names, [part] * len(out), [x[0] for x in out], [x[1] for x in out], [None] * len(out)])

    lean()
    frequent = hot_map(hot)
    rows = ((did, k1, text.encode()) for did, k1, text in table_rows(batches))
    for n, held in enumerate(parcels(rows, lambda r: len(r[2]) + 64, FLUSH_BYTES)):
        yield from flush(held, task_part(n))


def multikey_sort(word, levels: int, n: int, most: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multikey quicksort by words: ``word(level, items)`` is the items' key at a level.

    Only items that still tie are looked at again. Returns the order, the level at which each item differs from the one
    before it (``levels`` if in none), and the items' classes after all levels. ``most``: items alone after that many
    levels are left where they are, which is all that the caller needs of them.
    """
    order = np.arange(n)
    apart = np.full(n, levels, dtype=np.int16)
    if n:
        apart[0] = -1
    at = np.arange(n)  # places in order whose group still ties
    group = np.zeros(n, dtype=np.int64)
    for level in range(levels):
        if not len(at):
            break
        items = order[at]
        key = word(level, items)
        by = np.lexsort((key, group))
        order[at] = items[by]
        key = key[by]
        new = np.ones(len(at), dtype=bool)
        new[1:] = group[1:] != group[:-1]
        split = ~new
        split[1:] &= key[1:] != key[:-1]
        apart[at[split]] = level
        new |= split
        group = np.cumsum(new)
        count = np.bincount(group)[group]
        left = count > 1
        at, group = at[left], group[left]
    return order, apart, np.cumsum(apart < levels) - 1


def _covered(length: int, k: int):
    """The work of one bucket, as a function of its rows."""
    right, left = -(-(length - k) // 8) + 10, -(-(length - k) // 8)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        columns, texts = [], []
        for bucket, part, places, strings, docs in table_rows(batches):
            if bucket < 0:
                yield batch_of(_RUN, [[part], [places], [docs]])
                continue
            doc, did, tie, start, size, anchor = unpack(places)
            columns.append((np.full(len(doc), part, dtype=np.int64), np.cumsum(doc, dtype=np.uint32), np.cumsum(did), tie, start.astype(np.int64), size.astype(np.int64), anchor.astype(np.int64)))
            texts.append(zstandard.ZstdDecompressor().decompress(strings))
        if not columns:
            return
        part, doc, did, tie, start, size, anchor = (np.concatenate(x) for x in zip(*columns, strict=True))
        del columns
        body = np.frombuffer(b"".join([*texts, bytes(8)]), dtype=np.uint8)
        del texts
        eight = np.lib.stride_tricks.sliding_window_view(body, 8)
        off = np.cumsum(size) - size

        def bytes_at(at: np.ndarray, end: np.ndarray) -> np.ndarray:
            """Eight bytes as a number in their order; zeros from end on."""
            x = np.ascontiguousarray(eight[np.minimum(at, len(eight) - 1)]).view(">u8").ravel().astype(np.uint64)
            short = np.clip(8 - (end - at), 0, 8).astype(np.uint64) * np.uint64(8)
            return np.where(short >= 64, np.uint64(0), x >> np.minimum(short, np.uint64(63)) << np.minimum(short, np.uint64(63)))

        lead = -(-k // 8)
        order, apart, classes = multikey_sort(lambda j, i: bytes_at(off[i] + anchor[i] + 8 * j, off[i] + anchor[i] + k), lead, len(size))
        many = np.bincount(classes)[classes] > 1
        live, family = order[many], classes[many]
        if not len(live):
            return

        def rest(j: int, i: np.ndarray) -> np.ndarray:
            i = live[i]
            if j == 0:
                return family_of[i]
            if j <= right:
                return bytes_at(off[i] + anchor[i] + k + 8 * (j - 1), off[i] + size[i])
            if j == right + 1:
                return (size[i] * 256 + anchor[i]).astype(np.uint64)
            return bytes_at(off[i] + 8 * (j - right - 2), off[i] + anchor[i])

        family_of = np.zeros(len(size), dtype=np.uint64)
        family_of[live] = family
        order, apart, classes = multikey_sort(rest, right + 2 + left, len(live))
        live = live[order]
        by = np.lexsort((start[live], tie[live], did[live], classes))
        live, classes = live[by], classes
        first = np.ones(len(live), dtype=bool)
        first[1:] = classes[1:] != classes[:-1]
        # A row that repeats id and text has the same place as the first: it is no copy.
        head = live[np.maximum.accumulate(np.where(first, np.arange(len(live)), 0))]
        copy = live[(did[live] != did[head]) | (tie[live] != tie[head]) | (start[live] != start[head])]
        found = [(part[copy], doc[copy], start[copy], start[copy] + size[copy])]

        # The earliest of each class: which neighbours in suffix order agree far enough to share a window?
        heads, level = live[first], apart[first]
        if len(heads) > 1:
            same = np.zeros(len(heads), dtype=np.int64)
            same[1:] = np.where(level[1:] == 0, 0, k + 8 * np.clip(level[1:], 1, right + 1))
            reach = np.maximum(same, np.append(same[1:], 0))
            heads = heads[reach + anchor[heads] >= length]
            if len(heads) > 1:
                found.append(_shared_windows(body, off, size, start, (did, tie), part, doc, heads, length))
        part, doc, start, end = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(part, kind="stable")
        names, cuts = np.unique(part[order], return_index=True)
        out = [np.stack([doc[c].astype(np.int64), start[c], end[c]]).tobytes() for c in np.split(order, cuts[1:])] if len(order) else []
        if out:
            yield batch_of(_RUN, [names, out, [None] * len(out)])

    return work


def _shared_windows(body, off, size, start, rank, part, doc, items, length) -> tuple:
    """Compares all windows of some strings: those with an equal window that starts earlier."""
    did, tie = rank
    count = size[items] - length + 1
    item = np.repeat(items, count)
    shift = np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)
    at = off[item] + shift
    code = np.concatenate([BYTE_CODE[body[off[i] : off[i] + size[i]]] for i in items])
    own = np.repeat(np.cumsum(size[items]) - size[items], count) + shift
    key = rolling(code, length)[own]
    place = start[item] + shift
    by = np.lexsort((place, tie[item], did[item], key))
    key, at, item, place = key[by], at[by], item[by], place[by]
    first = np.ones(len(key), dtype=bool)
    first[1:] = key[1:] != key[:-1]
    head = np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
    later = (did[item] != did[item[head]]) | (tie[item] != tie[item[head]]) | (place != place[head])
    view = np.lib.stride_tricks.sliding_window_view(body, length)
    hit = np.flatnonzero(later)
    for i in range(0, len(hit), 100_000):
        some = hit[i : i + 100_000]
        wrong = some[(view[at[some]] != view[at[head[some]]]).any(axis=1)]
        for x in wrong:  # equal hashes of unequal windows: compared with every earlier one of that hash
            later[x] = any((view[at[x]] == view[at[y]]).all() and (did[item[y]], tie[item[y]], place[y]) != (did[item[x]], tie[item[x]], place[x]) for y in range(head[x], x))
    item, place = item[later], place[later]
    return part[item], doc[item], place, place + length


def _runs_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one map batch: for each document with removed bytes, its maximal runs."""
    table, found = None, []
    for _, blob, docs in table_rows(batches):
        found.append(np.frombuffer(blob, dtype=np.int64).reshape(3, -1))
        if docs is not None:
            table = unpack(docs)
    doc, start, end = np.concatenate(found, axis=1)
    order = np.argsort(doc, kind="stable")
    names, cuts = np.unique(doc[order], return_index=True)
    if len(names):
        out = [np.stack(runs_union(start[c], end[c])).tobytes() for c in np.split(order, cuts[1:])]
        yield batch_of(_RUNS, [table[1][names], table[0][names], out])


def _cut_bytes(batches: Iterable[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for _, _, doc_id, text, blobs in table_rows([batch]):
            raw = text.encode()
            sha, at, removed, kept = hashlib.sha256(), 0, 0, []
            spans = ()
            if blobs:
                spans = np.concatenate([np.frombuffer(b, dtype=np.int64).reshape(2, -1) for b in blobs], axis=1)
                spans = np.stack(runs_union(spans[0], spans[1])).T.tolist()
            for i, j in spans:
                kept.append(raw[at:i])
                removed += j - i
                at = j
            kept.append(raw[at:])
            for x in kept:
                sha.update(x)
            out.append((doc_id, len(raw), removed, len(spans), sha.hexdigest(), b"".join(kept) if with_text else None))
        if out:
            yield batch_of(_KEPT, list(zip(*out, strict=True)))


def _splitters(keyed: DataFrame, n_bytes: int, buckets: int, length: int, k: int) -> tuple[np.ndarray, list[bytes]]:
    """Leading k-grams that part the suffixes in ``buckets`` ranges, and frequent k-grams, from a sample of whole documents.

    The sample is sorted on the cluster; the driver gets a row for each splitter, and at most as many frequent k-grams.
    """
    share = max(1, int(n_bytes / (buckets * SAMPLE_BYTES)))
    texts = keyed.filter(F.pmod(F.col("k1"), F.lit(share)) == 0).select("text")
    leads = settle(texts.mapInArrow(lambda it: _sample(it, length, k), "lead binary"), "sample")
    n = leads.count()
    step = max(1, n // buckets)
    chosen = ranked_within(leads, [], ["lead"]).filter(F.pmod("rank", F.lit(step)) == step - 1).select("lead").collect()
    most = max(2, int(HOT * n / buckets))
    hot = leads.groupBy("lead").count().filter(F.col("count") > most).select("lead").collect()
    return np.unique(np.array([bytes(r[0]) for r in chosen], dtype=f"S{k}")), sorted(bytes(r[0]) for r in hot)


def suffix_dedup(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, with_text: bool = False, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept bytes, for each document.

    ``length`` is at most 128 + anchor, so that a string's bytes count in eight bits.
    """
    if not anchor < length or 2 * length - anchor > 255:
        raise ValueError("anchor < length and 2 * length - anchor <= 255")
    keyed = with_key(docs)
    n_bytes = total_bytes(docs)
    buckets = 1 << bucket_bits(n_bytes, bucket_bytes)
    splitters, hot = _splitters(keyed, n_bytes, buckets, length, anchor)
    ties = not keyed.select("did", "k1").distinct().groupBy("did").count().filter("count > 1").isEmpty()
    sent = keyed.select("did", "k1", "text").mapInArrow(lambda it: _send(it, length, anchor, splitters, hot, ties), ddl(_SENT))
    found = by_group(sent, "bucket", _covered(length, anchor), _RUN)
    runs = by_group(found, "part", _runs_of, _RUNS).groupBy("did", "k1").agg(F.collect_list("runs").alias("runs"))
    cut = keyed.join(runs.hint("merge"), ["did", "k1"], "left").mapInArrow(lambda it: _cut_bytes(it, with_text), ddl(_KEPT))
    return cut if with_text else cut.drop("kept")
