"""Best-fit packing of pieces into sequences of at most ``most`` tokens, bulk-synchronously.

Pieces are range-sorted by length and ranked within it (``ranks``), so a piece is a (length, rank) and all pieces of a
length are one run of ranks, however many there are. The gaps of open sequences are likewise runs of consecutive sequence
numbers with equal room. Runs of both kinds are one table, dealt by ranges of size: (most/2, most], (most/3, most/2], and
so on. Rounds repeat on it until no piece is left:

1. *Sweep.* Every range, by itself and at the same time as the others, takes its pieces from the longest on.
   A run looks up its *successor* among the gaps of the range: the least room that still holds its length.
2. *Rank.* Pieces and gaps of the two runs meet by rank, the first piece with the first gap, as many as both have; the
   losers look for the next successor.
3. *Update.* What room is left is a gap again, and goes to the range of its size for the next round.
4. *Rise.* Pieces that lost in all of their range go, once all longer ranges are packed, to the next range above that has
   gaps. Those that lose in the topmost open new sequences there, whose gaps take part like others.

A piece only ever uses room of its own range or a larger one, so ranges do not wait for each other but for step 4. A
round's result is checkpointed, and the driver sees counts of runs for each range, never a piece.

What a sweep does to a run is one line of a plan: ranks from..to of a length go to sequences from.. at one offset. Lines
number some for each length, whatever the corpus; every piece finds its own by binary search.

Pieces of 0 tokens don't occur; pieces over ``most`` are refused. Ties are broken by the order columns; rows equal in all of them
may change places. An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.keyed import ddl
from chronoweave.llm.ranks import ranked_within
from chronoweave.llm.store import cut, settle
from chronoweave.llm.tokens import MOST
from chronoweave.llm.vector import batch_of

#: Range r holds sizes over most // PARTS[r] that no range before it holds; the last holds all that remain.
PARTS = (2, 3, 4, 8, 16)
PIECES, GAPS, LINES = 0, 1, 2
#: A run of ``n`` pieces (size: their length, first: rank) or gaps (size: their room, first: sequence), in range ``at``;
#: ``band`` is the range of a piece's own length. A line also has the first sequence and the offset.
_RUN = pa.schema([("kind", pa.int32()), ("band", pa.int32()), ("at", pa.int32()), ("size", pa.int64()), ("first", pa.int64()), ("n", pa.int64()), ("sequence", pa.int64()), ("place", pa.int64())])


def range_of(size: int, most: int) -> int:
    """The range that holds a size."""
    return next((r for r, part in enumerate(PARTS) if size > most // part), len(PARTS))


def sweep(pieces: list[tuple[int, int, int]], gaps: list[tuple[int, int, int]], most: int = MOST, opens: int | None = None) -> tuple[list, list, list]:
    """Best fit of runs (size, first, n) of pieces into runs of gaps, longest pieces first.

    Returns the lines (length, first rank, pieces, first sequence, offset), the pieces left, and the gaps left. With
    ``opens``, pieces that fit nowhere open sequences numbered from there.
    """
    open_gaps: dict[int, deque] = {}
    rooms: list[int] = []
    lines, lost = [], []

    def add(room: int, first: int, n: int) -> None:
        if room <= 0 or n <= 0:
            return
        if room not in open_gaps:
            open_gaps[room] = deque()
            bisect.insort(rooms, room)
        open_gaps[room].append((first, n))

    for gap in sorted(gaps):
        add(*gap)
    for length, rank, left in sorted(pieces, key=lambda p: (-p[0], p[1])):
        while left:
            i = bisect.bisect_left(rooms, length)
            if i == len(rooms):
                if opens is None:
                    lost.append((length, rank, left))
                    break
                n = -(-left // (most // length))
                add(most, opens, n)
                opens += n
                continue
            room = rooms[i]
            first, n = open_gaps[room].popleft()
            took = min(n, left)
            if n > took:
                open_gaps[room].appendleft((first + took, n - took))
            elif not open_gaps[room]:
                del open_gaps[room]
                rooms.pop(i)
            lines.append((length, rank, took, first, most - room))
            add(room - length, first, took)
            rank, left = rank + took, left - took
    return lines, lost, [(room, first, n) for room in rooms for first, n in open_gaps[room]]


def _sweeps(batches: Iterable[pa.RecordBatch], most: int, opens: int) -> Iterator[pa.RecordBatch]:
    """A round's part of one task: the sweeps of the ranges it holds, each by itself."""
    ranges: dict[int, list[dict]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            ranges.setdefault(row["at"], []).append(row)
    for at, rows in sorted(ranges.items()):
        of = lambda kind, rows=rows: [(r["size"], r["first"], r["n"]) for r in rows if r["kind"] == kind]
        lines, lost, gaps = sweep(of(PIECES), of(GAPS), most, opens if at == 0 else None)
        out = [(LINES, None, at, length, rank, n, sequence, place) for length, rank, n, sequence, place in lines]
        out += [(PIECES, range_of(size, most), at, size, first, n, None, None) for size, first, n in lost]
        out += [(GAPS, None, range_of(size, most), size, first, n, None, None) for size, first, n in gaps]
        if out:
            yield batch_of(_RUN, [list(c) for c in zip(*out, strict=True)])


def plan(counts: DataFrame, most: int = MOST) -> DataFrame:
    """The lines (``_RUN`` of kind LINES) for a table (length, n) of so many pieces of each length."""
    bad = counts.filter(~F.col("length").between(1, most)).first()
    if bad:
        raise ValueError(f"a piece of {bad['length']} tokens; 1 to {most} fit")
    band = F.lit(len(PARTS))
    for r in reversed(range(len(PARTS))):
        band = F.when(F.col("length") > most // PARTS[r], F.lit(r)).otherwise(band)
    none = F.lit(None).cast("long")
    state = counts.select(
        F.lit(PIECES).alias("kind"), band.alias("band"), band.alias("at"), F.col("length").cast("long").alias("size"), F.lit(0).cast("long").alias("first"), F.col("n").cast("long").alias("n"), none.alias("sequence"), none.alias("place")
    )
    lines, front, turn = state.filter("false"), None, 0
    while True:
        # A range's runs meet in one task, ranges in several; coalesced, as a session's partitions may be many more than ranges.
        dealt = state.repartition(len(PARTS) + 1, "at").coalesce(len(PARTS) + 1)
        # A round numbers the sequences it opens from turn * 2**40 on.
        state = cut(dealt.mapInArrow(lambda it, opens=turn << 40: _sweeps(it, most, opens), ddl(_RUN)))
        lines = lines.unionByName(state.filter(F.col("kind") == LINES))
        # At most a row for each kind, range and band.
        seen = state.filter(F.col("kind") != LINES).select("kind", "band", "at").coalesce(1).distinct().collect()
        bands = [r["band"] for r in seen if r["kind"] == PIECES]
        if not bands:
            return lines
        turn += 1
        state = state.filter(F.col("kind") != LINES)
        if min(bands) != front:
            front = min(bands)  # what the longer ranges left last reaches this one in the next round
            continue
        wide = sorted({r["at"] for r in seen if r["kind"] == GAPS})
        up = F.lit(0)
        for r in wide:
            up = F.when(F.col("at") > r, F.lit(r)).otherwise(up)
        state = state.withColumn("at", F.when((F.col("kind") == PIECES) & (F.col("band") == front), up).otherwise(F.col("at")))


def _place(batches: Iterable[pa.RecordBatch], lines: np.ndarray, by_length: dict[int, tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not len(batch):
            continue
        length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
        line = np.empty(len(batch), dtype=np.int64)
        for x in np.unique(length):
            own = length == x
            a, b = by_length[int(x)]
            line[own] = a + np.searchsorted(lines[a:b, 1], rank[own], "right") - 1
        chosen = lines[line]
        columns = [batch[n] for n in batch.schema.names if n != "rank"]
        names = [n for n in batch.schema.names if n != "rank"]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(chosen[:, 3] + rank - chosen[:, 1]), pa.array(chosen[:, 4])], [*names, "sequence_id", "offset"])


def pack_pieces(pieces: DataFrame, order: list[str], most: int = MOST) -> DataFrame:
    """The pieces with sequence_id and offset; ``length`` is their tokens, ``order`` breaks ties."""
    # Range-sorting reads its input twice; pieces are costly to make, so they are written first.
    ranked = ranked_within(settle(pieces, "pieces"), ["length"], order)
    found = plan(ranked.groupBy("length").agg(F.count("*").alias("n")), most)
    lines = np.array(sorted(map(tuple, found.select("size", "first", "n", "sequence", "place").collect())), dtype=np.int64).reshape(-1, 5)
    cuts = np.searchsorted(lines[:, 0], np.unique(lines[:, 0]), "left").tolist() + [len(lines)]
    by_length = {int(x): (cuts[i], cuts[i + 1]) for i, x in enumerate(np.unique(lines[:, 0]))}
    kept = [f for f in ranked.schema.fields if f.name != "rank"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", sequence_id long, offset long"
    return ranked.mapInArrow(lambda it: _place(it, lines, by_length), schema)
