"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

A document's set is its distinct shingles of ``size`` lower-cased words (A-Z only); with fewer words, its whole sequence
as one; without words it is empty and linked with nothing. Documents are linked whose sets' similarity is ``threshold``
per cent or more; a component is what links reach.

1. *Sign.* ``ROWS * BANDS`` minima for each set; the low ``BITS`` bits of each are packed into a signature, groups of
   ``ROWS`` full minima make band keys. Documents with equal sets are one class from here on: copies are
   never expanded into pairs. Sets are equal if 128 bits of digest are; the first 64 name the class in the graph, and where
   two classes share those, both take a name from all 128.
2. *Band.* Classes that share a band key are candidates. Within a band group, signatures are compared by bit counts,
   corrected for the collisions that ``BITS`` bits have by chance, and only a spanning forest of the pairs above
   ``threshold`` less ``MARGIN`` leaves the group. Groups over ``MOST`` aren't compared: their members are joined to
   one of them, which can only make the next step's clusters larger, never lose a pair.
3. *Confirm.* Within a cluster of candidates, full sets are compared breadth first, each only with those not yet reached. A
   cluster over ``MOST`` is first compared with one member; only members that this leaves apart are then compared, in
   blocks, with all others. So every pair is confirmed, or needless as both are in one component already.

At similarity 0.85 the bands miss a pair once in 10**10 and the margin, six standard deviations, about as often; at 0.8,
where the pipeline's stage links, the bands miss one in 2 * 10**7 and the margin is over five standard deviations.

Null ids count as no id for ``component_id``, which is the smallest id in the component; rows that repeat an id or a text
are rows like others. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.components import components
from chronoweave.llm.keyed import bucket_bits, by_group, ddl, total_bytes, with_key
from chronoweave.llm.store import cut, settle
from chronoweave.llm.vector import Words, batch_of, mixed, parcels, rolling, table_rows

SIZE, THRESHOLD = 5, 85
ROWS, BANDS, BITS, MARGIN = 4, 32, 4, 20
MOST = 4096
BLOCK = 2048
PIECE_BYTES = 1 << 20
TASK_BYTES = 8 << 20

_RNG = np.random.Generator(np.random.PCG64(5))
_MULTIPLIERS = _RNG.integers(0, 2**63, ROWS * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_CODE = _RNG.integers(0, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_SIGNED = "did long, k1 long, doc_id long, n long, node long, more long, sig binary, bands array<long>"
_EDGE = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(texts, lower=True)
    hashes = rolling(words.hash, size)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(hashes[a : b - size + 1]))
        elif b > a:
            out.append(rolling(np.append(words.hash[a:b], np.uint64(b - a)), b - a + 1))
        else:
            out.append(words.hash[:0])
    return out


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """ROWS * BANDS minima of each set; no set is empty."""
    joined = np.concatenate(sets)
    at = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(_MULTIPLIERS), len(sets)), dtype=np.uint64)
    for i, m in enumerate(_MULTIPLIERS):
        np.minimum.reduceat(joined * m, at, out=out[i])
    return out.T


def signatures(least: np.ndarray) -> np.ndarray:
    """The low bits of mixed minima, packed."""
    low = (mixed(least) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    return np.ascontiguousarray(low[:, 0::2] | (low[:, 1::2] << np.uint8(4)))


def estimates(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Similarities of a packed signature with others, corrected for chance collisions."""
    x = one.view(np.uint64) ^ others.view(np.uint64)
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    unlike = np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=1, dtype=np.int64)
    by_chance = 2.0**-BITS
    return (1 - unlike / len(_MULTIPLIERS) - by_chance) / (1 - by_chance)


def _sign(batches: Iterable[pa.RecordBatch], size: int, node_bits: int) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 6 + [pa.binary(), pa.list_(pa.int64())]
    names = ["did", "k1", "doc_id", "n", "node", "more", "sig", "bands"]
    for rows in parcels(((a, b, c, t.encode()) for a, b, c, t in table_rows(batches)), lambda r: len(r[3]) + 64, PIECE_BYTES):
        sets = shingle_sets([r[3] for r in rows], size)
        full = [i for i, s in enumerate(sets) if len(s)]
        sig: list = [None] * len(rows)
        bands: list = [None] * len(rows)
        node: list = [None] * len(rows)
        more: list = [None] * len(rows)
        if full:
            least = minima([sets[i] for i in full])
            packed = signatures(least)
            keys = mixed((least.reshape(len(full), BANDS, ROWS) * _BAND_CODE).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
            for j, i in enumerate(full):
                sig[i], bands[i] = packed[j].tobytes(), keys[j]
                digest = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                node[i] = int.from_bytes(digest[:8], "little", signed=True) >> (64 - node_bits)
                more[i] = int.from_bytes(digest[8:], "little", signed=True)
        did, k1, doc_id, _ = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([did, k1, doc_id, [len(s) for s in sets], node, more, sig, bands], kinds, strict=True)], names)


def _forest(n: int, linked) -> list[tuple[int, int]]:
    """Breadth first: ``linked(i, rest)`` says which of rest item i is linked with. Pairs (item, first of its tree)."""
    rest, out = np.arange(n), []
    while len(rest):
        root, queue, rest = rest[0], [rest[0]], rest[1:]
        while queue and len(rest):
            hit = linked(queue.pop(), rest)
            if hit.any():
                queue += rest[hit].tolist()
                out += [(x, root) for x in rest[hit].tolist()]
                rest = rest[~hit]
    return out


def _band_edges(batches: Iterable[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Of many band groups: a spanning forest of the pairs whose estimate reaches ``least``."""
    table = pa.Table.from_batches(batches)
    band, node = table["band"].to_numpy(), table["node"].to_numpy()
    sig = np.frombuffer(b"".join(table["sig"].to_pylist()), dtype=np.uint8).reshape(len(band), -1)
    order = np.lexsort((node, band))
    band, node, sig = band[order], node[order], sig[order]
    cuts = np.flatnonzero(np.concatenate([[True], band[1:] != band[:-1], [True]]))
    size = np.diff(cuts)
    found = []
    two = cuts[:-1][size == 2]  # most groups: all at once
    if len(two):
        x = sig[two].view(np.uint64) ^ sig[two + 1].view(np.uint64)
        x |= x >> np.uint64(1)
        x |= x >> np.uint64(2)
        unlike = np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=1, dtype=np.int64)
        good = two[(1 - unlike / len(_MULTIPLIERS) - 2.0**-BITS) / (1 - 2.0**-BITS) >= least]
        found.append(np.stack([node[good], node[good + 1]]))
    for a, n in zip(cuts[:-1][size > 2].tolist(), size[size > 2].tolist(), strict=True):
        s, own = sig[a : a + n], node[a : a + n]
        pairs = _forest(n, lambda i, rest: estimates(s[i], s[rest]) >= least)
        if pairs:
            found.append(own[np.array(pairs).T])
    if found:
        u, v = np.unique(np.concatenate(found, axis=1), axis=1)
        yield batch_of(_EDGE, [u, v])


def _linked_sets(sets: list[np.ndarray], threshold: int):
    """``linked`` of ``_forest`` on full sets: 100 * common >= threshold * union."""
    size = np.array([len(s) for s in sets])
    names, own = np.unique(np.concatenate(sets), return_inverse=True)
    start = np.cumsum(size) - size
    table = np.zeros(len(names), dtype=bool)

    def linked(i: int, rest: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rest), dtype=bool)
        fit = np.flatnonzero((100 * np.minimum(size[i], size[rest]) >= threshold * np.maximum(size[i], size[rest])))
        if len(fit):
            mine = own[start[i] : start[i] + size[i]]
            table[mine] = True
            some = rest[fit]
            n = size[some]
            edge = np.cumsum(n) - n
            at = np.repeat(start[some] - edge, n) + np.arange(n.sum())
            common = np.add.reduceat(table[own[at]], edge, dtype=np.int64)
            table[mine] = False
            out[fit] = 100 * common >= threshold * (size[i] + n - common)
        return out

    return linked


def _confirm(batches: Iterable[pa.RecordBatch], size: int, threshold: int) -> Iterator[pa.RecordBatch]:
    """Of many clusters: a spanning forest of the links. Members marked ``joined`` are in one component already."""
    table = pa.Table.from_batches(batches).sort_by([("cluster", "ascending"), ("joined", "descending"), ("node", "ascending")])
    cluster, node, joined = (table[c].to_numpy() for c in ("cluster", "node", "joined"))
    text = [t.encode() for t in table["text"].to_pylist()]
    found = []
    cuts = np.flatnonzero(np.concatenate([[True], cluster[1:] != cluster[:-1], [True]]))
    for group in parcels(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True), lambda g: sum(map(len, text[g[0] : g[1]])), PIECE_BYTES):
        a, b = group[0][0], group[-1][1]
        sets = shingle_sets(text[a:b], size)
        for i, j in group:
            own, ours, done = node[i:j], sets[i - a : j - a], int(joined[i:j].sum())
            linked = _linked_sets(ours, threshold)
            pairs = []
            rest = np.arange(done, j - i)
            for x in range(done):  # what any joined member reaches is in their component
                if not len(rest):
                    break
                hit = linked(x, rest)
                pairs += [(y, x) for y in rest[hit].tolist()]
                rest = rest[~hit]
            # Those apart from all joined members, and those reached from them, still link among themselves.
            apart = np.arange(done, j - i)
            pairs += [(int(apart[p]), int(apart[q])) for p, q in _forest(len(apart), lambda p, r: linked(int(apart[p]), apart[r]))]
            if pairs:
                found.append(own[np.array(pairs).T])
    if found:
        u, v = np.unique(np.concatenate(found, axis=1), axis=1)
        yield batch_of(_EDGE, [u, v])


def _with_center(batches: Iterable[pa.RecordBatch], size: int, threshold: int) -> Iterator[pa.RecordBatch]:
    """Whether each member of a large cluster is linked with the cluster's centre."""
    names = ["cluster", "node", "text", "joined"]
    for batch in batches:
        held: dict[int, np.ndarray] = {}
        out = []
        for cluster, node, text, center in table_rows([batch]):
            if cluster not in held:
                held = {cluster: shingle_sets([center.encode()], size)[0]}
            own = shingle_sets([text.encode()], size)[0]
            common = len(np.intersect1d(own, held[cluster], assume_unique=True))
            out.append((cluster, node, text, 100 * common >= threshold * (len(own) + len(held[cluster]) - common)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)


def _confirmed(members: DataFrame, size: int, threshold: int, bits: int) -> DataFrame:
    """Links within clusters: members (cluster, node, text) -> spanning edges (u, v)."""
    counts = members.groupBy("cluster").agg(F.count("*").alias("n"), F.min("node").alias("center"), F.sum(F.octet_length("text")).alias("bytes"))
    large = cut(counts.filter((F.col("n") > MOST) | (F.col("bytes") > 16 * TASK_BYTES)))
    work = lambda it: _confirm(it, size, threshold)
    columns = ["task", "cluster", "node", "text", "joined"]
    if large.isEmpty():
        small = members.withColumn("joined", F.lit(False)).withColumn("task", F.pmod(F.xxhash64("cluster"), F.lit(1 << bits)))
        return by_group(small.select(columns), "task", work, _EDGE)
    small = members.join(large.select("cluster"), "cluster", "left_anti").withColumn("joined", F.lit(False))
    small = small.withColumn("task", F.pmod(F.xxhash64("cluster"), F.lit(1 << bits)))
    centers = members.join(large.select("cluster", F.col("center").alias("node")), ["cluster", "node"]).select("cluster", F.col("text").alias("center_text"))
    tested = members.join(centers, "cluster").select("cluster", "node", "text", "center_text")
    tested = settle(tested.mapInArrow(lambda it: _with_center(it, size, threshold), "cluster long, node long, text string, joined boolean"), "large-clusters")
    to_center = tested.filter("joined").join(large.select("cluster", "center"), "cluster").select(F.col("node").alias("u"), F.col("center").alias("v"))
    # Blocks: every member that isn't joined meets every other member in some task.
    # A side has a block for each ``BLOCK`` members or ``TASK_BYTES`` of text, whichever makes more; one with a member has one.
    blocks_of = lambda side: F.ceil(F.greatest(F.count_if(side) / BLOCK, F.coalesce(F.sum(F.when(side, F.octet_length("text"))), F.lit(0)) / TASK_BYTES)).cast("long")
    sides = tested.groupBy("cluster").agg(blocks_of(F.col("joined")).alias("a"), blocks_of(~F.col("joined")).alias("b"))
    block = F.when(F.col("joined"), F.pmod(F.xxhash64("node"), F.greatest("a", F.lit(1)))).otherwise(F.pmod(F.xxhash64("node"), F.greatest("b", F.lit(1))))
    placed = tested.join(sides.filter("b > 0"), "cluster").withColumn("x", block)
    other = F.sequence(F.lit(0).cast("long"), F.col("b") - 1)
    meets = F.when(F.col("joined"), F.transform(other, lambda y: F.concat_ws(":", F.lit("a"), F.col("x"), y))).otherwise(
        F.concat(
            F.when(F.col("a") > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("a") - 1, F.lit(0))), lambda y: F.concat_ws(":", F.lit("a"), y, F.col("x")))).otherwise(F.array().cast("array<string>")),
            F.transform(other, lambda y: F.concat_ws(":", F.lit("b"), F.least("x", y), F.greatest("x", y))),
        )
    )
    blocks = placed.withColumn("meet", F.explode(meets)).withColumn("task", F.xxhash64("cluster", "meet"))
    blocks = blocks.withColumn("cluster", F.col("task"))
    return by_group(small.select(columns).unionByName(blocks.select(columns)), "task", work, _EDGE).unionByName(to_center)


def _classes(signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The signed rows and their classes, a row for each set, with names no two classes share."""
    while True:
        own = signed.filter("node is not null").groupBy("node")
        classes = own.agg(
            F.min("doc_id").alias("root"), F.min(F.struct("did", "k1")).alias("rep"), F.first("sig").alias("sig"), F.first("bands").alias("bands"), (F.min("more") != F.max("more")).alias("clash")
        )
        classes = settle(classes, "classes")
        clash = classes.filter("clash").select("node", "clash")
        if clash.isEmpty():
            return signed, classes.drop("clash")
        named = signed.join(clash, "node", "left").withColumn("node", F.when(F.col("clash"), F.xxhash64("node", "more")).otherwise(F.col("node")))
        signed = settle(named.select(*signed.columns), "signed")


def near_dedup(docs: DataFrame, size: int = SIZE, threshold: int = THRESHOLD, node_bits: int = 64) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row, and did and k1, the row's key (see ``keyed``).

    ``node_bits``: bits of a digest that name a class at first.
    """
    keyed = with_key(docs)
    bits = bucket_bits(total_bytes(docs), TASK_BYTES)
    signed, classes = _classes(settle(keyed.mapInArrow(lambda it: _sign(it, size, node_bits), _SIGNED), "signed"))
    banded = classes.select("node", F.explode("bands").alias("band"))
    # Counted by partial sums and met by a join that can be split, so no band, however many share it, is one task's.
    shared = banded.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("least")).filter("n > 1")
    banded = cut(banded.join(shared, "band").select("node", "band", "n", "least"))
    huge = banded.filter((F.col("n") > MOST) & (F.col("node") != F.col("least"))).select(F.col("node").alias("u"), F.col("least").alias("v"))
    some = banded.filter(F.col("n") <= MOST).join(classes.select("node", "sig"), "node")
    some = some.select(F.pmod(F.xxhash64("band"), F.lit(1 << bits)).alias("task"), "band", "node", "sig")
    least = (threshold - MARGIN) / 100
    near = by_group(some, "task", lambda it: _band_edges(it, least), _EDGE)
    clusters = cut(components(near.unionByName(huge)))
    members = clusters.join(classes.select("node", "rep"), "node").select(F.col("component").alias("cluster"), "node", "rep.did", "rep.k1")
    texts = keyed.select("did", "k1", "text").join(members.hint("merge"), ["did", "k1"]).select("cluster", "node", "text")
    links = components(_confirmed(settle(texts.dropDuplicates(["node"]), "members"), size, threshold, bits))
    linked = links.join(classes.select("node", "root"), "node")
    roots = linked.groupBy("component").agg(F.min("root").alias("component_id"))
    named = linked.join(roots, "component").select("node", "component_id")
    named = classes.select("node", "root").join(named, "node", "left").select("node", F.coalesce("component_id", "root").alias("component_id"))
    out = signed.select("did", "k1", "doc_id", F.col("n").alias("n_shingles"), "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = out.withColumn("component_id", component)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "did", "k1")
