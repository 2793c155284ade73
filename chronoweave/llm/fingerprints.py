"""Document fingerprints by winnowing, in Spark's own functions only.

A text's code points are hashed in every run of ``K``: 64 bytes of its UTF-32. Of each ``W`` consecutive hashes the least is
chosen, the rightmost on ties, and kept with its place. So two texts that share a passage of K + W - 1 = 47 code points share a
fingerprint from within it, and no match is shorter than K.

A hash and its place are one number: 33 bits of hash, then the place counted down from 2**31 - 1, so that the least number is the
least hash at its rightmost place; sliding minima are taken over eights, then over fours of those. A long text is worked off in
parts of ``PART`` windows, so that what is held at a time beside the text and the result does not grow with it.

A text shorter than K has one hash, of the whole; one with W hashes or fewer has their least; an empty or null text has
none and its fingerprint is the empty string. Likeness is the share of common hashes among all of two texts (1 if neither
has any).

Nothing is cut off: texts are fingerprinted whole, however long. Rows that repeat an id are documents like others, in the order
of their texts' hashes, then texts; a null id comes first; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, W = 16, 32
PLACE_BITS = 31
_LAST = (1 << PLACE_BITS) - 1
PART = 8192


def _let(value: Column, body) -> Column:
    """body(value), with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _ahead(a: Column, i: Column, steps: list[int]) -> list[Column]:
    """Elements at i + step, null beyond the end."""
    return [F.get(a, i + F.lit(s)) for s in steps]


def _key(hash: Column, place: Column) -> Column:
    return hash.bitwiseAND(F.lit(~_LAST)).bitwiseOR(F.lit(_LAST).cast("long") - place)


def gram_keys(code: Column, first: Column, n: Column) -> Column:
    """Keys of the n runs of K code points from the place ``first`` on; ``code`` is the text's UTF-32."""
    return F.transform(F.sequence(first, first + n - 1), lambda i: _key(F.xxhash64(F.substring(code, i * 4 + 1, F.lit(4 * K))), i))


def winnowed(text: Column) -> Column:
    """The chosen keys of a text, in order of place."""
    n = F.length(text)

    def eights(keys: Column) -> Column:
        return F.transform(keys, lambda x, i: F.least(x, *_ahead(keys, i, list(range(1, 8)))))

    def minima(m: Column, windows: Column) -> Column:
        return F.slice(F.transform(m, lambda x, i: F.least(x, *_ahead(m, i, [8, 16, 24]))), F.lit(1), windows)

    def part(code: Column, first: Column) -> Column:
        windows = F.least(F.lit(PART), n - (K + W - 2) - first)
        return _let(gram_keys(code, first, windows + (W - 1)), lambda keys: _let(eights(keys), lambda m: F.array_distinct(minima(m, windows))))

    coded = lambda body: _let(F.encode(text, "UTF-32"), body)
    short = coded(lambda code: part(code, F.lit(0)))
    long = coded(lambda code: F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), n - (K + W - 1), F.lit(PART)), lambda first: part(code, first)))))
    few = coded(lambda code: F.array(F.array_min(gram_keys(code, F.lit(0), n - (K - 1)))))
    one = F.array(_key(F.xxhash64(F.encode(text, "UTF-32")), F.lit(0)))
    return F.when(n == 0, F.array().cast("array<bigint>")).when(n < K, one).when(n < K + W, few).when(n < K + W - 1 + PART, short).otherwise(long)


def as_text(keys: Column) -> Column:
    """hash@place, by place, separated by spaces."""
    one = lambda k: F.concat_ws("@", F.lower(F.hex(F.shiftrightunsigned(k, PLACE_BITS))), _place(k).cast("string"))
    return F.array_join(F.transform(keys, one), " ")


def _parts(keys: Column) -> Column:
    return F.array_distinct(F.transform(keys, lambda k: F.shiftright(k, PLACE_BITS)))


def likeness(one: Column, other: Column) -> Column:
    """Common hashes over all hashes of two arrays of chosen keys."""
    a, b = _parts(one), _parts(other)
    common = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - common
    return F.when(every == 0, F.lit(1.0)).otherwise(common / every)


def _place(key: Column) -> Column:
    return F.lit(_LAST) - key.bitwiseAND(F.lit(_LAST))


def spliced(text: Column, keys: Column, end: Column, other: Column, other_keys: Column, taken: Column) -> Column:
    """The chosen keys of the first ``end`` code points of a text followed by the first ``taken`` of another, from those of both.

    Minima move right with their windows. So the keys left of the last whole window's minimum in the first part stay, those up
    to the last whole window's minimum in the second part stay (moved), and only windows across the joint are new.
    Parts shorter than a window leave nothing to reuse; then the spliced text is winnowed itself.
    """
    span = K + W - 1
    whole = F.concat(F.substring(text, F.lit(1), end), F.substring(other, F.lit(1), taken))
    joint = F.concat(F.substring(text, end - (span - 1), F.lit(span)), F.substring(other, F.lit(1), F.lit(span)))
    tail = F.substring(other, taken - (span - 1), F.lit(span))

    def joined(mid: Column) -> Column:
        moved = F.transform(mid, lambda k: k - (end - span).cast("long"))
        before = lambda first: F.filter(keys, lambda k: _place(k) < first)
        upto = lambda last: F.transform(F.filter(other_keys, lambda k: _place(k) <= last), lambda k: k - end.cast("long"))
        left = _let(_place(F.element_at(moved, 1)), before)
        right = _let(_place(F.element_at(winnowed(tail), 1)) + (taken - span), upto)
        return F.array_distinct(F.concat(left, moved, right))

    return F.when((end >= span) & (taken >= span), _let(winnowed(joint), joined)).otherwise(winnowed(whole))


def _numbers(values: list[int]) -> Column:
    """An array that the optimizer folds to one literal, however many values."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.array().cast("array<bigint>")


def _count_upto(cuts: list[int], value: Column, block: int = 64) -> Column:
    """How many of the sorted cuts are at most a value: first by blocks, then within one."""
    blocks = F.size(F.filter(_numbers(cuts[::block]), lambda x: x <= value))
    within = F.size(F.filter(F.slice(_numbers(cuts), (blocks - 1) * block + 1, F.lit(block)), lambda x: x <= value))
    return F.when(value < (cuts[0] if cuts else 0), 0).otherwise((blocks - 1) * block + within) if cuts else F.lit(0)


def with_next(rows: DataFrame, columns: list[str], per_partition: int = 4, wide: int = 2) -> DataFrame:
    """Adds ``next_<column>`` of the row that follows by (did, hash of the text, text); the first follows the last.

    Buckets are ranges of did between quantiles, as many as there are shuffle partitions, ``per_partition`` times. An id that is
    ``wide`` quantiles or more is parted further by the hashes of its texts, so no id fills a task unless its texts are equal
    as well. The first row of a bucket is sent to the one before it too, so no neighbour is missed.
    """
    spark = rows.sparkSession
    n = per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = rows.agg(F.min("did"), F.percentile_approx("did", [i / n for i in range(1, n)], 10 * n)).first()
    if found[0] is None:
        return rows.select("*", *[F.col(c).alias(f"next_{c}") for c in columns])
    lowest = found[0]
    cuts = sorted({x for x in found[1] if x > lowest})
    hot = {x: found[1].count(x) for x in {*found[1]} if found[1].count(x) >= wide}
    bucket = _count_upto(cuts, F.col("did"))
    hashed = rows.withColumn("hash", F.xxhash64("text"))
    part = F.lit(0)
    for x, parts in sorted(hot.items()):
        # The 16 high bits of the hash, from 0 up, in so many ranges.
        part = F.when(F.col("did") == x, F.floor((F.shiftright("hash", 48) + 32768) * F.lit(parts) / F.lit(65536)).cast("int") + 1).otherwise(part)
    # A bucket holds its first id before all others: the parts of a hot id come first, then what follows it.
    after = F.when(F.col("did").isin(*hot), part).otherwise(F.lit(n + 1)) if hot else F.lit(0)
    hashed = hashed.withColumn("bucket", bucket.cast("int")).withColumn("part", after.cast("int"))
    order = ["did", "hash", "text"]
    if hot:
        # Which buckets there are and what each starts with: a row for each, found on narrow columns.
        starts = hashed.groupBy("bucket", "part").agg(F.min(F.struct("did", "hash")).alias("least")).orderBy("bucket", "part").collect()
        before = {(b["bucket"], b["part"]): (a["bucket"], a["part"]) for a, b in zip([starts[-1], *starts[:-1]], starts, strict=True)}
        first = {(r["bucket"], r["part"]): (r["least"]["did"], r["least"]["hash"]) for r in starts}
        lines = [{"bucket": b, "part": p, "_did": first[b, p][0], "_hash": first[b, p][1], "_bucket": before[b, p][0], "_part": before[b, p][1], "_wraps": int((b, p) == (starts[0]["bucket"], starts[0]["part"]))} for b, p in before]
        kind = "array<struct<bucket: int, part: int, _did: bigint, _hash: bigint, _bucket: int, _part: int, _wraps: int>>"
        # At most a row for each quantile.
        table = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(lines)), kind)))
        known = hashed.join(F.broadcast(table), ["bucket", "part"])
        to = F.when((F.col("did") == F.col("_did")) & (F.col("hash") == F.col("_hash")), F.struct(F.col("_bucket").alias("bucket"), F.col("_part").alias("part"), (F.lit(1) + F.col("_wraps")).alias("kind")))
    else:
        known = hashed
        begins = F.get(_numbers(cuts), F.col("bucket") - 1) == F.col("did")
        place = lambda b, kind: F.struct(b.cast("int").alias("bucket"), F.lit(0).alias("part"), F.lit(kind).alias("kind"))
        to = F.when(F.col("did") == lowest, place(F.lit(len(cuts)), 2)).when(begins, place(F.col("bucket") - 1, 1))
    own = F.struct("bucket", "part", F.lit(0).alias("kind"))
    placed = known.withColumn("at", F.explode(F.array_compact(F.array(own, to)))).select(*rows.columns, "hash", "at.bucket", "at.part", "at.kind")
    following = Window.partitionBy("bucket", "part").orderBy((F.col("kind") == 2).cast("int"), *order)
    return placed.select("*", *[F.lead(c).over(following).alias(f"next_{c}") for c in columns]).filter("kind = 0").drop("bucket", "part", "kind", "hash")


def fingerprint(docs: DataFrame) -> DataFrame:
    """did, doc_id, text and the chosen ``keys`` of each document."""
    ident = F.col("doc_id").cast("long")
    rows = docs.select(F.coalesce(ident, F.lit(-(2**63))).alias("did"), ident.alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("keys", winnowed(F.col("text")))


def against_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text, with likenesses to that and to the next document."""
    rows = with_next(fingerprint(docs), ["text", "keys"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    end, taken = (n - half).cast("int"), F.least(half, F.length("next_text")).cast("int")
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("_end", end).withColumn("_taken", taken)
    edited = F.concat(F.substring("text", F.lit(1), F.col("_end")), F.substring("next_text", F.lit(1), F.col("_taken")))
    edited_keys = spliced(F.col("text"), F.col("keys"), F.col("_end"), F.col("next_text"), F.col("next_keys"), F.col("_taken"))
    rows = rows.select("doc_id", "n_chars", "keys", "next_keys", F.sha2(edited, 256).alias("edited_sha256"), edited_keys.alias("edited_keys"))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("keys")).alias("fingerprint"),
        as_text(F.col("edited_keys")).alias("edited_fingerprint"),
        likeness(F.col("keys"), F.col("edited_keys")).alias("near_edited"),
        likeness(F.col("keys"), F.col("next_keys")).alias("near_next"),
    )
