"""Substring, suffix and near-duplicate removal against brute force, with nulls, empties, ties, repeats and long texts."""

import hashlib
import random
import re
from collections import Counter

import pytest

from chronoweave.llm import near_dedup as near
from chronoweave.llm import suffix_dedup as suffix
from chronoweave.llm.components import components
from chronoweave.llm.substring_dedup import substring_dedup

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def texts(seed: int = 1) -> list[str | None]:
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé漢", k=rng.randint(1, 9))) for _ in range(300)]
    say = lambda n: " ".join(rng.choices(words, k=n))
    passage = say(60)
    out = [say(rng.randint(5, 200)) for _ in range(30)]
    out += [say(20) + " " + passage + "\n" + say(20) for _ in range(5)] + [passage, passage, passage[7:]]
    out += [None, "", " \t\n", "one", "one", "x " * 200, "x " * 400, "ab" * 300, "a" * 700, say(3000)]
    base = say(120).split()
    for i in range(12):
        near_copy = list(base)
        near_copy[i * 7] = f"changed{i}"
        out.append(" ".join(near_copy))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash") for i, t in enumerate(texts())]
    rows += [rows[0], (5, "another text under an id", "clash"), (None, "no id", "clash"), (None, None, "clash")]
    return spark.createDataFrame(rows, "doc_id long, text string, runs string").repartition(3)


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def brute_words(rows, window):
    split = [WORD.findall((t or "").encode()) for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, split, strict=True):
        gone = bytearray(len(w))
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = b"\1" * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("window", [35, 5])
def test_substring_dedup(docs, window):
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(docs, window).collect())
    assert got == brute_words(rows_of(docs), window)


def brute_bytes(rows, length):
    order = sorted({(-(2**63) if d is None else d, t or "") for d, t in rows}, key=lambda r: r[0])
    ids = Counter(d for d, _ in order)
    assert max(ids.values()) == 1, "the brute force orders by id alone"
    seen, out = set(), {}
    for d, t in order:
        raw = t.encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            w = raw[p : p + length]
            if w in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(w)
        out[d] = (len(raw), sum(gone), hashlib.sha256(bytes(c for c, g in zip(raw, gone, strict=True) if not g)).hexdigest())
    return out


@pytest.mark.parametrize(("length", "anchor", "piece"), [(100, 16, 1 << 20), (40, 8, 256)])
def test_suffix_dedup(spark, docs, monkeypatch, length, anchor, piece):
    monkeypatch.setattr(suffix, "PIECE_BYTES", piece)
    one = docs.filter("doc_id is not null and text not like 'another%'").dropDuplicates(["doc_id"])
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.kept_sha256) for r in suffix.suffix_dedup(one, length, anchor).collect()}
    assert got == brute_bytes(rows_of(one), length)


def test_suffix_dedup_repeated_rows(spark):
    long = "".join(random.Random(9).choices("abcdefgh", k=300))
    df = spark.createDataFrame([(1, long), (1, long), (2, long), (2, long + "x"), (None, "y" * 150)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in suffix.suffix_dedup(df).collect())
    # The repeated row is one document with the first; both texts of id 2 come after it.
    assert [g for g in got if g[0] == 1] == [(1, 300, 0)] * 2
    assert [g for g in got if g[0] == 2] == [(2, 300, 300), (2, 301, 300)]
    assert [g for g in got if g[0] == 0] == [(0, 150, 149)]


def test_multikey_sort():
    import numpy as np

    rng = random.Random(3)
    rows = [[rng.randint(0, 2) for _ in range(6)] for _ in range(500)]
    table = np.array(rows, dtype=np.uint64)
    order, apart, classes = suffix.multikey_sort(lambda level, items: table[items, level], 6, len(rows))
    assert [rows[i] for i in order] == sorted(rows)
    assert len(set(classes)) == len({tuple(r) for r in rows}) and apart[0] == -1


def sets_of(rows):
    lower = lambda t: re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())
    out = []
    for _, t in rows:
        w = WORD.findall(lower(t))
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    return out


def brute_components(rows, threshold):
    sets = sets_of(rows)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= threshold * len(a | sets[j]):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return Counter((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize(("most", "block"), [(4096, 2048), (3, 2)])
def test_near_dedup(docs, monkeypatch, most, block):
    monkeypatch.setattr(near, "MOST", most)
    monkeypatch.setattr(near, "BLOCK", block)
    for threshold in (85, 60):
        got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near.near_dedup(docs, threshold=threshold).collect())
        assert got == brute_components(rows_of(docs), threshold)


def test_near_dedup_blocks_by_bytes(docs, monkeypatch):
    monkeypatch.setattr(near, "TASK_BYTES", 300)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near.near_dedup(docs, threshold=60).collect())
    assert got == brute_components(rows_of(docs), 60)


def test_near_dedup_names_that_clash(docs):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near.near_dedup(docs, threshold=60, node_bits=3).collect())
    assert got == brute_components(rows_of(docs), 60)


def test_estimates_follow_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    sets = [np.sort(pool[:2000]), np.sort(pool[200:2200]), np.sort(pool[2000:])]
    packed = near.signatures(near.minima(sets))
    assert near.estimates(packed[0], packed) == pytest.approx([1.0, 1800 / 2200, 0.0], abs=0.13)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 200), (200, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 200: 100, 300: 100}


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup(none).count() == suffix.suffix_dedup(none).count() == near.near_dedup(none).count() == 0
