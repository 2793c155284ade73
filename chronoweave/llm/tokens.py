"""Token ids of whole texts by a public tokenizer, each distinct word encoded once.

The tokenizer drops white space and never joins across it, so a text's ids are its words' ids in order; another tokenizer is
tried on a probe and refused if it does otherwise. A worker keeps the ids of words it has met, up to about ``HELD`` of them,
by a 64-bit hash (a chance of one in a thousand that any two of 10**10 words are taken for each other), and those of
lower-cased letters alone up to ``HELD_CORES``. A long text is encoded in parts that end at white space.
"""

from __future__ import annotations

import gc
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.keyed import ddl
from chronoweave.llm.vector import Words, batch_of, lean, parcels, table_rows

TOKENIZER, END_ID, MOST = "word_bpe_49k.json", 1, 4096
HELD, HELD_CORES = 600_000, 100_000
PIECE_BYTES = 768 << 10
SPACES = re.compile(rb"[\x20\x09-\x0D]")

PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


class WordIds:
    """Ids of words (bytes without white space), found by the 64-bit hashes of whole batches of words at once.

    Held words are four arrays: their hashes, sorted, where in ``ids`` each word's ids stand, how many they are, and the turn in
    which each was last met. Above ``HELD`` words those not met for longest go.
    """

    _made: dict[str, "WordIds"] = {}

    @classmethod
    def of(cls, path: str) -> "WordIds":
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.hash, self.at, self.n, self.met = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.ids, self.turn = np.zeros(0, "<u4"), 0
        self.cores: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {"": b""}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._check()

    def _check(self) -> None:
        """Refuses a tokenizer that does not treat words, letters in either case and marks after them as this class does."""
        probe = "The  quick\tbrown fox, jumps. Über\nél 12 a1 x!? ..."
        whole = self.tokenizer.encode(probe, add_special_tokens=False).ids
        if np.frombuffer(next(self.encode([probe.encode()])), dtype="<u4").tolist() != whole:
            raise ValueError("this tokenizer joins across white space, or tells upper from lower case")

    @staticmethod
    def _plain(word: str) -> bool:
        """Whether a word is Latin letters only, each one character in lower case: one run of letters to the tokenizer."""
        return word.isalpha() and (word.isascii() or (len(low := word.lower()) == len(word) and max(low) < "ɐ"))

    def _encode_cores(self, cores: list[str]) -> None:
        for i in range(0, len(cores), 500):
            some = cores[i : i + 500]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            last = np.flatnonzero(self.ends[ids])
            if len(last) == len(some):
                raw = ids.tobytes()
                at = [0, *(4 * (last + 1)).tolist()]
                self.cores.update(zip(some, [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], strict=True))
            else:
                for word, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                    self.cores[word] = np.array(e.ids, dtype="<u4").tobytes()

    def _ids_of(self, words: list[bytes]) -> list[bytes]:
        """Ids of words by the tokenizer. Nothing made here forms cycles, so the collector needn't look."""
        gc.disable()
        try:
            return self._encoded(words)
        finally:
            gc.enable()

    def _encoded(self, words: list[bytes]) -> list[bytes]:
        if len(self.cores) > HELD_CORES:
            self.cores = {}
        out: list = [None] * len(words)
        late: list[tuple[int, str, str]] = []
        other: list[tuple[int, str]] = []
        cores: set[str] = set()
        known = self.cores
        for i, word in enumerate(words):
            text = word.decode()
            core = text.rstrip(".,;:!?")
            low = core.lower()
            ids = known.get(low)
            if ids is not None and core.isalpha():
                out[i] = ids + self._tail(text[len(core) :])
            elif core and self._plain(core):
                cores.add(low)
                late.append((i, low, text[len(core) :]))
            else:
                other.append((i, text))
        self._encode_cores(sorted(cores))
        for i, low, end in late:
            out[i] = known[low] + self._tail(end)
        if other:
            for (i, _), e in zip(other, self.tokenizer.encode_batch_fast([t for _, t in other], add_special_tokens=False), strict=True):
                out[i] = np.array(e.ids, dtype="<u4").tobytes()
        return out

    def _tail(self, text: str) -> bytes:
        ids = self.tails.get(text)
        if ids is None:
            if len(self.tails) > HELD_CORES:
                self.tails = {"": b""}
            ids = self.tails[text] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return ids

    def _add(self, hashes: np.ndarray, found: list[bytes]) -> None:
        if len(self.hash) > HELD:
            stay = np.flatnonzero(self.met >= np.partition(self.met, len(self.met) // 2)[len(self.met) // 2])
            stay = stay if len(stay) < HELD else stay[:0]
            n = self.n[stay]
            self.ids = self.ids[_spread(self.at[stay], n)]
            self.hash, self.n, self.met, self.at = self.hash[stay], n, self.met[stay], np.cumsum(n, dtype=np.int64) - n
        n = np.array([len(x) // 4 for x in found], dtype=np.int32)
        at = len(self.ids) + np.cumsum(n, dtype=np.int64) - n
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(found), dtype="<u4")])
        order = np.argsort(every := np.concatenate([self.hash, hashes]), kind="stable")
        self.hash = every[order]
        self.at, self.n = np.concatenate([self.at, at])[order], np.concatenate([self.n, n])[order]
        self.met = np.concatenate([self.met, np.full(len(n), self.turn, dtype=np.int32)])[order]

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where sorted hashes stand among those held, and whether they do."""
        at = np.searchsorted(self.hash, hashes)
        return at, (self.hash[np.minimum(at, len(self.hash) - 1)] == hashes) if len(self.hash) else np.zeros(len(hashes), dtype=bool)

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        self.turn += 1
        words = Words(texts)
        hashes, first, which = np.unique(words.hash, return_index=True, return_inverse=True)
        at, there = self._places(hashes)
        self.met[at[there]] = self.turn
        if not there.all():
            new = first[~there]
            raw = words.buf.tobytes()
            self._add(hashes[~there], self._ids_of([raw[a:b] for a, b in zip(words.start[new].tolist(), words.end[new].tolist(), strict=True)]))
            at, there = self._places(hashes)
            if not there.all():  # some of this batch's were among those that had to go
                new = first[~there]
                self._add(hashes[~there], self._ids_of([raw[a:b] for a, b in zip(words.start[new].tolist(), words.end[new].tolist(), strict=True)]))
                at, there = self._places(hashes)
        n = self.n[at][which]
        ids = self.ids[_spread(self.at[at][which], n)].tobytes()
        edge = 4 * np.concatenate([[0], np.cumsum(n, dtype=np.int64)])[words.first]
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            yield ids[a:b]


def _spread(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places at, at + 1, ... of runs of n."""
    edge = np.cumsum(n, dtype=np.int64) - n
    return np.repeat(at - edge, n) + np.arange(int(n.sum()))


def _parts(text: bytes) -> Iterator[bytes]:
    """A text in parts of about ``PIECE_BYTES`` that end at white space."""
    at = 0
    while len(text) - at > 2 * PIECE_BYTES:
        cut = SPACES.search(text, at + PIECE_BYTES)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def _pieces(batches: Iterable[pa.RecordBatch], path: str, most: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    lean()
    ids_of = WordIds.of(path)
    end = np.uint32(END_ID).tobytes()
    for rows in parcels(((d, t.encode()) for d, t in table_rows(batches)), lambda r: len(r[1]) + 64, PIECE_BYTES):
        out = []
        if len(rows) == 1:
            every = [b"".join(x for part in _parts(rows[0][1]) for x in ids_of.encode([part]))]
        else:
            every = ids_of.encode([r[1] for r in rows])
        for (doc_id, _), ids in zip(rows, every, strict=True):
            ids += end
            for n, at in enumerate(range(0, len(ids), 4 * most)):
                own = ids[at : at + 4 * most]
                out.append((doc_id, n, at // 4, len(own) // 4, zlib.crc32(own), own if with_ids else None))
        yield batch_of(PIECE, list(zip(*out, strict=True)))


def pieces_of(docs: DataFrame, path: str | None = None, most: int = MOST, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids (little-endian unsigned 32-bit) of each piece.

    A document's ids end with ``END_ID``; one of more than ``most`` ids is cut every ``most``. A null text is empty, so
    its one piece is that id alone. Each row is a document, also where ids repeat; extra columns are ignored.
    """
    path = path or default_path()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    out = texts.mapInArrow(lambda it: _pieces(it, path, most, with_ids), ddl(PIECE))
    return out if with_ids else out.drop("ids")
