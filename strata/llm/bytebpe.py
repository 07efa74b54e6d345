"""Operator 11: byte-level BPE encoding and decoding in padded numpy matrices.

The rank file gives every token's bytes and rank (its id). Each match of the
split pattern is encoded separately. A match that is a token as a whole is that
token; of the others, every distinct one of a group of texts becomes one row of
a matrix, rows of like length together (``BUCKETS``), short rows padded. Each
round, all rows of a matrix look at the ranks of their adjacent pairs, merge the
leftmost pair of least rank and move the rest of the row one column left. Pair
ranks come from a hash table over all (left id, right id) that make a token;
after a merge only the two pairs beside it are looked up anew. Finished rows
leave the matrix. A row longer than the last bucket is folded into a matrix of
its own, ``FOLD`` columns wide, whose row minima find the leftmost least pair,
so that a match of a million letters takes time in proportion to its length.

``encode`` gives the ids as packed little-endian unsigned 32-bit integers, the
form in which token files are stored; ``decode`` turns them into bytes.

Defined results: a null text counts as empty and has no tokens. Rows are encoded
one by one, so repeated rows, null ids and ties need no rule; an empty table
gives an empty result; columns other than those asked for are ignored. Texts of
any length are encoded whole; those over ``LONG`` characters are split into
matches lazily, so that few matches are held at once. Null or broken ids (a
number without a token, a length that is no multiple of four) decode to null.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import U, mix

BUCKETS = (4, 8, 12, 16, 24, 32, 64, 128, 256, 512)   # longest row of each matrix, in bytes
FOLD = 512              # columns of a folded long row
ROWS = 20_000           # rows of a matrix
GROUP_CHARS = 500_000   # characters of the texts encoded together
LONG = 1_000_000        # characters from which a text's matches are read lazily
KEPT = 300_000          # matches remembered per Python worker
KEPT_CHARS = 64         # longest match remembered

NONE = np.iinfo(np.int32).max
FREE = U(0xFFFFFFFFFFFFFFFF)


class Ranks:
    """Tokens by id, ids by bytes, and the hash table of pairs."""

    def __init__(self, raw: bytes):
        lines = (line.split() for line in raw.splitlines() if line)
        self.ids = {base64.b64decode(t): int(r) for t, r in lines}
        self.tokens: list[bytes | None] = [None] * (max(self.ids.values(), default=-1) + 1)
        for t, r in self.ids.items():
            self.tokens[r] = t
        self.byte = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        left, right, made = [], [], []
        for t, r in self.ids.items():
            for k in range(1, len(t)):
                a, b = self.ids.get(t[:k]), self.ids.get(t[k:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    made.append(r)
        self._fill(np.array(left, np.int32), np.array(right, np.int32), np.array(made, np.int32))

    @staticmethod
    def _key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a.astype(np.uint32).astype(U) << U(32)) | b.astype(np.uint32).astype(U)

    def _fill(self, a, b, made) -> None:
        size = 1 << max(10, int(4 * len(a)).bit_length())
        self.mask = U(size - 1)
        self.keys, self.made = np.full(size, FREE, U), np.full(size, NONE, np.int32)
        key = self._key(a, b)
        slot = mix(key) & self.mask
        while len(key):                       # all pairs try their slot, losers the next one
            free = self.keys[slot] == FREE
            self.keys[slot[free]] = key[free]
            won = self.keys[slot] == key
            self.made[slot[won]] = made[won]
            key, made, slot = key[~won], made[~won], (slot[~won] + U(1)) & self.mask

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Id made by each pair (its rank), or ``NONE``; -1 is padding."""
        key = self._key(a, b)
        slot = mix(key) & self.mask
        seen = self.keys[slot]
        out = np.where(seen == key, self.made[slot], NONE)
        todo = np.flatnonzero((seen != key) & (seen != FREE))
        while len(todo):
            slot.ravel()[todo] = (slot.ravel()[todo] + U(1)) & self.mask
            at = slot.ravel()[todo]
            seen, want = self.keys[at], key.ravel()[todo]
            hit = seen == want
            out.ravel()[todo[hit]] = self.made[at[hit]]
            todo = todo[~hit & (seen != FREE)]
        return out

    def merge_rows(self, ids: np.ndarray) -> list[bytes]:
        """Packed ids of each row of a padded matrix of byte ids."""
        out: list = [None] * len(ids)
        rows = np.arange(len(ids))
        ranks = self.pair(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = ranks.argmin(1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
            best = ranks[np.arange(len(rows)), at] if ranks.shape[1] else np.full(len(rows), NONE)
            live = best != NONE
            if not live.all():
                done = ids[~live]
                flat = done[done >= 0].astype("<u4").tobytes()
                ends = np.cumsum((done >= 0).sum(1) * 4).tolist()
                for r, i, j in zip(rows[~live].tolist(), [0, *ends], ends):
                    out[r] = flat[i:j]
                rows, ids, ranks, at, best = rows[live], ids[live], ranks[live], at[live], best[live]
                if not len(rows):
                    break
            # compaction: what is right of the merged pair moves one place left
            col = np.arange(ids.shape[1] - 1)
            every = np.arange(len(rows))
            ids = np.take_along_axis(ids, col + (col > at[:, None]), 1)
            ids[every, at] = best
            # pair at+1 is gone; those beside the new token are looked up below
            col = col[:-1]
            ranks = np.take_along_axis(ranks, col + (col >= at[:, None]), 1)
            for side in (at - 1, at):
                has = np.flatnonzero((side >= 0) & (side < ranks.shape[1]))
                ranks[has, side[has]] = self.pair(ids[has, side[has]], ids[has, side[has] + 1])
        return out

    def merge_long(self, ids: np.ndarray) -> np.ndarray:
        """The same for one long row: neighbours by links, minima by block."""
        n = len(ids)
        ranks = np.full(-(-n // FOLD) * FOLD, NONE, np.int32)
        ranks[:n - 1] = self.pair(ids[:-1], ids[1:])
        fold = ranks.reshape(-1, FOLD)
        least = fold.min(1)
        ids, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        tokens, known = self.tokens, self.ids

        def look(i):
            if i >= 0 and after[i] < n:
                r = known.get(tokens[ids[i]] + tokens[ids[after[i]]])
                ranks[i] = NONE if r is None else r
            elif i >= 0:
                ranks[i] = NONE

        while True:
            b = int(least.argmin())
            if least[b] == NONE:
                break
            i = b * FOLD + int(fold[b].argmin())
            j = after[i]
            ids[i], ids[j] = int(ranks[i]), -1
            ranks[j] = NONE
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            look(i)
            look(before[i])
            for k in {i // FOLD, j // FOLD, max(before[i], 0) // FOLD}:
                least[k] = fold[k].min()
        return np.array([x for x in ids if x >= 0], "<u4")

    def encode_all(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each piece."""
        out: list = [None] * len(pieces)
        for i, whole in enumerate(map(self.ids.get, pieces)):
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
        rest = np.array([i for i, x in enumerate(out) if x is None], np.int64)
        bucket = np.searchsorted(BUCKETS, [len(pieces[i]) for i in rest])
        for k in np.unique(bucket):
            members = rest[bucket == k].tolist()
            if k == len(BUCKETS):
                for i in members:
                    out[i] = self.merge_long(self.byte[np.frombuffer(pieces[i], np.uint8)]).tobytes()
                continue
            for lo in range(0, len(members), ROWS):
                part = members[lo:lo + ROWS]
                flat = np.frombuffer(b"".join(pieces[i] for i in part), np.uint8)
                lens = np.array([len(pieces[i]) for i in part])
                ids = np.full((len(part), int(lens.max(initial=0))), -1, np.int32)
                ids[np.arange(ids.shape[1]) < lens[:, None]] = self.byte[flat]
                for i, row in zip(part, self.merge_rows(ids)):
                    out[i] = row
        return out

    def decode(self, packed: bytes | None) -> bytes | None:
        if packed is None or len(packed) % 4:
            return None
        try:
            return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))
        except (IndexError, TypeError):       # no such token
            return None


class Encoder:
    """Splits texts and remembers the ids of frequent matches."""

    def __init__(self, raw: bytes, pattern: str):
        import regex

        self.ranks, self.pattern, self.kept = Ranks(raw), regex.compile(pattern), {}

    def _learn(self, matches: set[str]) -> list[str]:
        """Encode what is not known yet; returns the matches too long to keep."""
        if len(self.kept) > KEPT:
            self.kept.clear()
        new = list(matches.difference(self.kept))
        self.kept.update(zip(new, self.ranks.encode_all([m.encode() for m in new])))
        return [m for m in new if len(m) > KEPT_CHARS]

    def _forget(self, matches: list[str]) -> None:
        for m in matches:
            del self.kept[m]

    def pack(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        split = [self.pattern.findall(t) if len(t) <= LONG else None for t in texts]
        long = self._learn(set().union(*(s for s in split if s)))
        get = self.kept.__getitem__
        out = [None if s is None else b"".join(map(get, s)) for s in split]
        self._forget(long)
        return [self._pack_long(t) if s is None else o for t, s, o in zip(texts, split, out)]

    def _pack_long(self, text: str) -> bytes:
        out, part = [], []

        def flush():
            long = self._learn(set(part))
            out.append(b"".join(map(self.kept.__getitem__, part)))
            self._forget(long)
            part.clear()

        for m in self.pattern.finditer(text):
            part.append(m.group())
            if len(part) >= 100_000:
                flush()
        flush()
        return b"".join(out)


_LOADED: dict[str, Encoder] = {}


def _load(raw: bytes, pattern: str) -> Encoder:
    """Once per Python worker."""
    key = hashlib.sha256(raw + pattern.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Encoder(raw, pattern)
    return _LOADED[key]


def _file(docs: DataFrame, path: str):
    with open(path, "rb") as f:                # a fixed file beside the library
        return docs.sparkSession.sparkContext.broadcast(f.read())


def _groups(chars: list[int]):
    """Numbers of consecutive texts of at most ``GROUP_CHARS`` together, or one."""
    texts = total = 0
    for n in chars:
        if texts and total + n > GROUP_CHARS:
            yield texts
            texts = total = 0
        texts += 1
        total += n
    if texts:
        yield texts


def encode(docs: DataFrame, path: str, pattern: str, decoded: bool = False,
           carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` and ``ids`` (binary, packed); with ``decoded`` also
    the bytes that those ids stand for."""
    raw = _file(docs, path)
    names = [*carry, "ids", *(["decoded"] if decoded else [])]

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        enc = _load(raw.value, pattern)
        for b in batches:
            at, texts = 0, b.column(b.num_columns - 1)
            for n in _groups(pc.utf8_length(pc.fill_null(texts, "")).to_pylist()):
                ids = enc.pack([t or "" for t in texts.slice(at, n).to_pylist()])
                cols = [pa.array(ids, pa.binary())]
                if decoded:
                    cols.append(pa.array(map(enc.ranks.decode, ids), pa.binary()))
                yield pa.RecordBatch.from_arrays([c.slice(at, n) for c in b.columns[:-1]] + cols, names)
                at += n

    schema = T.StructType([docs.schema[c] for c in carry] + [T.StructField(c, T.BinaryType()) for c in names[len(carry):]])
    return docs.select(*[F.col(f"`{c}`") for c in carry], F.col("text").cast("string")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` and ``decoded`` (binary) of a table with ``ids``."""
    raw = _file(encoded, path)

    def run(batches):
        import pyarrow as pa

        ranks = _load(raw.value, "").ranks
        for b in batches:
            out = pa.array([ranks.decode(x) for x in b.column(b.num_columns - 1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], out], [*carry, "decoded"])

    schema = T.StructType([encoded.schema[c] for c in carry] + [T.StructField("decoded", T.BinaryType())])
    return encoded.select(*[F.col(f"`{c}`") for c in carry], "ids").mapInArrow(run, schema)


def report(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per document."""
    return encode(docs, path, pattern, decoded=True).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
