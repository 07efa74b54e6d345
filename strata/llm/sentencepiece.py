"""Operator 6: SentencePiece encoding and decoding on the tokenizers library.

The model file is a protobuf; its fields are read here, and the pipeline is
rebuilt: normaliser (identity, with the dummy prefix and white-space switches),
metaspace marker, pieces with their scores, byte fallback. A unigram model
becomes a ``Unigram`` model with the scores; a BPE model becomes a ``BPE`` model
whose merges are ranked by the score of the piece they make. The ids are those
of the rebuilt encoder, by ``encode_batch`` with ``THREADS`` threads per Python
worker; ``parity`` says for every text whether the sentencepiece library gives
the same ids. Decoding is the tokenizers decoder chain.

Where no piece holds the marker after another character (``separable`` reads
that off the vocabulary), no merge crosses the place before a run of markers:
a text's ids are those of its parts cut there, one after the other, and its
parity is that of all its parts. Equal parts are then encoded, checked and
decoded once, and the ids of short parts are remembered. Other models, and unigram
models, whose sums of scores run over the text, encode whole texts.

The model's path is a parameter; its bytes (a fixed file, read on the driver)
are broadcast. Defined results: a null text has no tokens and decodes to the
empty text; repeated rows and null ids are encoded row by row; an empty table
gives an empty result; other columns are ignored. Texts of any length are encoded
whole, in groups of ``BATCH_CHARS`` characters or one text. A character U+2581
in a text decodes to a space, as in SentencePiece.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THREADS = 2
BATCH_CHARS = 250_000
CACHE_WORDS = 10_000
KEPT, KEPT_CHARS = 400_000, 64     # parts remembered per worker, and the longest of them
JOINED = 20_000                    # characters of parts that are encoded as one text
MARK = "▁"

# Field numbers and codes of the published model format.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6


def _varint(b: bytes, i: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        c = b[i]
        i += 1
        out |= (c & 127) << shift
        shift += 7
        if c < 128:
            return out, i


def fields(b: bytes):
    """(field number, value) of a protobuf message: int, bytes or float."""
    i = 0
    while i < len(b):
        tag, i = _varint(b, i)
        kind = tag & 7
        if kind == 0:
            v, i = _varint(b, i)
        elif kind == 2:
            n, i = _varint(b, i)
            v, i = b[i:i + n], i + n
        elif kind == 5:
            v, i = struct.unpack_from("<f", b, i)[0], i + 4
        elif kind == 1:
            v, i = struct.unpack_from("<d", b, i)[0], i + 8
        else:
            raise ValueError(f"unsupported wire type {kind}")
        yield tag >> 3, v


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)   # text, score, type
    kind: int = UNIGRAM
    byte_fallback: bool = False
    rule: str = ""
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra_space: bool = True
    escape_space: bool = True


def parse(raw: bytes) -> Model:
    """The parts of a model file that encoding depends on."""
    m = Model()
    for n, v in fields(raw):
        if n == PIECES:
            piece = {1: b"", 2: 0.0, 3: NORMAL} | dict(fields(v))
            m.pieces.append((piece[1].decode(), piece[2], piece[3]))
        elif n == TRAINER:
            t = dict(fields(v))
            m.kind, m.byte_fallback = t.get(3, UNIGRAM), bool(t.get(35, 0))
        elif n == NORMALIZER:
            t = dict(fields(v))
            m.rule, m.charsmap = t.get(1, b"").decode(), t.get(2, b"")
            m.dummy_prefix, m.remove_extra_space = bool(t.get(3, 1)), bool(t.get(4, 1))
            m.escape_space = bool(t.get(5, 1))
    return m


def merges(m: Model) -> list[tuple[str, str]]:
    """Pairs of pieces that join to a piece, best piece first."""
    vocab = {p: i for i, (p, _, _) in enumerate(m.pieces)}
    out = []
    for p, score, kind in m.pieces:
        if kind == NORMAL:
            for k in range(1, len(p)):
                a, b = vocab.get(p[:k]), vocab.get(p[k:])
                if a is not None and b is not None:
                    out.append((-score, a, b, p[:k], p[k:]))
    return [(x[3], x[4]) for x in sorted(out)]


def build(m: Model):
    """A tokenizers.Tokenizer equal to the SentencePiece model."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

    unk = next((i for i, p in enumerate(m.pieces) if p[2] == UNKNOWN), None)
    if m.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in m.pieces], unk, m.byte_fallback)
    elif m.kind == BPE:
        core = models.BPE({p: i for i, (p, _, _) in enumerate(m.pieces)}, merges(m), cache_capacity=CACHE_WORDS,
                          unk_token=None if unk is None else m.pieces[unk][0], fuse_unk=True,
                          byte_fallback=m.byte_fallback)
    else:
        raise ValueError(f"model type {m.kind} is not a unigram or BPE model")
    tok = Tokenizer(core)
    steps = [normalizers.Precompiled(m.charsmap)] if m.charsmap else []
    if m.remove_extra_space:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
    # the metaspace marker, always put before a text that wants a prefix; the
    # text stays whole, as runs of markers may form pieces of their own
    steps += [normalizers.Prepend(MARK)] if m.dummy_prefix else []
    steps.append(normalizers.Replace(" ", MARK))
    tok.normalizer = normalizers.Sequence(steps)
    tok.add_special_tokens([AddedToken(p, special=True, normalized=False) for p, _, k in m.pieces if k == CONTROL])
    tok.encode_special_tokens = True          # their strings in a text are ordinary text
    tok.add_tokens([AddedToken(p, normalized=False) for p, _, k in m.pieces if k == USER])
    tok.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
                                    + ([decoders.Strip(" ", 1, 0)] if m.dummy_prefix else []))
    return tok


def separable(m: Model) -> bool:
    """Whether texts may be cut before each run of markers: every such part
    starts with a marker that is a piece, and no piece reaches over the cut."""
    plain = not m.charsmap and not m.remove_extra_space and m.dummy_prefix and m.escape_space
    return (m.kind == BPE and plain and any(p == MARK and k == NORMAL for p, _, k in m.pieces)
            and not any(k == USER or MARK in p.lstrip(MARK) for p, _, k in m.pieces))


class Coder:
    """The rebuilt tokenizer beside the sentencepiece library."""

    def __init__(self, raw: bytes):
        import numpy as np
        import sentencepiece

        model = parse(raw)
        self.tok, self.ref = build(model), sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.cut = separable(model)
        self.begins = np.array([p.startswith(MARK) for p, _, _ in model.pieces])
        self.marks = np.array([p.strip(MARK) == "" for p, _, _ in model.pieces])
        self.ids: dict[str, bytes] = {}        # of parts, packed
        self.texts: dict[str, str] = {}        # what those ids decode to
        self.bad: set[str] = set()             # parts without parity

    def whole(self, texts: list[str]) -> list[tuple]:
        """(packed ids, parity, decoded) of each text, encoded as it is."""
        ids = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        same = [x == y for x, y in zip(ids, self.ref.encode(texts, num_threads=THREADS))]
        back = self.tok.decode_batch(ids, skip_special_tokens=False)
        return [(struct.pack(f"<{len(i)}i", *i), s, d) for i, s, d in zip(ids, same, back)]

    def _keep(self, part: str, ids: bytes, same: bool, text: str) -> None:
        self.ids[part], self.texts[part] = ids, text
        if not same:
            self.bad.add(part)

    def _learn(self, parts: list[str]) -> None:
        """Encode, check and decode parts, many joined to one text. A token
        begins a part if it starts with a marker and the one before it is not of
        markers alone; where the count of such tokens, the library's ids or the
        decoded text differ from what is due, parts go one by one."""
        import numpy as np

        alone = [p for p in parts if p.endswith(MARK)]
        runs, size = [], JOINED
        for p in parts:
            if not p.endswith(MARK):
                if size >= JOINED:
                    runs.append([])
                    size = 0
                runs[-1].append(p)
                size += len(p)
        raws = [[p[1:].replace(MARK, " ") for p in run] for run in runs]
        joined = [" ".join(r) for r in raws]
        codes = [np.array(e.ids, "<i4") for e in self.tok.encode_batch_fast(joined, add_special_tokens=False)]
        theirs = self.ref.encode(joined, num_threads=THREADS)
        back = self.tok.decode_batch([c.tolist() for c in codes], skip_special_tokens=False)
        for run, raw, text, ids, ref, decoded in zip(runs, raws, joined, codes, theirs, back):
            first = self.begins[ids]
            first[1:] &= ~self.marks[ids[:-1]]
            at = np.flatnonzero(first).tolist()
            if len(at) == len(run) and decoded == text and np.array_equal(ids, ref):
                packed, pos = ids.tobytes(), 0
                for p, r, i, j in zip(run, raw, at, [*at[1:], len(ids)]):
                    self._keep(p, packed[4 * i:4 * j], True, decoded[pos:pos + len(r)])
                    pos += len(r) + 1
            else:
                alone += run
        for p, got in zip(alone, self.whole([p[1:].replace(MARK, " ") for p in alone])):
            self._keep(p, *got)

    def encode(self, texts: list[str]) -> list[tuple]:
        """(packed ids, parity, decoded) of each text."""
        if not self.cut:
            return self.whole(texts)
        # the first marker of a part is the one that both encoders put before a
        # text, so a part is encoded as the text behind that marker
        parts = [PART.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.ids) > KEPT:
            for kept in (self.ids, self.texts, self.bad):
                kept.clear()
        new = list(set().union(*parts).difference(self.ids))
        self._learn(new)
        ids, back = self.ids.__getitem__, self.texts.__getitem__
        out = [(b"".join(map(ids, p)), self.bad.isdisjoint(p), " ".join(map(back, p))) for p in parts]
        for p in new:
            if len(p) > KEPT_CHARS:
                del self.ids[p], self.texts[p]
                self.bad.discard(p)
        return out


#: A run of markers and what follows; markers at the end of a text stay with the
#: last part, since a lone marker is no text that could be encoded by itself.
PART = re.compile(rf"{MARK}+[^{MARK}]+(?:{MARK}+\Z)?|{MARK}+")
_LOADED: dict[str, Coder] = {}


def _load(raw: bytes) -> Coder:
    """Once per Python worker."""
    key = hashlib.sha256(raw).hexdigest()
    if key not in _LOADED:
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        _LOADED[key] = Coder(raw)
    return _LOADED[key]


def groups(lengths: list[int], limit: int = BATCH_CHARS):
    """Numbers of consecutive texts of at most ``limit`` characters together,
    or one text; so few token lists are held at once."""
    texts = chars = 0
    for n in lengths:
        if texts and chars + n > limit:
            yield texts
            texts = chars = 0
        texts += 1
        chars += n
    if texts:
        yield texts


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids (array of int), parity, decoded."""
    with open(model_path, "rb") as f:          # a fixed file beside the library
        raw = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        coder = _load(raw.value)
        for b in batches:
            at = 0
            for n in groups(pc.utf8_length(pc.fill_null(b.column(1), "")).to_pylist()):
                rows = coder.encode([t or "" for t in b.column(1).slice(at, n).to_pylist()])
                flat = np.frombuffer(b"".join(r[0] for r in rows), "<i4")
                ends = np.cumsum([0, *(len(r[0]) // 4 for r in rows)])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, n), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                     pa.array([r[1] for r in rows], pa.bool_()), pa.array([r[2] for r in rows], pa.string())],
                    ["doc_id", "ids", "parity", "decoded"])
                at += n

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, ids array<int>, parity boolean, decoded string")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id, text of a table of doc_id and ids."""
    with open(model_path, "rb") as f:
        raw = encoded.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        import pyarrow as pa

        tok = _load(raw.value).tok
        for b in batches:
            texts = tok.decode_batch([x or [] for x in b.column(1).to_pylist()], skip_special_tokens=False)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def report(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids joined by commas), parity, decoded_sha256."""
    return encode(docs, model_path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        "parity", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
