"""Operator 2: secret scan by rules and by a randomness test battery.

Rules find assignments, access keys and long hexadecimal runs. The battery
looks at every other run of 16 or more key characters: what the rules' spans
leave of a stretch of key characters, split at '=' (but one or two at the end
are pads). Where no alphabet holds a run, its longest parts within each alphabet
are tested in its place; found parts may overlap, and masking joins them. The
encoding of a run is the
smallest alphabet that holds all its characters; under "symbols are independent
and uniform over that alphabet" three tests run: chi-squared uniformity (with
the exact mean and variance for the length), runs above/below the middle of the
alphabet, and lag-1 serial correlation. A run that any test rejects at
``RANDOM_LEVEL`` (divided by three tests) is not random and is no candidate for
a key. Nor is a run of one class of characters (letters of one case, a capital
and small letters, or digits, whatever symbols stand between them): words of any
language and plain numbers are such runs, also words whose letter pairs the
corpus does not hold. What is left is tested against "ordinary text": the
likelihood ratio of the uniform alphabet to the corpus's own character
transitions, counted over all documents but outside of every run that is long
enough to be tested. The counts do not depend on the runs under test, so
1 / ratio is a valid p-value, a key that was copied a thousand times is found a
thousand times, and the p-value shrinks with the length of the run.
Benjamini-Hochberg at ``FDR`` then holds over all runs of the corpus within each
length class, so that many short runs do not spend the budget of long ones.
Transitions and the histogram of p-values have fixed sizes.

Spans count in code points, end exclusive. Defined results: a null text counts
as empty; rows are judged one by one, so repeated rows, null ids, ties and
further columns need no rule; texts of any length are scanned whole, one text or
``CHUNK`` bytes of texts at a time; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import arrow_texts, doc_chunks, fresh, store

KINDS = ("assign", "access", "hex", "random")
MIN_RUN = 16
RANDOM_LEVEL = 0.001
FDR = 0.01
LENGTH_CLASSES = (16, 24, 32, 48, 64, 128)   # lower ends
STEP, TOP = 0.25, 240                         # bins of -log10(p)
CHUNK = 4 << 20

# The base rules of the contract.
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24

# Encodings by the size of their alphabet.
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = {
    "decimal": DIGITS, "hex": DIGITS + "abcdef", "upper hex": DIGITS + "ABCDEF", "lower": LOWER,
    "upper": UPPER, "base32": UPPER + "234567", "base36": DIGITS + LOWER, "letters": UPPER + LOWER,
    "base62": UPPER + LOWER + DIGITS, "base64": UPPER + LOWER + DIGITS + "+/",
    "base64url": UPPER + LOWER + DIGITS + "-_",
}
VALUE = re.compile(rb"[^=]+(?:={1,2}\Z)?")
WITHIN = [re.compile(b"[" + re.escape(a.encode()) + rb"]+(?:={1,2}\Z)?") for a in ENCODINGS.values()]
KEY_CHARS = DIGITS + LOWER + UPPER + "+/-_="
N_SYM = len(KEY_CHARS) + 1                    # the last: any other byte

SPAN = T.ArrayType(T.StructType([
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("kind", T.StringType()), T.StructField("length_class", T.IntegerType()),
    T.StructField("p_bin", T.IntegerType())]))

_SYM = np.full(256, N_SYM - 1, np.int64)
_SYM[np.frombuffer(KEY_CHARS.encode(), np.uint8)] = np.arange(N_SYM - 1)
_HEX = np.zeros(256, bool)
_HEX[np.frombuffer(b"0123456789abcdef", np.uint8)] = True
_RANK = {}
for _name, _alphabet in ENCODINGS.items():
    _RANK[_name] = np.full(256, -1, np.int64)
    _RANK[_name][np.frombuffer(_alphabet.encode(), np.uint8)] = np.arange(len(_alphabet))


def ordinary_pairs(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Numbers of the transitions of a chunk that lie outside of every run of
    ``MIN_RUN`` or more key characters, and within one document."""
    s = _SYM[buf]
    open_ = np.zeros(len(buf) + 1, np.int8)
    starts, ends = _runs(s < N_SYM - 1, offsets, MIN_RUN)
    open_[starts] += 1
    open_[ends] -= 1
    within = np.cumsum(open_[:-1], dtype=np.int8) > 0
    keep = ~(within[:-1] & within[1:])
    cut = offsets[(offsets > 0) & (offsets < len(buf))]
    keep[cut - 1] = False
    return (s[:-1] * N_SYM + s[1:])[keep]


def transitions(docs: DataFrame) -> np.ndarray:
    """Log probability of each key character after each in ordinary text, over
    all documents: a table of ``N_SYM`` squared numbers whatever the corpus."""
    def count(batches):
        import pyarrow as pa

        total = np.zeros(N_SYM * N_SYM, np.int64)
        for b in batches:
            buf, off = arrow_texts(b.column(0))
            for i, j in doc_chunks(off, CHUNK):
                if off[j] > off[i]:
                    total += np.bincount(ordinary_pairs(buf[off[i]:off[j]], off[i:j + 1] - off[i]),
                                         minlength=N_SYM * N_SYM)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])

    rows = (docs.select(F.col("text").cast("string")).mapInArrow(count, "pair long, n long")
            .groupBy("pair").agg(F.sum("n").alias("n")).collect())
    n = np.full(N_SYM * N_SYM, 0.5)
    for r in rows:
        n[r.pair] += r.n
    n = n.reshape(N_SYM, N_SYM)[:, :-1]
    return np.log(n / n.sum(1, keepdims=True))


def upper_chi2(x: float, df: float) -> float:
    """Upper tail of chi-squared, by the cube-root normal approximation."""
    v = 2 / (9 * df)
    return 0.5 * math.erfc(((max(x, 0) / df) ** (1 / 3) - 1 + v) / math.sqrt(2 * v))


def battery(run: np.ndarray) -> tuple[str, float] | None:
    """(encoding, least of the three p-values times three) of a run of bytes."""
    body = run[:len(run) - (run[-2:] == 61).sum()] if run[-1] == 61 else run   # '=' pads
    for name, alphabet in ENCODINGS.items():
        x = _RANK[name][body]
        if x.min() >= 0:
            break
    else:
        return None
    n, a = len(x), len(alphabet)
    seen = np.bincount(x, minlength=a)
    stat = float((seen.astype(float) ** 2).sum() * a / n - n)
    shrink = (n - 1) / n                      # variance 2 (a - 1) (n - 1) / n
    p1 = upper_chi2((stat - (a - 1)) / math.sqrt(shrink) + a - 1, a - 1)
    high = x >= a // 2
    q = (a // 2) / a
    same = 2 * q * (1 - q)
    runs = int((high[1:] != high[:-1]).sum())
    z2 = (abs(runs - (n - 1) * same) - 0.5) / math.sqrt((n - 1) * same * (1 - same))
    p2 = math.erfc(max(z2, 0) / math.sqrt(2))
    c = x - (a - 1) / 2
    r = float((c[1:] * c[:-1]).sum()) / ((a * a - 1) / 12) / math.sqrt(n - 1)
    p3 = math.erfc(abs(r) / math.sqrt(2))
    return name, min(1.0, 3 * min(p1, p2, p3))


_WORD = rb"(?:[A-Z]?[a-z]+|[A-Z]+)"
_SYMBOL = rb"[^A-Za-z0-9]"
ONE_CLASS = re.compile(rb"%s*(?:%s(?:%s+%s)*|[0-9]+(?:%s+[0-9]+)*)?%s*" % (_SYMBOL, _WORD, _SYMBOL, _WORD, _SYMBOL, _SYMBOL))


def text_bin(run: np.ndarray, alphabet: int, logq: np.ndarray) -> int:
    """-log10 of the p-value under ordinary text, in steps, rounded down."""
    s = _SYM[run]
    ratio = -(len(s) - 1) * math.log(alphabet) - float(logq[s[:-1], s[1:]].sum())
    return int(min(TOP, max(0.0, ratio / math.log(10) / STEP)))


def _runs(mask: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of stretches of ``mask``, cut where documents begin."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(len(mask) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(mask & (np.concatenate(([True], ~mask[:-1])) | cut[:-1]))
    ends = np.flatnonzero(mask & (np.concatenate((~mask[1:], [True])) | cut[1:])) + 1
    long = ends - starts >= least
    return starts[long], ends[long]


def parts(run: bytes):
    """(start, end) of what is tested in a run of key characters."""
    for m in VALUE.finditer(run):
        if m.end() - m.start() < MIN_RUN:
            continue
        if any(w.fullmatch(m.group()) for w in WITHIN):
            yield m.span()
        else:
            yield from sorted({(m.start() + x.start(), m.start() + x.end()) for w in WITHIN
                               for x in w.finditer(m.group()) if x.end() - x.start() >= MIN_RUN})


def scan(buf: np.ndarray, offsets: np.ndarray, logq: np.ndarray):
    """(document, start, end, kind, length class, p bin) of all spans of a chunk,
    in order; byte positions are already code points."""
    raw = buf.tobytes()
    low = raw.lower()
    found: dict[int, list] = {}
    add = lambda d, *x: found.setdefault(int(d), []).append(x)
    doc_of = lambda at: np.searchsorted(offsets, at, "right") - 1
    # documents with a keyword, then the rule over the whole document
    docs = set()
    for w in KEYWORDS:
        at = low.find(w)
        while at >= 0:
            d = int(doc_of(at))
            docs.add(d)
            at = low.find(w, max(at + 1, int(offsets[d + 1]) - len(w) + 1))
    for d in docs:
        lo, hi = int(offsets[d]), int(offsets[d + 1])
        for m in ASSIGN.finditer(low[lo:hi]):
            if m.end() - m.start(2) >= MIN_VALUE:
                add(d, lo + m.start(), lo + m.end(), 0, None, None)
    at = raw.find(b"AKIA")
    while at >= 0:
        d = int(doc_of(at))
        m = ACCESS.match(raw, at, int(offsets[d + 1]))
        if m and m.end() - at >= MIN_ACCESS:
            add(d, at, m.end(), 1, None, None)
        at = raw.find(b"AKIA", m.end() if m else at + 1)
    for s, e in zip(*_runs(_HEX[buf], offsets, MIN_HEX)):
        add(doc_of(s), int(s), int(e), 2, None, None)
    rules = {d: sorted((a, b) for a, b, *_ in spans) for d, spans in found.items()}
    for s, e in zip(*_runs(_SYM[buf] < N_SYM - 1, offsets, MIN_RUN)):
        d = int(doc_of(s))
        left, at = [], int(s)
        for a, b in rules.get(d, ()):          # what no rule has
            if a < e and s < b:
                left.append((at, a))
                at = max(at, b)
        for lo, hi in [*left, (at, int(e))]:
            for a, b in parts(raw[lo:hi]):
                run = buf[lo + a:lo + b]
                got = battery(run)
                if got is None or got[1] < RANDOM_LEVEL or ONE_CLASS.fullmatch(raw, lo + a, lo + b):
                    p = -1                     # counted among the tests, never found
                else:
                    p = text_bin(run, len(ENCODINGS[got[0]]), logq)
                cls = int(np.searchsorted(LENGTH_CLASSES, b - a, "right")) - 1
                add(d, lo + a, lo + b, 3, cls, p)
    for d in sorted(found):
        lo = int(offsets[d])
        point = np.concatenate(([0], np.cumsum((buf[lo:int(offsets[d + 1])] & 0xC0) != 0x80)))
        for s, e, k, cls, b in sorted(found[d], key=lambda x: (x[0], x[2])):
            yield d, int(point[s - lo]), int(point[e - lo]), KINDS[k], cls, b


def candidates(docs: DataFrame, carry: list[str], name: str) -> DataFrame:
    """The columns ``carry`` with ``name``: rule spans and tested runs."""
    logq = transitions(docs)
    schema = T.StructType([docs.schema[c] for c in carry] + [T.StructField(name, SPAN)])

    def find(batches):
        import pyarrow as pa

        kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()),
                          ("length_class", pa.int32()), ("p_bin", pa.int32())])
        for b in batches:
            buf, off = arrow_texts(b.column(b.num_columns - 1))
            per = np.zeros(b.num_rows, np.int64)
            rows = []
            for i, j in doc_chunks(off, CHUNK):
                part = off[i:j + 1] - off[i]
                for d, *x in scan(buf[off[i]:off[j]], part, logq):
                    per[i + d] += 1
                    rows.append(dict(zip(("start", "end", "kind", "length_class", "p_bin"), x)))
            ends = pa.array(np.concatenate(([0], np.cumsum(per))), pa.int32())
            spans = pa.ListArray.from_arrays(ends, pa.array(rows, kind))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], spans], [*carry, name])

    (text,) = fresh(docs, "__scanned")
    return docs.select(*[F.col(f"`{c}`") for c in carry],
                       F.col("text").cast("string").alias(text)).mapInArrow(find, schema)


def thresholds(found: DataFrame, name: str, fdr: float = FDR) -> dict[int, int]:
    """Length class -> least p bin that Benjamini-Hochberg accepts (classes
    without one are absent); from a histogram of fixed size."""
    hist = (found.select(F.explode(name).alias("s")).where("s.kind = 'random'")
            .groupBy("s.length_class", "s.p_bin").agg(F.count(F.lit(1)).alias("n")).collect())
    out = {}
    for cls in {r.length_class for r in hist}:
        mine = sorted(((r.p_bin, r.n) for r in hist if r.length_class == cls), reverse=True)
        tests, above = sum(n for _, n in mine), 0
        for b, n in mine:
            above += n
            if b >= 0 and 10 ** (-STEP * b) * tests / above <= fdr:
                out[cls] = b
    return out


def secrets(docs: DataFrame, carry: list[str], name: str = "spans", fdr: float = FDR) -> DataFrame:
    """The columns ``carry`` of ``docs`` and ``name``: array of found spans."""
    found = store(candidates(docs, carry, name), "secret-candidates")
    least = thresholds(found, name, fdr)
    accept = lambda s: s["kind"] != "random"
    for cls, b in least.items():
        accept = (lambda f, cls, b: lambda s: f(s) | ((s["length_class"] == cls) & (s["p_bin"] >= b)))(accept, cls, b)
    return found.withColumn(name, F.transform(
        F.filter(name, lambda s: F.coalesce(accept(s), F.lit(False))),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans per document."""
    s = secrets(docs, ["doc_id"], "spans", fdr)
    base = F.filter("spans", lambda x: x["kind"] != "random")
    n = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    return s.select("doc_id", *[n(k).alias(f"n_{k}") for k in KINDS[:3]],
                    F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                    joined(F.col("spans")).alias("spans"), n("random").alias("n_random"))


def masked(text: Column, spans: Column, mark: str = "<SECRET>") -> Column:
    """The text with every span replaced; overlapping spans become one."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    take = lambda a, b: F.substr(text, (a + 1).cast("int"), (b - a).cast("int"))
    step = lambda acc, s: F.when(s["start"] < acc["at"], F.struct(
        acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))).otherwise(F.struct(
            F.concat(acc["out"], take(acc["at"], s["start"]), F.lit(mark)).alias("out"), s["end"].alias("at")))
    return F.aggregate(spans, start, step, lambda a: F.concat(
        a["out"], F.substr(text, (a["at"] + 1).cast("int"), F.length(text))))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document stays, its secrets are masked."""
    (name,) = fresh(docs, "__spans")
    s = secrets(docs, docs.columns, name)
    new = {"text": F.when(F.size(name) > 0, masked(F.col("text"), F.col(name))).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.size(name) > 0, F.length(masked(F.col("text"), F.col(name))).cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return s.withColumns(new).select(*docs.columns)
