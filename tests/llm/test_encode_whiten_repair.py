"""Operators 11 to 13 against the tiktoken library, numpy and brute force."""

import base64
import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from strata.llm import bytebpe, repair, whitening
from strata.llm.queries import QUERIES, public_tokenizers

SF = "/root/testdata/sf0.001"


# --- operator 11 -----------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    import tiktoken

    files = public_tokenizers()
    path = files.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        raw = f.read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    return path, files.PATTERN, raw, tiktoken.Encoding("own", pat_str=files.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = ["", None, " ", "\n\n  x", "don't we'll", "日本語のテキスト 中文", "ß" * 700, "ab" * 3000, " " * 1500 + "x",
         "á \U0001f600\U0001f600", "<|endoftext|>", "x" * 513, "\x00\x1c\x85 z", "12345678901234567890 % ***"]


def test_byte_bpe_equals_tiktoken(spark, tokenizer):
    path, pattern, _, ref = tokenizer
    docs = spark.createDataFrame([(i, t, "x", [1]) for i, t in enumerate(TEXTS + TEXTS)] + [(None, "again", "x", [1])],
                                 "doc_id long, text string, ids string, decoded array<int>")
    got = bytebpe.encode(docs, path, pattern, decoded=True).collect()
    for r in got:
        text = "again" if r.doc_id is None else TEXTS[r.doc_id % len(TEXTS)] or ""
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == ref.encode_ordinary(text)
        assert bytes(r["decoded"]).decode() == text
    assert len(got) == 2 * len(TEXTS) + 1
    assert bytebpe.report(docs.limit(0), path, pattern).count() == 0


def test_byte_bpe_query_on_a_table(spark, tokenizer):
    ref = tokenizer[3]
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op11_byte_bpe"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = np.array(ref.encode_ordinary(docs[r.doc_id]), "<u4")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_byte_bpe_rows_long_texts_and_broken_ids(tokenizer, monkeypatch):
    _, pattern, raw, ref = tokenizer
    enc = bytebpe.Encoder(raw, pattern)
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghéñ日") for _ in range(rng.randint(1, 900))) for _ in range(300)]
    for w, ids in zip(words, enc.ranks.encode_all([w.encode() for w in words])):
        assert np.frombuffer(ids, "<u4").tolist() == ref.encode_ordinary(w)
    monkeypatch.setattr(bytebpe, "LONG", 50)
    monkeypatch.setattr(bytebpe, "KEPT", 20)
    text = " ".join(words)
    assert np.frombuffer(enc.pack([text])[0], "<u4").tolist() == ref.encode_ordinary(text)
    assert enc.ranks.decode(b"\xff\xff\xff\x7f") is None and enc.ranks.decode(b"abc") is None and enc.ranks.decode(None) is None


def test_byte_bpe_decodes_a_stored_table(spark, tokenizer):
    path, pattern, _, _ = tokenizer
    docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: bytes(r.decoded) for r in bytebpe.decode(bytebpe.encode(docs, path, pattern), path).collect()}
    assert got == {1: b"one two", 2: b""}


# --- operator 12 -----------------------------------------------------------

@pytest.mark.parametrize("d,m", [(8, 5), (8, 60), (24, 10), (24, 300), (1, 4), (5, 1)])
def test_spectrum_by_rank_one_updates(d, m):
    rng = np.random.default_rng(d * m)
    x = np.floor(rng.normal(0, 8, (m, d))).astype(np.int64) + whitening.SHIFT
    if d == 8:
        x[:, 3], x[:, 5] = whitening.SHIFT, x[:, 2]          # equal and empty directions
    c = x - x.mean(0)
    want = np.linalg.eigvalsh(c.T @ c)
    whole, a, b = whitening.Spectrum(d), whitening.Spectrum(d), whitening.Spectrum(d)
    whole.add(x)
    a.add(x[:m // 2])
    b.add(x[m // 2:])
    a.merge(b) if a.n else a.__dict__.update(b.__dict__)
    for s in (whole, a):
        assert s.n == m and s.sums == x.sum(0).tolist()
        assert np.allclose(s.values, want, atol=1e-6 * max(1, want.max()))
        assert np.allclose((s.basis * s.values) @ s.basis.T, c.T @ c, atol=1e-6 * max(1, want.max()))
        assert np.allclose(s.basis.T @ s.basis, np.eye(d), atol=1e-10)


def brute_whitened(rows):
    x = np.array([np.floor(64 * np.array(v, float)).astype(np.int64) + 1_000_000 for _, v in rows])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    c = fit - s / n
    v = c.T @ c / n
    e, w = np.linalg.eigh(v)
    e, w = e[::-1], w[:, ::-1]
    dev = ((n * x - s) ** 2).sum(1)
    return n, dev, (x - s / n) @ w / np.sqrt(np.maximum(e, 1e-300)), e / np.trace(v)


def check_whitened(got, rows, k):
    n, dev, z, share = brute_whitened(rows)
    by = defaultdict(dict)
    for r in got:
        by[r.vec_id][r.component] = r
    assert sorted(by) == sorted(i for i, _ in rows)
    for c in range(1, k + 1):
        mine = np.array([by[i][c].whitened for i, _ in rows])
        sign = np.sign(mine @ z[:, c - 1])
        assert np.abs(mine - sign * z[:, c - 1]).max() < 1e-6
    for j, (i, _) in enumerate(rows):
        assert set(by[i]) == set(range(1, k + 1))
        for c, r in by[i].items():
            assert r.n == n and r.deviation == dev[j] and abs(r.explained - share[c - 1]) < 1e-8 * share[c - 1] + 1e-15
            assert r.identity_error < 1e-6 and r.deviation_wide is None


def test_whitening_against_numpy(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)                  # several levels of combining
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 1, 20).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(200)]      # a large group of copies counts once
    bad = [(2000, None), (2001, []), (2002, [None] + [0.5] * 19), (2003, [float("nan")] * 20),
           (2004, [float("inf")] * 20), (2005, [1.0, 2.0])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>")
    df = df.selectExpr("vec_id", "embedding", "'y' as x", "1 as n").repartition(7)
    check_whitened(whitening.report(df).collect(), rows, 16)


def test_whitening_query_on_a_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = QUERIES["op12_embedding_whitening"](spark, SF).collect()
    check_whitened(got, rows, 16)


def test_whitening_degenerate_tables(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whitening.report(make([])).count() == 0
    assert whitening.report(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    got = whitening.report(make([(1, [1.0, 0.0]), (2, [2.0, 0.0]), (None, [4.0, 0.0]), (1, [1.0, 0.0])])).collect()
    assert len(got) == 4 and {r.component for r in got} == {1} and {r.n for r in got} == {3}
    big = make([(1, [3e16]), (2, [-3e16]), (3, [0.0])])       # squares beyond a long
    for r in whitening.report(big).collect():
        assert (r.deviation is None) == (r.deviation_wide is not None)
    wide = {r.vec_id: r.deviation_wide for r in whitening.report(big).collect()}
    x = {i: int(np.floor(64 * np.float64(np.float32(v)))) + 1_000_000 for i, v in ((1, 3e16), (2, -3e16), (3, 0.0))}
    assert int(wide[1]) == (3 * x[1] - sum(x.values())) ** 2


# --- operator 13 -----------------------------------------------------------

WHITE = " \t\n\x0b\f\r"


def brute_parse(symbols):
    """Least (cost, audit) by a backward walk over rows and states."""
    nxt = {"S": "U", "X": "U", "A": "U", "U": "A"}
    end = {"S": (0, ""), "A": (0, ""), "U": (3, "I"), "X": (6, "II")}
    after = end
    for x in reversed(symbols):
        more = 3 if x.isupper() else 0
        edit = {}
        for p in "SXUA":
            options = [(4 + after[p][0], "D" + after[p][1])]
            if x not in "bd":
                options.append((3 + more + after[nxt[p]][0], "R" + after[nxt[p]][1]))
                q = {"s": "X" if p == "S" else None, "u": "U" if p != "U" else None,
                     "a": "A" if p == "U" else None}.get(x.lower())
                if q:
                    options.append((more + after[q][0], "K" + after[q][1]))
            edit[p] = min(options)
        here = dict(edit)
        for _ in range(3):
            here = {p: min(here[p], (3 + here[nxt[p]][0], "I" + here[nxt[p]][1])) for p in here}
        after = here
    return after["S"]


def all_splits(symbols):
    """The same grammar over all spans and all split points."""
    n = len(symbols)
    if not n:
        return repair.best(repair.INSERTED)
    cell = {(i, i + 1): repair.row_cell(x) for i, x in enumerate(symbols)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            out = {}
            for k in range(i + 1, i + length):
                for pq, v in repair.join(cell[i, k], cell[k, i + length]).items():
                    out[pq] = min(out.get(pq, v), v)
            cell[i, i + length] = out
    return repair.best(cell[0, n])


def by_listing(symbols):
    """Every list of edits with up to two insertions at each place."""
    found = []
    for edits in itertools.product(*["D" if x in "bd" else "DKR" for x in symbols]):
        for gaps in itertools.product(range(3), repeat=len(symbols) + 1):
            roles, cost, audit = [""], 0, ""
            for i, g in enumerate(gaps):
                cost += 3 * g
                audit += "I" * g
                roles = [r + "".join(w) for r in roles for w in itertools.product("ua", repeat=g)]
                if i < len(edits):
                    e, x = edits[i], symbols[i]
                    audit += e
                    cost += {"D": 4, "K": 0, "R": 3}[e] + (3 if e != "D" and x.isupper() else 0)
                    add = {"D": [""], "K": [x.lower()], "R": ["u", "a"]}[e]
                    roles = [r + a for r in roles for a in add]
            if any(re.fullmatch("(s?(ua)+)?", r) for r in roles):
                found.append((cost, audit))
    return min(found)


def test_parse_equals_listing_all_splits_and_walk():
    rng = random.Random(1)
    small = [s for n in range(3) for s in itertools.product("suaxUbd", repeat=n)]
    for s in small + [rng.choices("suaxUSAbd", k=3) for _ in range(30)]:
        assert repair.parse("".join(s)) == brute_parse(s) == by_listing(s), s
    for _ in range(200):
        s = "".join(rng.choice("ssuuaaxSUAXbd") for _ in range(rng.randint(0, 14)))
        assert repair.parse(s) == brute_parse(s) == all_splits(s), s
    s = "".join(rng.choice("suauaUAbd") for _ in range(700))
    assert repair.parse(s) == brute_parse(s)


def brute_repair(rows):
    """conv_id -> result, row by row."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(key.encode()) % 20
        out = convs[conv]
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    result = {}
    for conv, got in convs.items():
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        symbols, seen, counts = "", set(), [0, 0, 0]
        ini = [r[1][:1] if r[1][:1] in list("sua") else "x" for r in got]
        for (turn, role, text), i in zip(got, ini):
            bare = text.strip(WHITE)
            x = "b" if not bare else "d" if (role, text) in seen else i.upper() if bare[-1] not in ".!?" else i
            seen.add((role, text))
            counts = [a + b for a, b in zip(counts, (x == "b", x == "d", x.isupper()))]
            symbols += x
        cost, audit = brute_parse(symbols)
        lines, rest, last = [], iter(got), "a"
        for e in audit:
            row = next(rest) if e != "I" else None
            if e == "D":
                continue
            if e == "K":
                last = row[1][0]
                lines.append(f"{row[1]}:{row[2]}")
            else:
                last = "a" if last == "u" else "u"
                lines.append(("user:" if last == "u" else "assistant:") + (row[2] if row else ""))
        turns = {r[0] for r in got if r[0] is not None}
        result[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts,
                        sum(a + b not in ("su", "ua", "au") for a, b in zip(ini, ini[1:])), cost, audit,
                        hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return result


def hard_rows():
    rng = random.Random(9)
    texts = ["Hi.", "Yes!", "so", "", " \t", "Why?\n", "a.b", None, "é?", "x" * 200 + "."]
    rows = [(c, t, rng.choice(["system", "user", "user", "assistant", "assistant", "tool", None, ""]), rng.choice(texts))
            for c in range(40) for t in range(rng.randint(1, 9))]
    rows += [(50, None, "user", "Hi."), (50, None, "user", "Hi."), (50, None, "assistant", "Yes!"), (50, 5, "user", "Hi."),
             (None, 1, "user", "Hi."), (None, 7, "assistant", "Hi."), (None, None, "user", None)]
    rows += [(60, 3, "user", "Hi.")] * 30                                          # repeated rows
    rows += [(61, t, "user" if t % 2 == 0 else "assistant", "Same.") for t in range(60)]   # hot text
    rows += [(c, t, "user", "Hi.") for c, t in itertools.product(range(70, 75), range(40))
             if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]                         # nothing left
    return rows


@pytest.mark.parametrize("limit", [repair.MAX_ROWS, 3, 0])
def test_repair_equals_brute_force_in_both_ways(spark, limit):
    rows = hard_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "conv_id long, turn long, role string, text string, m string, cost int").repartition(5)
    got = repair.repair(repair.damaged(df), max_rows=limit).collect()
    want = brute_repair(rows)
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r.conv_id], (r.conv_id, tuple(r))


def test_repair_query_on_a_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = brute_repair(rows)
    got = QUERIES["op13_conversation_repair"](spark, SF).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == want and len(got) == len(want)


def test_repair_empty_table(spark):
    assert repair.report(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
