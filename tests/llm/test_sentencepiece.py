"""Parity, round trips and edge cases of the rebuilt tokenizer."""

import os

import pytest

from strata.llm import sentencepiece as S

MODEL = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers") + "/piece_bpe_32k.model"
TEXTS = ["Hello world", "  two  spaces\tand\n\nlines ", "naïve café – „Straße“ 東京 \U0001F600\u200d", "", None, "a" * 5000,
         "<s> is text </s> <unk> <0x41>", "x " * 3000, "\u2581mark", "\x00\x01 control"]


def test_parity_and_round_trip(spark):
    df = spark.createDataFrame([(i if i else None, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, ids int")
    rows = {r.doc_id: r for r in S.encode(df, MODEL).collect()}
    assert len(rows) == len(TEXTS) and all(r.parity for r in rows.values())
    for i, t in enumerate(TEXTS):
        if "\u2581" not in (t or ""):
            assert rows[i or None].decoded == (t or ""), t
    enc = S.encode(df, MODEL)
    back = {r.doc_id: r.text for r in S.decode(enc, MODEL).collect()}
    assert back == {k: r.decoded for k, r in rows.items()}
    assert S.report(df.where("false"), MODEL).count() == 0


def test_every_document_is_encoded_alike(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = S.report(docs, MODEL).collect()
    assert len(rows) == docs.count() and all(r.parity and r.n_tokens > 0 for r in rows)


def test_fields_reads_wire_types():
    raw = bytes([8, 150, 1]) + bytes([18, 2]) + b"ab" + bytes([29, 0, 0, 128, 63])
    assert list(S.fields(raw)) == [(1, 150), (2, b"ab"), (3, 1.0)]


def test_unigram_model_uses_scores():
    m = S.Model(pieces=[("<unk>", 0.0, S.UNKNOWN), ("\u2581", -3.0, 1), ("a", -4.0, 1), ("b", -4.0, 1), ("ab", -2.0, 1),
                        ("\u2581a", -3.5, 1)], kind=S.UNIGRAM, remove_extra_space=False)
    tok = S.build(m)
    assert tok.encode("ab b").tokens == ["\u2581", "ab", "\u2581", "b"]
    assert tok.decode(tok.encode("ab b").ids) == "ab b"
    with pytest.raises(ValueError):
        S.build(S.Model(pieces=m.pieces, kind=3))
