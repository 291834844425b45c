import struct

import public_tokenizers
import pytest
import sentencepiece

import llm_edges
from conftest import SMALL
from tillflow.llm import frames, pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", "a", " a", "a ", "  a  b   c ", "a\n\nb\tc", "▁", "a▁ b", " " * 40 + "x" + " " * 17, "<s></s><unk> <0x0A>",
       "日本語 🤖 é́ \0 ﷽", "aaaaaaaaaaaaaaaaaaaa", "don't 12345 ½", "\r\n \r\n", "x" * 3000, " ", "  ", "Ω​ ﬁ"]


def test_same_ids_as_sentencepiece_and_back(spark):
    docs = spark.createDataFrame(list(enumerate(ODD)) + [(99, None)], "doc_id long, text string")
    own = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = {r["doc_id"]: r for r in pieces.encoded(docs, MODEL).collect()}
    for i, text in enumerate(ODD):
        assert rows[i]["ids"] == own.encode(text), text
        assert rows[i]["parity"] and rows[i]["n_tokens"] == len(rows[i]["ids"])
        assert rows[i]["round_trip"] == ("▁" not in text)
    assert rows[99]["ids"] == []
    back = {r["doc_id"]: r["text"] for r in pieces.decoded(pieces.encoded(docs, MODEL, verify=False), MODEL).collect()}
    assert back == {**{i: own.decode(own.encode(t)) for i, t in enumerate(ODD)}, 99: ""}


def test_whole_table(spark):
    rows = pieces.encoded(frames.table(spark, SMALL), MODEL).select("parity", "round_trip").collect()
    assert len(rows) > 0 and all(r["parity"] and r["round_trip"] for r in rows)


def test_edges(spark):
    rows = pieces.encoded(llm_edges.crowded(spark), MODEL).collect()
    assert len(rows) == len(llm_edges.rows()) and all(r["parity"] for r in rows)
    assert pieces.encoded(llm_edges.empty(spark), MODEL).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert pieces.decoded(nothing, MODEL).collect()[0]["text"] is None


def field(number, value):
    if isinstance(value, float):
        return bytes([number << 3 | 5]) + struct.pack("<f", value)
    if isinstance(value, int):
        tag = bytes([number << 3]) if number < 16 else bytes([number << 3 & 127 | 128, number >> 4])
        return tag + bytes([value])
    return bytes([number << 3 | 2, len(value)]) + value


def unigram(squeeze):
    """A hand-written unigram model file with byte fallback."""
    parts = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *((f"<0x{b:02X}>", 0.0, 6) for b in range(256)),
             ("▁", -2.0, 1), ("▁the", -3.0, 1), ("th", -4.0, 1), ("e", -4.5, 1), ("t", -5.0, 1), ("h", -5.0, 1),
             ("▁t", -4.2, 1), ("he", -4.1, 1), ("cat", -6.0, 1), ("c", -7.0, 1), ("a", -7.0, 1), ("▁▁", -6.5, 1)]
    out = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, k)) for p, s, k in parts)
    trainer = field(3, 1) + field(35, 1)
    return out + field(2, trainer) + field(3, field(1, b"identity") + field(3, 1) + field(4, squeeze))


@pytest.mark.parametrize("squeeze", [0, 1])
def test_unigram_scores_and_normaliser(spark, tmp_path, squeeze):
    path = tmp_path / "unigram.model"
    path.write_bytes(unigram(squeeze))
    own = sentencepiece.SentencePieceProcessor(model_file=str(path))
    texts = ["the cat", "thecat  the", " the  ", "zé the", "", "hat eat", "the\nthe"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pieces.encoded(docs, str(path)).collect():
        assert r["ids"] == own.encode(texts[r["doc_id"]]), texts[r["doc_id"]]
        assert r["parity"]


def test_rejects_other_files(tmp_path):
    (tmp_path / "words.model").write_bytes(field(1, field(1, b"a")) + field(2, field(3, 3)))
    with pytest.raises(ValueError):
        pieces.read_model(str(tmp_path / "words.model"))


def test_cuts_only_where_no_piece_crosses():
    model = pieces.read_model(MODEL)
    assert pieces.splits_at_spaces(model)
    model.pieces.append(("a▁b", -1.0, pieces.NORMAL))
    assert not pieces.splits_at_spaces(model)
