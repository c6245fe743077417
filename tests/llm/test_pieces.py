"""SentencePiece: parity with the library on BPE and unigram models."""

import re
import struct

import pytest
import sentencepiece

from eventlake.llm import piece_model as pm
from eventlake.llm.sentence_pieces import PieceCodec, _parts, decode_pieces, encode_pieces, load_model

ODD = [
    "", " ", "  a  b ", "a  ", "   ", "\n\t x", "</s>[INST] ok [/INST]", "<0x0A> <unk> <s>", "日本語 emoji 😀🤯", "a▁b", "▁▁x", "▁",
    "x" * 3000, " " * 700, "\u0000a", "é̂ ", "the" * 400, "----=====", "    indented\n        code", "½²x_9 9_", "1234 5,6.7", "Straße größer über",
]


def field(number: int, wire: int, body: bytes) -> bytes:
    head = bytes([number << 3 | wire]) if number < 16 else bytes([(number << 3 | wire) & 0x7F | 0x80, number >> 4])
    return head + (bytes([len(body) & 0x7F | 0x80, len(body) >> 7]) if wire == 2 and len(body) > 127 else bytes([len(body)]) if wire == 2 else b"") + body


def unigram_model(byte_fallback: bool = True) -> bytes:
    """A small unigram model, put together by hand."""
    pieces = [("<unk>", 0.0, pm.UNKNOWN), ("<s>", 0.0, pm.CONTROL), ("</s>", 0.0, pm.CONTROL)]
    if byte_fallback:
        pieces += [(f"<0x{i:02X}>", 0.0, pm.BYTE) for i in range(256)]
    words = ["▁the", "▁th", "▁", "he", "t", "h", "e", "▁cat", "c", "a", "at", "s", "▁sat", ".", "▁on", "o", "n", "▁mat", "m", "ing", "i", "g", "r", "▁running", "un", "nn"]
    pieces += [(w, -2.0 - 0.37 * k, pm.NORMAL) for k, w in enumerate(words)]
    out = b"".join(field(1, 2, field(1, 2, p.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, bytes([k]))) for p, s, k in pieces)
    trainer = field(3, 0, bytes([pm.UNIGRAM])) + (field(35, 0, b"\x01") if byte_fallback else b"")
    normal = field(1, 2, b"identity") + field(3, 0, b"\x01") + field(4, 0, b"\x00") + field(5, 0, b"\x01")
    return out + field(2, 2, trainer) + field(3, 2, normal)


@pytest.fixture(scope="module")
def model():
    return load_model()


def test_parser_reads_what_the_library_reads(model):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    read = pm.parse_model(model)
    assert len(read.pieces) == library.get_piece_size()
    for i in (0, 1, 2, 3, 258, 259, 1000, 31999):
        assert read.pieces[i][0] == library.id_to_piece(i)
        assert read.pieces[i][1] == pytest.approx(library.get_score(i))
    assert read.byte_fallback and read.add_dummy_prefix and not read.remove_extra_whitespaces


@pytest.mark.parametrize("part", [1 << 20, 3])
def test_ids_and_texts_are_the_librarys(model, part):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    codec = PieceCodec(model, memory=5, part=part)
    assert codec.by_segments
    ids, parity, same = codec.encode(ODD)
    assert parity.all()
    assert [list(map(int, x)) for x in ids] == [library.encode(t) for t in ODD]
    assert codec.decode(ids) == [library.decode(library.encode(t)) for t in ODD]
    assert same.tolist() == ["▁" not in t for t in ODD]


def test_long_words_count_for_what_they_take(model):
    """A few words of many ids fill the memory as many short ones do."""
    codec = PieceCodec(model, memory=10)
    codec.encode(["qzxj" * 100])
    assert len(codec.known) == 1 and len(codec.ids) > 80
    codec.encode(["cat"])
    assert len(codec.known) == 1 and len(codec.ids) <= 80


def test_a_full_memory_keeps_what_is_used_most(model):
    """Frequent words are not given to the libraries again each time it is full."""
    codec, asked = PieceCodec(model, memory=10), []
    one_by_one = codec._encoded
    codec._encoded = lambda texts: (asked.extend(texts), one_by_one(texts))[1]
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    for i in range(12):
        texts = ["the cat the cat", " ".join(f"w{chr(97 + i)}{chr(97 + j)}q" for j in range(6)), "é cat 7"]
        ids, parity, same = codec.encode(texts)
        assert [list(map(int, x)) for x in ids] == [library.encode(t) for t in texts] and parity.all() and same.all()
        assert len(codec.uses) == len(codec.known) == len(codec.sizes) == len(codec.same) == len(codec.back)
        assert sum(codec.sizes) == len(codec.ids)
    assert asked.count(" the") == asked.count(" cat") == 1 and asked.count(" waaq") == 1


class Counted:
    """A tokenizer that lists what it is given, and reads ids through ``seen``."""

    def __init__(self, inner, seen=lambda text: text):
        self.inner, self.seen, self.given = inner, seen, []

    def encode_batch_fast(self, texts, **options):
        self.given += texts
        return self.inner.encode_batch_fast(texts, **options)

    def decode_batch(self, ids, **options):
        return [self.seen(x) for x in self.inner.decode_batch(ids, **options)]


def test_new_segments_go_to_the_tokenizer_joined(model):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = [" ".join(f"w{chr(97 + i)}{chr(97 + j)}q" for j in range(20)) + ".\n7é  " for i in range(20)] + ODD
    codec = PieceCodec(model)
    codec.tokenizer = Counted(codec.tokenizer)
    ids, parity, same = codec.encode(texts)
    assert [x.tolist() for x in ids] == [library.encode(t) for t in texts] and parity.all()
    assert same.tolist() == ["▁" not in t for t in texts]
    assert len(codec.tokenizer.given) < 90 < 400 < len(codec.known)


def test_joined_segments_that_are_not_read_again_go_one_by_one(model):
    """Each segment keeps its own flag and ids, whatever it is joined with."""
    texts = ["the cat", "a mat on it", "cat", "one two three"]
    codec = PieceCodec(model)
    want = [x.tolist() for x in codec.encode(texts)[0]]
    codec = PieceCodec(model)
    codec.reader = Counted(codec.reader, lambda text: text.replace("cat", "dog"))
    ids, parity, same = codec.encode(texts)
    assert [x.tolist() for x in ids] == want and parity.all() and same.tolist() == [False, True, False, True]
    codec = PieceCodec(model)
    codec.widths[:] = 1  # nothing ends where a segment does
    ids, parity, same = codec.encode(texts)
    assert [x.tolist() for x in ids] == want and parity.all() and same.all()


def test_ascii_texts_are_cut_like_others():
    texts = ["a  b_c 12x", "__  ", "\t\n x\x00\x1f~", " 9 9", "a" * 5 + "  ", ".,;a-b", "".join(map(chr, range(128)))]
    assert [re.findall(pm.ASCII_SEGMENT, t) for t in texts] == [re.findall(pm.SEGMENT, t) for t in texts]


@pytest.mark.parametrize("fallback", [True, False])
def test_unigram_model_by_hand(fallback):
    data = unigram_model(fallback)
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["the cat sat on the mat.", "running", "thethe  cats", "zebra", "", "a", " tat", "x cat y"]
    codec = PieceCodec(data)
    ids, parity, same = codec.encode(texts)
    theirs = [library.encode(t) for t in texts]
    assert [list(map(int, x)) == y for x, y in zip(ids, theirs)] == parity.tolist()
    assert [x == t for x, t in zip(codec.decode(ids), texts)] == same.tolist()
    if fallback:
        assert parity.all()
        assert codec.decode(ids) == [library.decode(library.encode(t)) for t in texts]


def test_ids_that_no_text_has_are_read_as_the_library_reads_them(model):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    codec = PieceCodec(model)
    odd = [[3 + 0xFF, 3 + 0xC3], [1, 2], [0], []]
    assert codec.decode(odd) == [library.decode(x) for x in odd]


def test_ids_are_the_rebuilt_tokenizers_where_the_library_differs(model):
    codec = PieceCodec(model)
    codec.library = sentencepiece.SentencePieceProcessor(model_proto=unigram_model())  # another model's ids
    ids, parity, same = codec.encode(["the cat sat"])
    assert not parity[0] and same[0]
    assert ids[0].tolist() == pm.build_tokenizer(pm.parse_model(model)).encode("the cat sat", add_special_tokens=False).ids


def test_a_long_text_without_blanks(model):
    codec = PieceCodec(model, part=1000)
    text = "añb" * 5000
    ids, parity, same = codec.encode([text])
    assert parity[0] and same[0] and codec.decode(ids) == [text]


def test_whole_texts_match_the_library(spark, model):
    from eventlake.llm.common import table

    texts = [r["text"] for r in table(spark, "/root/testdata/sf0.01", "documents").select("text").collect()]
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    ids, parity, same = PieceCodec(model).encode(texts)
    assert [x.tolist() for x in ids] == library.encode(texts) and parity.all() and same.all()


def test_long_texts_are_cut_before_blanks():
    text = "ab  cd e" * 50
    assert "".join(_parts(text, 7)) == text
    assert all(p[0] == " " and not p.endswith(" ") for p in list(_parts(text, 7))[1:])


def test_table_with_nulls_and_clashing_names(spark, model):
    rows = spark.createDataFrame([(1, "the cat", "x"), (1, "the cat", "x"), (2, None, "y"), (None, "", "z")], "doc_id long, text string, n_tokens string")
    out = {(r["doc_id"], r["text"]): r for r in encode_pieces(rows, model).collect()}
    assert encode_pieces(rows, model).count() == 4
    assert out[2, None]["token_ids"] is None and out[2, None]["n_tokens"] == 0 and out[2, None]["parity"] is None
    assert out[None, ""]["token_ids"] == [] and out[None, ""]["round_trip"]
    assert out[1, "the cat"]["parity"] and out[1, "the cat"]["n_tokens"] == len(out[1, "the cat"]["token_ids"])
    back = decode_pieces(encode_pieces(rows, model), model, out="again").collect()
    assert all(r["again"] == r["text"] for r in back)
    assert encode_pieces(rows.limit(0), model).count() == 0


def test_unused_pieces_that_cross_segments_forbid_cuts(model):
    read = pm.parse_model(model)
    assert pm.cuts_at_segments(read)
    read.pieces.append(("a▁b", -1.0, pm.UNUSED))
    assert not pm.cuts_at_segments(read)
