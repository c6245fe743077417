"""SentencePiece model files, read without the SentencePiece library.

``parse_model`` decodes the protobuf wire format of a ``ModelProto``;
``build_tokenizer`` rebuilds the model for the ``tokenizers`` library:
normaliser, metaspace marker, unigram scores (or the merges that the scores of
a BPE model imply) and byte fallback.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

SPACE = "▁"

# Enum numbers of the public sentencepiece_model.proto.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


@dataclass
class PieceModel:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True
    charsmap: bytes = b""


def _varint(buf: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = buf[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def _fields(buf: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of one message: ints, floats and byte strings."""
    at = 0
    while at < len(buf):
        key, at = _varint(buf, at)
        number, wire = key >> 3, key & 7
        if wire == 0:
            value, at = _varint(buf, at)
        elif wire == 2:
            size, at = _varint(buf, at)
            value, at = buf[at : at + size], at + size
        elif wire == 5:
            value, at = struct.unpack_from("<f", buf, at)[0], at + 4
        elif wire == 1:
            value, at = struct.unpack_from("<d", buf, at)[0], at + 8
        else:
            raise ValueError(f"wire type {wire} is not part of a model file")
        yield number, value


def parse_model(data: bytes) -> PieceModel:
    model, normalizer = PieceModel(), {}
    for number, value in _fields(data):
        if number == 1:  # pieces
            piece = {1: b"", 2: 0.0, 3: NORMAL} | dict(_fields(value))
            model.pieces.append((piece[1].decode("utf-8"), float(piece[2]), int(piece[3])))
        elif number == 2:  # trainer_spec
            spec = dict(_fields(value))
            model.model_type = int(spec.get(3, UNIGRAM))
            model.byte_fallback = bool(spec.get(35, 0))
            model.unk_id = int(spec.get(40, 0))
        elif number == 3:  # normalizer_spec
            normalizer |= dict(_fields(value))
    model.charsmap = normalizer.get(2, b"")
    model.add_dummy_prefix = bool(normalizer.get(3, 1))
    model.remove_extra_whitespaces = bool(normalizer.get(4, 1))
    model.escape_whitespaces = bool(normalizer.get(5, 1))
    if model.model_type not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models can be rebuilt")
    return model


def implied_merges(model: PieceModel) -> list[tuple[str, str]]:
    """Every way to make a piece of two pieces, best scored piece first.

    A BPE model merges the adjacent pair whose union scores best, so the order
    of the union's scores is the order of the merges.
    """
    score = {p: s for p, s, kind in model.pieces if kind in (NORMAL, USER_DEFINED)}
    merges = []
    for piece in sorted(score, key=lambda p: -score[p]):
        merges += [(piece[:i], piece[i:]) for i in range(1, len(piece)) if piece[:i] in score and piece[i:] in score]
    return merges


#: A run of blanks with the letters, digits or signs after it.
SEGMENT = r" *[^\W\d_²³¹¼½¾]+| *\d+| *(?:[^\w ]|[_²³¹¼½¾])+| +"
#: The same of a text that is all ASCII, whose sets of characters are looked up faster.
ASCII_SEGMENT = r" *[A-Za-z]+| *[0-9]+| *[^A-Za-z0-9 ]+| +"


def cuts_at_segments(model: PieceModel) -> bool:
    """Whether every piece lies inside one ``SEGMENT``.

    Then no piece crosses from a segment to the next one, and the segments of
    a text may be encoded one by one with the same result.  It also takes a
    normaliser that changes nothing but blanks to markers.
    """
    whole = re.compile(SEGMENT).findall
    inside = all(len(whole(p.replace(SPACE, " "))) == 1 for p, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED, UNUSED))  # unused pieces are merged before they are taken apart
    return inside and model.escape_whitespaces and not model.remove_extra_whitespaces and not model.charsmap and (model.byte_fallback or model.model_type == BPE)


def piece_widths(model: PieceModel) -> list[int]:
    """UTF-8 bytes of a text that each piece stands for; of one that stands for
    none, or for any number, more than a text has."""
    none = 1 << 32
    width = {NORMAL: lambda p: len(p.replace(SPACE, " ").encode()) or none, BYTE: lambda p: 1}
    width[USER_DEFINED] = width[UNUSED] = width[NORMAL]
    return [width.get(kind, lambda p: none)(p) for p, _, kind in model.pieces]


def build_tokenizer(model: PieceModel, merges: bool = True):
    """The model as a tokenizer; without ``merges`` it can decode only."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    if model.model_type == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unk_id, model.byte_fallback)
    else:
        core = models.BPE(
            vocab={p: i for i, (p, _, _) in enumerate(model.pieces)},
            merges=implied_merges(model) if merges else [],
            unk_token=model.pieces[model.unk_id][0],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
            cache_capacity=0,  # what is encoded seldom comes again
        )
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_extra_whitespaces:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    mark = SPACE if model.escape_whitespaces else " "
    if model.escape_whitespaces:
        steps.append(normalizers.Replace(" ", SPACE))
    if model.add_dummy_prefix:
        steps.append(normalizers.Prepend(mark))
    tokenizer.normalizer = normalizers.Sequence(steps)
    last = [decoders.Strip(" ", 1, 0)] if model.add_dummy_prefix else []
    tokenizer.decoder = decoders.Sequence([decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse(), *last])
    return tokenizer


def without_prefix(data: bytes) -> bytes:
    """The model file, set to add no blank before a text.

    Fields of a message that comes again in a file override the earlier ones.
    """
    return data + bytes([3 << 3 | 2, 2, 3 << 3, 0])


def build_decoder(model: PieceModel):
    """A tokenizer that only decodes: control pieces are left out, the unknown
    piece reads as the library writes it, and the blank that is put before a text
    stays (whether there is one depends on the first piece)."""
    from tokenizers import AddedToken, decoders

    reader = build_tokenizer(model, merges=False)
    unknown = model.pieces[model.unk_id][0]
    reader.decoder = decoders.Sequence([decoders.Replace(unknown, " \u2047 "), decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()])
    reader.add_special_tokens([AddedToken(p, special=True, normalized=False) for p, _, kind in model.pieces if kind == CONTROL])
    return reader


def describe(model: PieceModel) -> str:
    kinds = [kind for _, _, kind in model.pieces]
    return json.dumps(
        {
            "pieces": len(kinds),
            "type": "unigram" if model.model_type == UNIGRAM else "bpe",
            "byte_pieces": kinds.count(BYTE),
            "cut_at_segments": cuts_at_segments(model),
        }
    )
