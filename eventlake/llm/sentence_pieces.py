"""SentencePiece encoding and decoding with the ``tokenizers`` library.

The model file is broadcast (its size is fixed); each task parses and rebuilds
it (``piece_model``) and encodes Arrow batches; ids and decoded texts are the
rebuilt tokenizer's.  Where the vocabulary proves that no piece crosses from a
word to its neighbours, the distinct segments of a batch are encoded, some joined
to a text, in one multithreaded call and the texts' ids are put together from them;
else whole texts are encoded.  What is encoded is decoded again, and compared with the
SentencePiece library: ``round_trip`` says whether the ids read as the text, and
``parity`` whether the library gives the same ids.

Defined results: null text: null ids, 0 tokens, null flags; empty text: no
ids; repeated rows: one result each; extra columns pass through, except that
the output columns replace columns of the same names; empty table: no rows.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, spare, table, tokenizer_file
from .piece_model import ASCII_SEGMENT, BPE, CONTROL, SEGMENT, SPACE, build_decoder, build_tokenizer, cuts_at_segments, parse_model, piece_widths, without_prefix

MODEL = "piece_bpe_32k.model"
#: Segments that a task remembers, and ids of them all for each segment on average;
#: a full memory keeps its half that was used most, which costs time only.
MEMORY = 200_000
IDS = 8
#: Characters that are taken at a time.
PART = 1 << 18
#: Segments given to the libraries in one call: their answers take about a kilobyte each.
CALL = 8192
#: Segments joined to one text for the tokenizers library, after one without a blank.
JOIN = 16
#: Threads of one task's tokenizers library; each keeps memory of its own.
THREADS = 2


def load_model(path: str | None = None) -> bytes:
    with open(path or tokenizer_file(MODEL), "rb") as f:
        return f.read()


class Numbers(dict):
    """Numbers of words, given when they are first asked for; ``new`` ones are listed."""

    def __init__(self, known=()):
        super().__init__(known)
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        self.new.append(word)
        return at


class PieceCodec:
    """Encodes and decodes batches of texts inside one task."""

    def __init__(self, data: bytes, memory: int = MEMORY, part: int = PART):
        import sentencepiece

        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        self.data = data
        self.model = parse_model(data)
        self.by_segments = cuts_at_segments(self.model)
        plain = without_prefix(data) if self.by_segments else data
        self.tokenizer = build_tokenizer(parse_model(plain))
        self.library = sentencepiece.SentencePieceProcessor(model_proto=plain)
        self.memory, self.part = memory, part
        self.find, self.find_ascii = re.compile(SEGMENT).findall, re.compile(ASCII_SEGMENT).findall
        self.reader = build_decoder(self.model)
        self.hidden = {i for i, (_, _, kind) in enumerate(self.model.pieces) if kind == CONTROL}
        self.widths = np.array(piece_widths(self.model), np.int64)
        self.join = JOIN if self.model.model_type == BPE else 0  # sums of unigram scores are rounded
        self.marked = np.array([piece.startswith(SPACE) for piece, _, _ in self.model.pieces], bool)
        self._forget()

    def _forget(self) -> None:
        self.known = Numbers()
        self.sizes, self.ids, self.same, self.back = array("q"), array("i"), array("b"), array("b")
        self.uses = np.zeros(0, np.int64)

    def _trim(self) -> None:
        """Forget all but the segments used most, of those used twice or more."""
        known, sizes, flat, same, back = self.known, *(np.array(x) for x in (self.sizes, self.ids, self.same, self.back))
        best = np.argsort(-self.uses, kind="stable")
        best = best[self.uses[best] > 1][: self.memory // 2]
        best = np.sort(best[np.cumsum(sizes[best]) <= IDS * self.memory // 2])
        uses = self.uses[best] // 2
        self._forget()
        self.uses = uses
        place = np.full(len(sizes), -1, np.int64)
        place[best] = np.arange(len(best))
        kept = place.tolist()
        self.known = Numbers((word, kept[at]) for word, at in known.items() if kept[at] >= 0)
        starts = np.cumsum(sizes) - sizes
        self.sizes.frombytes(sizes[best].astype(np.int64).tobytes())
        self.ids.frombytes(flat[_runs(starts[best], sizes[best])].astype(np.int32).tobytes())
        self.same.frombytes(same[best].astype(np.int8).tobytes())
        self.back.frombytes(back[best].astype(np.int8).tobytes())

    def _encoded(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Of some texts at a time: number of ids of each, the ids, whether the library
        has the same, and whether they read as the text."""
        for a in range(0, len(texts), CALL):
            part = texts[a : a + CALL]
            sizes, ids, back = self._joined(part) if self.by_segments and self.join else self._single(part)
            theirs = self.library.encode(part, num_threads=1)
            if not len(sizes) == len(theirs) == len(back) == len(part):
                raise ValueError("a text has no answer")
            yield sizes, ids, _same_runs(sizes, ids, *_flat(theirs)), back

    def _single(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of ids of each text, the ids, and whether they read as the text."""
        mine = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        read = self.reader.decode_batch(mine, skip_special_tokens=True) if self.by_segments else self.decode(mine)
        return *_flat(mine), np.array([x == y for x, y in zip(read, texts, strict=True)], bool)

    def _joined(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``_single``, of segments that are encoded and read some at a time.

        A segment with a blank before it ends the one before, so joined ones are
        cut alike and no piece crosses.  Where the ids' widths do not end with the
        segments, or the joined text is not read again, its segments go one by one.
        """
        heads = [i for i, s in enumerate(segments) if s[0] != " " or s[-1] == " "]
        tails = [i for i, s in enumerate(segments) if s[0] == " " and s[-1] != " "]
        first = [i for i in heads if segments[i][0] != " "]
        runs = [tails[a : a + self.join] for a in range(0, len(tails), self.join)]
        groups = [[i, *run] for i, run in zip(first, runs)] + runs[len(first) :] + [[i] for i in first[len(runs) :]]
        groups += [[i] for i in heads if segments[i][0] == " "]
        texts = ["".join([segments[i] for i in group]) for group in groups]
        mine = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        read = self.reader.decode_batch(mine, skip_special_tokens=True)
        members, order = _flat(groups)
        counts, ids = _flat(mine)
        if not len(counts) == len(read) == len(groups) or not counts.all():
            return self._single(segments)
        # where tokens and segments end: the text's number, then bytes from its start
        room = np.int64(1) << 32
        token_ends = _ends(self.widths[ids], counts, room)
        segment_ends = _ends(np.array([len(segments[i].encode()) for i in order.tolist()], np.int64), members, room)
        at = np.minimum(np.searchsorted(token_ends, segment_ends), len(ids) - 1)
        last = np.cumsum(members) - 1
        good = np.logical_and.reduceat(token_ends[at] == segment_ends, last + 1 - members)
        good &= at[last] == np.cumsum(counts) - 1
        good &= np.array([x == y for x, y in zip(read, texts, strict=True)], bool)
        starts = np.concatenate([[0], at[:-1] + 1])
        sizes = at + 1 - starts
        back = np.repeat(good, members)
        if not good.all():
            bad = np.flatnonzero(~back)
            more, extra, back[bad] = self._single([segments[i] for i in order[bad].tolist()])
            starts[bad], sizes[bad] = len(ids) + np.cumsum(more) - more, more
            ids = np.concatenate([ids, extra])
        place = np.argsort(order)
        return sizes[place], ids[_runs(starts[place], sizes[place])], back[place]

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Ids, parity flag and round-trip flag of each text."""
        if not self.by_segments:
            rows = [r for sizes, ids, *f in self._encoded(texts) for r in zip(np.split(ids, np.cumsum(sizes)[:-1]), *f, strict=True)]
            return [r[0] for r in rows], np.array([r[1] for r in rows], bool), np.array([r[2] for r in rows], bool)
        out: list[list[np.ndarray]] = [[] for _ in texts]
        flags = np.ones((2, len(texts)), bool)
        lead = " " if self.model.add_dummy_prefix else ""
        held: list[tuple[int, str]] = []
        size = 0
        for i, text in enumerate(texts):
            if not text:
                out[i].append(np.zeros(0, np.int32))
                continue
            flags[1, i] = SPACE not in text  # it is read as a blank, as the library has it
            for part in _parts((lead + text).replace(SPACE, " "), self.part):
                held.append((i, part))
                size += len(part)
                if size >= self.part:
                    self._encode_parts(held, out, flags)
                    held, size = [], 0
        self._encode_parts(held, out, flags)
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out], flags[0], flags[1]

    def _encode_parts(self, held: list[tuple[int, str]], out: list[list[np.ndarray]], flags: np.ndarray) -> None:
        if not held:
            return
        if len(self.known) > self.memory or len(self.ids) > IDS * self.memory:
            self._trim()
        found = [self.find_ascii(part) if part.isascii() else self.find(part) for _, part in held]
        counts = np.array([len(f) for f in found], np.int64)
        which = np.fromiter(map(self.known.__getitem__, chain.from_iterable(found)), np.int64, counts.sum())
        try:
            for sizes, ids, same, back in self._encoded(self.known.new):
                self.sizes.frombytes(sizes.astype(np.int64).tobytes())
                self.ids.frombytes(ids.astype(np.int32).tobytes())
                self.same.frombytes(same.astype(np.int8).tobytes())
                self.back.frombytes(back.astype(np.int8).tobytes())
        except BaseException:
            self._forget()  # numbers without answers
            raise
        self.known.new = []
        sizes, flat, same, back = (np.frombuffer(x, t) for x, t in ((self.sizes, np.int64), (self.ids, np.int32), (self.same, np.int8), (self.back, np.int8)))
        starts = np.cumsum(sizes) - sizes
        self.uses = np.bincount(which, minlength=len(sizes)) + np.pad(self.uses, (0, len(sizes) - len(self.uses)))
        size = sizes[which]
        ends = np.cumsum(size)
        ids = flat[_runs(starts[which], size)]
        last = np.cumsum(counts) - 1
        cuts = np.concatenate([[0], ends[last]])
        good = [np.logical_and.reduceat(f[which] == 1, np.cumsum(counts) - counts) for f in (same, back)]
        del sizes, flat, same, back  # the arrays can't grow while they are looked at
        for k, (i, _) in enumerate(held):
            out[i].append(ids[cuts[k] : cuts[k + 1]])
            flags[0, i] &= good[0][k]
            flags[1, i] &= good[1][k]

    def decode(self, batch: list) -> list[str]:
        """Texts of the ids, by the rebuilt decoder."""
        out: list[str] = []
        held: list[list[int]] = []
        size = 0
        for ids in batch:
            held.append(np.asarray(ids, np.int64).tolist())
            size += len(held[-1])
            if size >= self.part:
                out += self._decode(held)
                held, size = [], 0
        return out + self._decode(held)

    def _decode(self, batch: list[list[int]]) -> list[str]:
        read = self.reader.decode_batch(batch, skip_special_tokens=True)
        if not self.model.add_dummy_prefix:
            return read
        shown = (next((x for x in ids if x not in self.hidden), None) for ids in batch)
        return [text[1:] if first is not None and self.marked[first] else text for text, first in zip(read, shown, strict=True)]


def codec_of(shared: dict) -> PieceCodec:
    """One codec for all tasks that a Python worker runs in turn: the worker's
    copy of the broadcast keeps it, beside the model file."""
    if "codec" not in shared:
        shared["codec"] = PieceCodec(shared["model"])
    return shared["codec"]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of lists, and what they hold one after another."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return sizes, np.fromiter(chain.from_iterable(lists), np.int32, sizes.sum())


def _ends(widths: np.ndarray, counts: np.ndarray, room: np.int64) -> np.ndarray:
    """Ends of things that lie in texts, ``counts`` of them in each: the text's
    number times ``room`` and the widths up to there, less than ``room``."""
    ends = np.cumsum(widths)
    text_ends = ends[np.cumsum(counts) - 1]
    before = np.concatenate([[0], text_ends[:-1]])
    return np.repeat(np.arange(len(counts)) * room, counts) + np.minimum(ends - np.repeat(before, counts), room - 1)


def _same_runs(sizes: np.ndarray, mine: np.ndarray, counts: np.ndarray, theirs: np.ndarray) -> np.ndarray:
    """Whether two lists of runs have the same run, place by place."""
    same = sizes == counts
    of = lambda n, flat: flat[_runs((np.cumsum(n) - n)[same], n[same])]
    differ = np.concatenate([[0], np.cumsum(of(sizes, mine) != of(counts, theirs))])
    ends = np.cumsum(sizes[same])
    same[same] = differ[ends] == differ[ends - sizes[same]]
    return same


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of runs one after another: ``sizes`` of them from each of ``starts``."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _parts(text: str, most: int) -> Iterator[str]:
    """A long text cut before blanks that follow another character."""
    at = 0
    while len(text) - at > most:
        end = next((m.start() + 1 for m in re.compile(r"[^ ] ").finditer(text, at + most - 1)), len(text))
        yield text[at:end]
        at = end
    if at < len(text):
        yield text[at:]


def encode_pieces(docs: DataFrame, model: bytes | None = None, text: str = "text", decode: bool = True) -> DataFrame:
    """``docs`` with ``token_ids``, ``n_tokens``, ``parity`` and, with
    ``decode``, ``round_trip`` (the decoded ids are the text again)."""
    spark = docs.sparkSession
    small_batches(spark, 400)
    shared = spark.sparkContext.broadcast({"model": model or load_model()})

    @F.pandas_udf("ids array<int>, parity boolean, round_trip boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = codec_of(shared.value)
        for batch in batches:
            known = batch.dropna()
            ids, parity, same = codec.encode(known.tolist())
            yield pd.DataFrame({"ids": pd.Series(ids, known.index, dtype=object), "parity": pd.Series(parity, known.index, dtype=object), "round_trip": pd.Series(same, known.index, dtype=object)}).reindex(batch.index).astype(object).where(lambda x: x.notna(), None)

    got = spare(docs, "_pieces")
    done = docs.withColumn(got, run(F.col(f"`{text}`")))
    extra = {"round_trip": F.col(f"{got}.round_trip")} if decode else {}
    return done.withColumns({"token_ids": F.col(f"{got}.ids"), "n_tokens": F.coalesce(F.size(f"{got}.ids").cast("long"), F.lit(0).cast("long")), "parity": F.col(f"{got}.parity")} | extra).drop(got)


def decode_pieces(rows: DataFrame, model: bytes | None = None, ids: str = "token_ids", out: str = "text") -> DataFrame:
    """``rows`` with the text of the ids (null ids: null)."""
    shared = rows.sparkSession.sparkContext.broadcast({"model": model or load_model()})

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = codec_of(shared.value)
        for batch in batches:
            known = batch.dropna()
            yield pd.Series(codec.decode(known.tolist()), known.index, dtype=object).reindex(batch.index).astype(object).where(lambda x: x.notna(), None)

    return rows.withColumn(out, run(F.col(f"`{ids}`")))


def q_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(table(spark, sf_dir, "documents")).select("doc_id", "n_tokens", "parity", "round_trip", "token_ids")
