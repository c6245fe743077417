"""Benchmark decontamination with an FM-index of every training shard.

The phrases are all windows of ``Windows.words`` words of the benchmark items (an
item of fewer words is a phrase of its own).  A shard is some megabytes of texts
that a task holds.  Its words become symbols: the words that phrases are made of
have one each, every other word and the end of a text is a break.  An FM-index of
the symbols (``fm_index``) is searched backward for all phrases at once; sampled
suffixes give the places of what is found, and the phrases' words merge into
spans to remove.

Texts are read as bytes: words are runs of bytes, hashed by differences of one
prefix sum, looked up among the phrases' words and then compared byte by byte,
so that no hash decides.  A text longer than a shard is indexed in parts that
overlap by all but one word of the longest phrase.

Phrases reach the tasks in blocks of bounded size (``Windows.block`` bytes of
items); a larger benchmark takes a pass over the documents for each block, and
every pass merges into the spans of those before.

Defined results: a null or empty text has no words; a null item has none, and an
item without an id marks words but is not listed; rows of one item_id are one
item; repeated rows each get a row; an empty benchmark finds nothing; other
columns pass through, those named as the results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from .common import table
from .fm_index import FMIndex

# Fixed value: the words, after A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IN_WORD = np.zeros(256, bool)
IN_WORD[48:58] = IN_WORD[97:123] = IN_WORD[128:] = True

SPAN = "array<struct<first_word:bigint,n_words:bigint,from_byte:bigint,to_byte:bigint>>"


@dataclass(frozen=True)
class Windows:
    words: int = 10
    shard: int = 8 << 20  # bytes of texts that are indexed together, about
    part: int = 1 << 21  # words of a longer text that are indexed together
    block: int = 4 << 20  # bytes of benchmark items in one pass
    piece: int = 1 << 21  # bytes hashed together


class WordHash:
    """Hashes of words from one running sum over bytes."""

    def __init__(self, seed: int, piece: int):
        rng = np.random.default_rng(seed)
        self.codes = rng.integers(1, 1 << 63, 256, np.uint64)
        base = int(rng.integers(1 << 32, 1 << 62)) | 1
        self.piece = piece
        self.power = np.multiply.accumulate(np.full(piece, base, np.uint64)) * np.uint64(pow(base, -1, 1 << 64))
        back = pow(base, -1, 1 << 64)
        self.undo = np.multiply.accumulate(np.full(piece, back, np.uint64)) * np.uint64(base)
        self.base, self.back = base, back

    def words(self, raw: np.ndarray, edges: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(begin, end, hash) of the words in lower-cased bytes, piece by piece;
        none reaches over an edge."""
        total = np.uint64(0)
        open_at, open_sum = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            for a in range(0, len(raw), self.piece):
                b = min(len(raw), a + self.piece)
                # one byte more on each side tells what begins and ends here
                inside = np.zeros(b - a + 2, bool)
                inside[1:-1] = IN_WORD[raw[a:b]]
                if a:
                    inside[0] = IN_WORD[raw[a - 1]]
                begins, ends = inside[1:-1] & ~inside[:-2], inside[:-2] & ~inside[1:-1]  # ends: just before
                here = edges[(edges >= a) & (edges < b)] - a
                begins[here] = inside[1:-1][here]
                ends[here] = inside[:-2][here]
                scale = np.uint64(pow(self.base, a, 1 << 64))
                sums = np.empty(b - a + 1, np.uint64)
                sums[0] = total
                np.cumsum(self.codes[raw[a:b]] * self.power[: b - a] * scale, out=sums[1:])
                sums[1:] += total
                total = sums[-1]
                at, to = np.flatnonzero(begins), np.flatnonzero(ends)
                to_sum = sums[to]
                if b == len(raw) and inside[-2]:
                    to, to_sum = np.append(to, b - a), np.append(to_sum, total)
                undo = np.uint64(pow(self.back, a, 1 << 64))
                start = np.concatenate([open_at, at + a])
                start_sum = np.concatenate([open_sum, sums[at]])
                done = len(to)
                first = start[:done]
                # undo the power of the first byte; those begun in an earlier piece have their own
                turn = np.concatenate([np.array([pow(self.back, int(x), 1 << 64) for x in open_at], np.uint64), self.undo[at] * undo])[:done]
                open_at, open_sum = start[done:], start_sum[done:]
                yield first, to + a, (to_sum - start_sum[:done]) * turn


@dataclass
class Phrases:
    """The phrases of one block of items, as plain arrays."""

    seed: int
    hashes: np.ndarray  # of the words, ascending
    text: np.ndarray  # their bytes, one after the other
    edges: np.ndarray  # where each begins
    windows: np.ndarray  # right-aligned symbols (from 1) of the distinct windows
    sizes: np.ndarray
    item_edges: np.ndarray  # of each window in ``items``
    items: np.ndarray  # places in ``ids``
    ids: np.ndarray  # the block's distinct item ids, ascending


def lowered(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def make_phrases(items: list[tuple[int | None, str | None]], how: Windows) -> Phrases:
    find = re.compile(WORD).findall
    made: dict[tuple[bytes, ...], set[int]] = {}
    ids = sorted({i for i, _ in items if i is not None})
    number = {x: n for n, x in enumerate(ids)}
    for item, text in items:
        words = [w.encode("utf-8") for w in find(lowered(text or ""))]
        for a in range(max(1, len(words) - how.words + 1) if words else 0):
            made.setdefault(tuple(words[a : a + how.words]), set()).update([] if item is None else [number[item]])
    vocabulary = sorted({w for window in made for w in window})
    text = np.frombuffer(b"".join(vocabulary), np.uint8)
    edges = np.cumsum([0, *map(len, vocabulary)])
    seed = 12
    while True:  # another seed where two of the words share a hash
        parts = [h for _, _, h in WordHash(seed, how.piece).words(text, edges[:-1])]
        hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        if len(np.unique(hashes)) == len(vocabulary):
            break
        seed += 1
    order = np.argsort(hashes)
    vocabulary = [vocabulary[i] for i in order]
    symbol = {w: i + 1 for i, w in enumerate(vocabulary)}
    windows = np.zeros((len(made), how.words), np.int64)
    for i, window in enumerate(made):
        windows[i, how.words - len(window) :] = [symbol[w] for w in window]
    owners = [sorted(x) for x in made.values()]
    return Phrases(
        seed, hashes[order], np.frombuffer(b"".join(vocabulary), np.uint8), np.cumsum([0, *map(len, vocabulary)]), windows, np.array([len(w) for w in made], np.int64),
        np.cumsum([0, *map(len, owners)]), np.array([x for o in owners for x in o], np.int64), np.array(ids, np.int64),
    )


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - size), size)


class Finder:
    """Finds the phrases in groups of texts inside one task."""

    def __init__(self, phrases: Phrases, how: Windows):
        self.p, self.how = phrases, how
        self.hash = WordHash(phrases.seed, how.piece)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[phrases.hashes >> np.uint64(48)] = True

    def symbols(self, raw: np.ndarray, begin: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """1 + the place of each word among the phrases' words, else 0."""
        out = np.zeros(len(begin), np.int64)
        some = np.flatnonzero(self.maybe[hashes >> np.uint64(48)])
        at = np.searchsorted(self.p.hashes, hashes[some])
        size = np.diff(self.p.edges)
        at[at == len(size)] = 0
        same = (self.p.hashes[at] == hashes[some]) & (size[at] == (end - begin)[some]) if len(size) else np.zeros(0, bool)
        some, at = some[same], at[same]
        if len(some):
            width = size[at]
            equal = raw[ranges(begin[some], width)] == self.p.text[ranges(self.p.edges[at], width)]
            whole = np.logical_and.reduceat(equal, np.cumsum(width) - width)
            out[some[whole]] = at[whole] + 1
        return out

    def find(self, raw: np.ndarray, edges: np.ndarray, known: list[list[tuple[int, int]]] | None = None):
        """For texts of lower-cased bytes, text i from ``edges[i]`` to
        ``edges[i + 1]``: numbers of words, spans (text, first word, words, from
        byte, to byte) and pairs (text, place of the item's id).  ``known``: spans
        (first word, words) found before."""
        count = len(edges) - 1
        begins, ends, symbols = [], [], []
        for begin, end, hashes in self.hash.words(raw, edges[:-1]):
            begins.append(begin)
            ends.append(end)
            symbols.append(self.symbols(raw, begin, end, hashes))
        begin, end, symbol = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (begins, ends, symbols))
        first = np.searchsorted(begin, edges)  # each text's first word
        words = np.diff(first)
        # a break after each text
        text_of = np.repeat(np.arange(count), words)
        line = np.zeros(len(begin) + count, np.int64)
        line[np.arange(len(begin)) + text_of] = symbol
        origin = first[:-1] + np.arange(count)  # of each text in line
        cover = np.zeros(len(line) + 1, np.int32)
        pairs = [np.zeros(0, np.int64)]
        for a in range(0, len(line), self.how.part):
            part = line[a : a + self.how.part + self.how.words - 1]
            index = FMIndex(part, len(self.p.hashes))
            low, high = index.search(self.p.windows, self.p.sizes) if len(self.p.sizes) else (np.zeros(0, np.int64),) * 2
            which = np.repeat(np.arange(len(low)), high - low)
            at = index.locate(ranges(low, high - low)) + a
            np.add.at(cover, at, 1)
            np.add.at(cover, at + self.p.sizes[which], -1)
            # each window once for a text, then its items
            hit = np.unique((np.searchsorted(origin, at, "right") - 1) * np.int64(len(low) + 1) + which)
            text, window = hit // (len(low) + 1), hit % (len(low) + 1)
            width = np.diff(self.p.item_edges)[window]
            items = self.p.items[ranges(self.p.item_edges[window], width)]
            pairs.append(np.unique(np.repeat(text, width) * np.int64(len(self.p.ids) + 1) + items))
        for i, spans in enumerate(known or []):
            for f, n in spans:
                cover[origin[i] + f] += 1
                cover[origin[i] + f + n] -= 1
        hits = np.cumsum(cover[:-1]) > 0
        edge = np.diff(np.concatenate([[0], hits.astype(np.int8), [0]]))
        start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        text = np.searchsorted(origin, start, "right") - 1
        word = start - origin[text]
        global_word = start - text
        spans = (text, word, stop - start, begin[global_word] - edges[text], end[global_word + stop - start - 1] - edges[text]) if len(start) else (np.zeros(0, np.int64),) * 5
        found = np.unique(np.concatenate(pairs))
        return words, spans, (found // (len(self.p.ids) + 1), found % (len(self.p.ids) + 1))


def _lists(owner: np.ndarray, count: int, values: pa.Array, kind: pa.DataType) -> pa.Array:
    """A list for each of ``count`` owners of values in the owners' order."""
    edges = np.searchsorted(owner, np.arange(count + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edges), values).cast(kind)


def _text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes of the texts (null: none) and where each begins."""
    whole = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = whole.buffers()
    edges = np.frombuffer(offsets, np.int64)[whole.offset : whole.offset + len(whole) + 1]
    raw = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]] if edges[-1] > edges[0] else np.zeros(0, np.uint8)
    return LOWER[raw], edges - edges[0]


def _groups(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    a, held = 0, 0
    for i, size in enumerate(sizes):
        if i > a and held + size > most:
            yield a, i
            a, held = i, 0
        held += int(size)
    if len(sizes) > a:
        yield a, len(sizes)


def one_pass(docs: DataFrame, phrases: Phrases, how: Windows, text: str) -> DataFrame:
    """``docs``, which has n_words, spans and items, with these brought up to date."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(phrases))
    results = {"n_words": LongType(), "spans": docs.schema["spans"].dataType, "items": ArrayType(LongType())}
    schema = StructType([StructField(f.name, results.get(f.name, f.dataType)) for f in docs.schema.fields])
    kinds = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(Phrases(**shared.value), how)
        for batch in batches:
            sizes = pc.binary_length(batch[text]).fill_null(0).to_numpy(zero_copy_only=False)
            for a, b in _groups(sizes, how.shard):
                part = batch.slice(a, b - a)
                raw, edges = _text_bytes(part[text])
                before = [[(s["first_word"], s["n_words"]) for s in spans] for spans in part["spans"].to_pylist()]
                words, spans, (owner, item) = finder.find(raw, edges, before)
                struct = pa.StructArray.from_arrays([pa.array(x) for x in spans[1:]], ["first_word", "n_words", "from_byte", "to_byte"])
                new = _lists(owner, b - a, pa.array(finder.p.ids[item]), pa.list_(pa.int64()))
                old = part["items"].to_pylist()
                items = pa.array([sorted({*x, *y}) for x, y in zip(old, new.to_pylist(), strict=True)], pa.list_(pa.int64())) if any(old) else new
                made = {"n_words": pa.array(words), "spans": _lists(spans[0], b - a, struct, kinds.field("spans").type), "items": items}
                arrays = [made.get(f.name, part[f.name] if f.name not in made else None) for f in kinds]
                yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(arrays, kinds, strict=True)], schema=kinds)

    return docs.mapInArrow(run, schema)


def find_contamination(docs: DataFrame, items: DataFrame, how: Windows = Windows(), text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` to remove (words and bytes of the text)
    and ``items``, the ids of the items found."""
    bench = items.select(F.col(f"`{item_key}`").cast("long").alias("id"), F.col(f"`{item_text}`").alias("t")).where("t is not null").distinct()
    total = bench.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-total // how.block))
    # a block's items, of about how.block bytes, come to the driver and go to the tasks
    block_of = F.pmod(F.xxhash64("id", "t"), F.lit(blocks))
    none = {"n_words": F.lit(0).cast("long"), "spans": F.array().cast(SPAN), "items": F.array().cast("array<bigint>")}
    done = docs.withColumns(none)
    for b in range(blocks):
        chosen = bench.where(block_of == b).collect()
        done = one_pass(done, make_phrases([(r["id"], r["t"]) for r in chosen], how), how, text)
    return done


def without_spans(found: DataFrame, text: str = "text") -> DataFrame:
    """``found`` with the spans cut out of the text."""

    @F.pandas_udf("string")
    def run(texts, spans):
        out = []
        for t, s in zip(texts, spans, strict=True):
            if t is None or not len(s):
                out.append(t)
                continue
            raw, at, kept = t.encode("utf-8"), 0, []
            for x in s:
                kept.append(raw[at : x["from_byte"]])
                at = x["to_byte"]
            out.append(b"".join([*kept, raw[at:]]).decode("utf-8"))
        return type(texts)(out, texts.index, dtype=object)

    return found.withColumn(text, run(F.col(f"`{text}`"), F.col("spans")))


def q_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["n_words"])
    names = F.concat_ws(",", F.array_sort(F.transform("items", lambda i: i.cast("string"))))
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(names.cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def sql_contamination(words: int = 10) -> str:
    """For DuckDB: every window of every document joined with the phrases."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    split = rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {split} AS w FROM documents),
i AS (SELECT item_id, {split} AS w FROM benchmark),
f AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - {words}, 0) + 2)) AS p FROM i WHERE len(w) > 0),
g AS (SELECT DISTINCT item_id, array_to_string(w[p:p + {words} - 1], ' ') AS phrase, least({words}, len(w)) AS n FROM f),
s AS (SELECT DISTINCT n FROM g),
x AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, s WHERE len(w) >= n),
y AS (SELECT r, p, n, array_to_string(w[p:p + n - 1], ' ') AS phrase FROM x),
m AS (SELECT y.r, y.p, y.n, g.item_id FROM y JOIN g ON y.n = g.n AND y.phrase = g.phrase),
h AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT r, p, n FROM m)) GROUP BY r),
k AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names FROM m WHERE item_id IS NOT NULL GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN k USING (r)
"""
