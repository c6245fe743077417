"""A dataset manifest as a Merkle tree of SHA-256 states.

Every row is a leaf: the hash of its fields, each written with its length.  The
leaves of a group (a source) in the order of their ids are hashed in runs of
``FAN``, the runs' hashes again, until one is left; the groups' hashes, in the
order of the groups, make the root the same way.

A parent keeps a copied hash state from before each of its children.  To see
what a changed child does to the root, its parent goes on from the state before
it with the new hash and the siblings to the right only; the ones to the left
are in the state.  The same is done level by level up to the root.

Where it runs: leaves are hashed and sorted by range, their places come from
counts of the sorted partitions.  A place's block of ``FAN ** LEVELS`` is a task's
unit: it is one row, of at most that many hashes.  Blocks' hashes are the
leaves of the next step, so a tree of any size takes a few steps; a hot group is
many blocks.  On the way back down a block gets its path (the runs that
its ancestors stand in) and gives each child its own.

Defined results: a null field is written ``-``; rows with equal ids come in the
order of their hashes, rows without an id first; equal rows are leaves of their
own; a null group is the first group; an empty table has no rows; a group or
table of one leaf is that leaf.  Rows without an id are never changed by
``tampered``.  Other columns of the table take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, table

FAN = 3
LEVELS = 6  # levels that one task hashes: blocks of 729


def written(field: str, value: Column | None = None) -> Column:
    """A field as the leaf's hash reads it."""
    text = (F.col(field) if value is None else value).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: list[str], instead: dict[str, Column] | None = None) -> Column:
    return F.sha2(F.concat(*[written(f, (instead or {}).get(f)) for f in fields]), 256)


class Parent:
    """A hash of children, with the states before each of them."""

    def __init__(self, children: list[str]):
        state = hashlib.sha256()
        self.states, self.children = [], [c.encode() for c in children]
        for child in self.children:
            self.states.append(state.copy())
            state.update(child)
        self.hash = state.hexdigest()

    def fold(self, slot: int, child: str) -> str:
        """The hash with another child in a slot."""
        state = self.states[slot].copy()
        state.update(child.encode())
        for right in self.children[slot + 1 :]:
            state.update(right)
        return state.hexdigest()


def grow(hashes: list[str], levels: int | None) -> list[list[Parent]]:
    """The parents of each level, ``levels`` of them, or until one is left."""
    out: list[list[Parent]] = []
    while len(out) < levels if levels is not None else len(hashes) > 1:
        out.append([Parent(hashes[a : a + FAN]) for a in range(0, len(hashes), FAN)])
        hashes = [p.hash for p in out[-1]]
    return out


def top_of(hashes: list[str], tree: list[list[Parent]]) -> str:
    return tree[-1][0].hash if tree else hashes[0]


def numbered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (place in the group from 0) and ``total``.

    The rows are sorted by range over all groups at once, so that a hot group
    spreads, and equal ones too (by a number that means nothing).  A place is
    what the partitions before hold of the group, by their counts, and the
    place within the partition.
    """
    spread = rows.withColumn("_n", F.monotonically_increasing_id())
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    done = cut(spread.repartitionByRange(*keys, "_n").sortWithinPartitions(*keys, "_n").drop("_n"))
    at = done.withColumns({"_at": F.monotonically_increasing_id()}).withColumn("_pid", F.shiftright("_at", 33))
    runs = at.groupBy(*group, "_pid").agg(F.min("_at").alias("_first"), F.count("*").alias("_size"))
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    runs = runs.withColumns({"_before": F.coalesce(F.sum("_size").over(before), F.lit(0)), "total": F.sum("_size").over(whole)})
    same = [F.col(f"_g{i}").eqNullSafe(F.col(c)) for i, c in enumerate(group)]
    runs = runs.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_pid").alias("_p"), "_first", "_before", "total")
    met = at.join(runs, [F.col("_pid") == F.col("_p"), *same])
    return met.select(*rows.columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias("pos"), "total")


def in_blocks(nodes: DataFrame, group: list[str], size: int) -> DataFrame:
    """A row for each block of ``nodes`` (group, pos, total, hash, others):
    group, ``block``, ``total`` and ``nodes``, sorted by place."""
    rest = [c for c in nodes.columns if c not in (*group, "pos", "total")]
    keyed = nodes.withColumn("block", F.expr(f"pos div {size}"))
    return keyed.groupBy(*group, "block", "total").agg(F.array_sort(F.collect_list(F.struct("pos", *rest))).alias("nodes"))


def block_hashes(blocks: DataFrame, levels: int) -> DataFrame:
    """``blocks`` with their ``hash``: after ``levels`` levels, or that of all
    the group where it is one block."""

    @F.pandas_udf("string")
    def run(hashes: pd.Series, one: pd.Series) -> pd.Series:
        return pd.Series([top_of(list(h), grow(list(h), None if alone else levels)) for h, alone in zip(hashes, one, strict=True)])

    return blocks.withColumn("hash", run(F.col("nodes.hash"), F.col("total") <= FAN**levels))


PATH = "array<struct<slot:int,run:array<string>>>"


def climb(nodes: DataFrame, group: list[str], levels: int = LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """All steps' blocks, first the leaves', and (group, hash) of the tops."""
    size, steps = FAN**levels, []
    while True:
        blocks = cut(block_hashes(in_blocks(nodes, group, size), levels))
        steps.append(blocks)
        # total is the same in all rows of a group
        more = blocks.where(F.col("total") > size)
        most = blocks.agg(F.max("total")).first()[0]
        if most is None or most <= size:
            break
        nodes = more.select(*group, F.col("block").alias("pos"), F.expr(f"(total + {size - 1}) div {size}").alias("total"), "hash")
    tops = [b.where(F.col("total") <= size).select(*group, "hash") for b in steps]
    done = tops[0]
    for t in tops[1:]:
        done = done.unionByName(t)
    return steps, done


def child_paths(blocks: DataFrame, levels: int) -> DataFrame:
    """``blocks`` (with the block's own ``path``) with ``paths``: of each node,
    the runs it and its ancestors stand in, up to the top."""

    @F.pandas_udf(f"array<{PATH}>")
    def run(hashes: pd.Series, one: pd.Series, above: pd.Series) -> pd.Series:
        out = []
        for h, alone, path in zip(hashes, one, above, strict=True):
            tree, paths = grow(list(h), None if alone else levels), []
            for at in range(len(h)):
                mine = []
                for level in tree:
                    mine.append({"slot": at % FAN, "run": [c.decode() for c in level[at // FAN].children]})
                    at //= FAN
                paths.append(mine + list(path))
            out.append(paths)
        return pd.Series(out)

    return blocks.withColumn("paths", run(F.col("nodes.hash"), F.col("total") <= FAN**levels, F.col("path")))


def descend(steps: list[DataFrame], group: list[str], tops: DataFrame, levels: int) -> DataFrame:
    """The leaves' blocks with ``path``, the runs above each block up to the
    root, and ``top``, their group's hash.  ``tops``: group columns, ``path``
    and ``top`` of each group."""
    size, down = FAN**levels, None
    for step in reversed(steps):
        last = _met(step.where(F.col("total") <= size), tops, group)
        if down is not None:
            last = last.unionByName(_met(step.where(F.col("total") > size), down, [*group, "block"]))
        if step is steps[0]:
            return last
        done = cut(child_paths(last, levels))
        down = done.select(*group, "top", F.explode(F.arrays_zip("nodes", "paths")).alias("x")).select(*group, F.col("x.nodes.pos").alias("block"), F.col("x.paths").alias("path"), "top")
    raise ValueError("a tree has one step at least")


def _met(blocks: DataFrame, paths: DataFrame, on: list[str]) -> DataFrame:
    there = paths.select(*[F.col(c).alias(f"_{c}") for c in on], "path", "top")
    return blocks.join(there, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on]).select(*blocks.columns, "path", "top")


def fold_leaves(blocks: DataFrame, fields: list[str], levels: int) -> DataFrame:
    """A row for each leaf of the blocks: ``fields`` of the node, subroot,
    proof_sha256 and folded_root of its ``other`` hash."""
    kinds = dict(blocks.select(F.explode("nodes").alias("n")).select("n.*").dtypes)
    schema = ", ".join(f"{f} {kinds[f]}" for f in fields) + ", subroot string, proof_sha256 string, folded_root string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for nodes, total, path, top in zip(batch["nodes"], batch["total"], batch["path"], batch["top"], strict=True):
                hashes = [n["hash"] for n in nodes]
                tree = grow(hashes, None if total <= FAN**levels else levels)
                # the block's ancestors, each with the states before its children
                above = [(int(p["slot"]), Parent(list(p["run"]))) for p in path]
                shared = b"".join(c for slot, parent in above for i, c in enumerate(parent.children) if i != slot)
                rows = []
                for at, node in enumerate(nodes):
                    proof, now, place = hashlib.sha256(), node["other"], at
                    for level in tree:
                        parent, slot, place = level[place // FAN], place % FAN, place // FAN
                        for i, c in enumerate(parent.children):
                            if i != slot:
                                proof.update(c)
                        now = parent.fold(slot, now)
                    proof.update(shared)
                    for slot, parent in above:
                        now = parent.fold(slot, now)
                    rows.append([*[node[f] for f in fields], top, proof.hexdigest(), now])
                frame = pd.DataFrame(rows, columns=[*fields, "subroot", "proof_sha256", "folded_root"])
                # numbers that may be null stay whole numbers
                yield frame.astype({f: "Int64" for f in fields if kinds[f] in ("bigint", "int")})

    return blocks.select("nodes", "total", "path", "top").mapInPandas(run, schema)


def tampered(text: str = "text", key: str = "doc_id") -> Column:
    """The text without its line ends where 2 divides crc32 of the id."""
    hit = F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(2)) == 0
    return F.when(F.coalesce(hit, F.lit(False)), F.replace(F.col(text), F.lit("\n"), F.lit(""))).otherwise(F.col(text))


def manifest(docs: DataFrame, fields: list[str], group: str, key: str, changed: dict[str, Column] | None = None, levels: int = LEVELS) -> DataFrame:
    """key, leaf, subroot, root, proof_sha256, folded_root and verified of every
    row.  ``changed``: the fields of the row that is checked against the
    manifest, where they are not the manifest's own."""
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{group}`").alias("grp"), leaf_hash(fields).alias("hash"), leaf_hash(fields, changed).alias("other"))
    steps, subroots = climb(numbered(cut(rows), ["grp"], ["key", "hash"]), ["grp"], levels)
    # groups are the leaves of the upper tree; its group is the whole table
    groups = cut(subroots).withColumn("all_", F.lit(0))
    upper, root = climb(numbered(cut(groups), ["all_"], ["grp", "hash"]), ["all_"], levels)
    root = cut(root.select("all_", F.col("hash").alias("root")))  # one row
    start = root.select("all_", F.array().cast(PATH).alias("path"), F.col("root").alias("top"))
    over = child_paths(descend(upper, ["all_"], start, levels), levels)
    tops = over.select(F.explode(F.arrays_zip("nodes", "paths")).alias("x")).select(F.col("x.nodes.grp").alias("grp"), F.col("x.paths").alias("path"), F.col("x.nodes.hash").alias("top"))
    folded = fold_leaves(descend(steps, ["grp"], cut(tops), levels), ["key", "hash"], levels)
    done = folded.join(F.broadcast(root.select("root")))  # root is one row
    return done.select(F.col("key").alias(key), F.col("hash").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def q_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"), FIELDS, "source", "doc_id", {"text": tampered()})


def sql_manifest(depth: int = 14) -> str:
    """For DuckDB: one query a level over all nodes, and the proofs and folds by
    string concatenation of whole runs.  ``depth`` levels hold 3^14 rows."""
    crc = """xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, 1 + len(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT),
      lambda c, b: xor(codes[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::BIGINT)"""
    step = "CASE WHEN {0} & 1 = 1 THEN xor(3988292384::BIGINT, {0} >> 1) ELSE {0} >> 1 END"
    bits = "(SELECT list(v ORDER BY i) AS codes FROM z8)"
    zs = ",\n".join(f"z{k} AS (SELECT i, {step.format('v')} AS v FROM z{k - 1})" for k in range(1, 9))
    w = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"

    def tree(name: str, part: str) -> str:
        """Levels of ``name``0 (part, i, h, n): each node's hash on each level."""
        out = []
        for k in range(1, depth + 1):
            out.append(
                f"{name}{k} AS (SELECT {part}, i // 3 AS i, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h, "
                f"any_value((n + 2) // 3) AS n FROM {name}{k - 1} GROUP BY {part}, i // 3)"
            )
        return ",\n".join(out)

    def climb_(name: str, nodes: str, part: str, source: str) -> str:
        """Proof and folded hash of every row of ``source`` through the levels."""
        out, last = [], source
        for k in range(depth):
            now = f"{name}{k}"
            p = 3**k
            run = f"SELECT {part}, i // 3 AS r, n, string_agg(h, '' ORDER BY i) AS hs, list(h ORDER BY i) AS hl FROM {nodes}{k} WHERE n > 1 GROUP BY {part}, i // 3, n"
            out.append(
                f"{now} AS (SELECT s.* REPLACE (CASE WHEN r.hs IS NULL THEN s.proof ELSE s.proof || array_to_string(list_concat(r.hl[:(s.place // {p}) % 3], r.hl[(s.place // {p}) % 3 + 2:]), '') END AS proof, "
                f"CASE WHEN r.hs IS NULL THEN s.fold ELSE sha256(array_to_string(list_concat(list_append(r.hl[:(s.place // {p}) % 3], s.fold), r.hl[(s.place // {p}) % 3 + 2:]), '')) END AS fold) "
                f"FROM {last} s LEFT JOIN ({run}) r ON s.{part} IS NOT DISTINCT FROM r.{part} AND s.place // {3 * p} = r.r)"
            )
            last = now
        return ",\n".join(out)

    return f"""
WITH z0 AS (SELECT range AS i, range::BIGINT AS v FROM range(256)),
{zs},
crc_table AS {bits},
d AS (SELECT doc_id, source, sha256({' || '.join(w(f) for f in FIELDS)}) AS leaf, CASE WHEN {crc} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS t, lang, n_chars FROM documents, crc_table),
e AS (SELECT doc_id, source, leaf, sha256({' || '.join(w(f) for f in FIELDS[:-1])} || {w('t')}) AS other,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS n FROM d),
a0 AS (SELECT source, place AS i, leaf AS h, n FROM e),
{tree("a", "source")},
g AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS place, count(*) OVER () AS n, 0 AS one FROM a{depth}),
b0 AS (SELECT one, place AS i, subroot AS h, n FROM g),
{tree("b", "one")},
u AS (SELECT *, '' AS proof, other AS fold FROM e),
{climb_("c", "a", "source", "u")},
v AS (SELECT c.doc_id, c.leaf, g.subroot, g.place, 0 AS one, c.proof, c.fold FROM c{depth - 1} c JOIN g ON c.source IS NOT DISTINCT FROM g.source),
{climb_("f", "b", "one", "v")}
SELECT doc_id, leaf, subroot, b.h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = b.h AS verified FROM f{depth - 1}, b{depth} b
"""
