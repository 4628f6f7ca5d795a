"""Operator 13: a Merkle manifest of a dataset, its trees stored as aligned blocks in van Emde Boas order.

Rows are hashed to leaves, leaves of one group (say, a language) ascend by id, and every two consecutive nodes become their
hash until one, the group's subroot, remains; the last run of a level may be a single node. Subroots, in order of their groups,
become the root in the same way.

A tree is cut at every ``HEIGHT`` levels into aligned blocks: block b of a layer holds the nodes b * 2**HEIGHT and following,
and its root is a node of the layer above, where the same is done, so a layer is one table of blocks with bounded rows, and
there are log(n) / HEIGHT layers. In a block, nodes lie in van Emde Boas order: the tree is split at half its height into a top
tree and bottom trees, each stored in one piece and split again. ``addresses`` is the arithmetic of that order, which
construction and the look-up of siblings share; nodes met together on a path lie together at every scale, whatever the size of
caches and pages. Blocks at a tree's right edge leave the places of absent nodes empty.

Proofs are read from the stored blocks downwards: a block's rows get the siblings inside the block and those of the block
itself in the layers above. Texts are read once, for their leaf; what moves is an id and two digests a row. Positions come from
a sort by ranges with counts of earlier ranges, so a group that holds most rows is spread like any other, and repeated rows,
whose order doesn't matter, are spread by a number of their own. Blocks hold 2**HEIGHT leaves at most, however large a group is.

Nulls are marked in leaves and sort first, as ids and as groups; an empty text differs from a null. Long texts are hashed in the
JVM, row by row. Rows with one id are put in order of their leaves; repeated rows are leaves of their own. An empty table gives
no rows. Only the named columns are read, so others, of whatever names, don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import documents
from barloom.session import materialized

#: Levels of a block: up to 4 096 leaves, 256 KB of digests.
HEIGHT = 12
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Parts that equal rows are spread over when they are sorted by ranges.
SPREAD = 1024
ALONE, LEFT, RIGHT = 0, 1, 2  # a sibling's side on a proof


def join(*nodes: bytes) -> bytes:
    """Digest over digests, which enter as lowercase hex text."""
    return hashlib.sha256(b"".join([n.hex().encode() for n in nodes])).digest()


@cache
def addresses(height: int) -> tuple[np.ndarray, ...]:
    """Places of the nodes of a complete tree in van Emde Boas order: by depth from the root, then from left to right."""
    if height == 0:
        return (np.zeros(1, np.int64),)
    top = (height - 1) // 2
    bottom = height - top - 1
    upper, lower = addresses(top), addresses(bottom)
    begin = 2 ** (top + 1) - 1 + np.arange(2 ** (top + 1)) * (2 ** (bottom + 1) - 1)
    return (*upper, *[(begin[:, None] + rows[None, :]).ravel() for rows in lower])


def height_of(leaves: int) -> int:
    return (leaves - 1).bit_length()


def built(leaves: Sequence[bytes], height: int) -> bytes:
    """The nodes over these leaves in van Emde Boas order; absent ones are empty."""
    at = addresses(height)
    store = bytearray(DIGEST * (2 ** (height + 1) - 1))
    level = list(leaves)
    for depth in range(height, -1, -1):
        places = at[depth]
        for node, place in zip(level, (places[: len(level)] * DIGEST).tolist(), strict=True):
            store[place : place + DIGEST] = node
        if depth:
            level = [join(*level[k : k + 2]) for k in range(0, len(level), 2)]
    return bytes(store)


def siblings(nodes: bytes, height: int, leaves: int, leaf: int) -> bytes:
    """From a leaf to the block's root: the side and, if there is one, the digest of each sibling."""
    at = addresses(height)
    out = []
    for up in range(height):
        k, present = leaf >> up, ((leaves - 1) >> up) + 1
        if k ^ 1 >= present:
            out.append(bytes([ALONE]))
            continue
        place = int(at[height - up][k ^ 1]) * DIGEST
        out.append(bytes([LEFT if k & 1 else RIGHT]) + nodes[place : place + DIGEST])
    return b"".join(out)


def steps(path: bytes) -> Iterator[tuple[int, bytes]]:
    k = 0
    while k < len(path):
        side = path[k]
        yield side, path[k + 1 : k + 1 + DIGEST] if side else b""
        k += 1 + (DIGEST if side else 0)


def folded(leaf: bytes, path: bytes) -> bytes:
    """The root that follows from a leaf and its proof."""
    for side, other in steps(path):
        leaf = join(leaf) if side == ALONE else join(other, leaf) if side == LEFT else join(leaf, other)
    return leaf


def proof_digest(path: bytes) -> bytes:
    return join(*[other for side, other in steps(path) if side])


def extended(df: DataFrame, ddl: str) -> T.StructType:
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(ddl).fields])


def marked(value: Column) -> Column:
    """A value as it enters a leaf: its length in bytes and itself, or a dash."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(values: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(marked, values)), 256))


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``pos``, the number of a row within its ``tree`` by ``order``. No tree, however large, is sorted in one task."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mixed = rows.withColumn("_mix", F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)))
    ranged = mixed.repartitionByRange(parts, "tree", *order, "_mix").sortWithinPartitions("tree", *order)
    stored = materialized(ranged.drop("_mix").withColumn("_row", F.monotonically_increasing_id()), "leaves")
    part = F.shiftright("_row", 33)
    counts = stored.groupBy("tree", part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_from"))
    earlier = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("tree", "_part", "_from", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    placed = stored.withColumn("_part", part).join(offsets, ["tree", "_part"])
    return placed.withColumn("pos", F.col("_row") - F.col("_from") + F.col("_before")).drop("_row", "_part", "_from", "_before")


def blocks_of(nodes: DataFrame, rest: Sequence[str] = ()) -> DataFrame:
    """One row for each aligned block of ``(tree, pos, node)``: its rows in order, its nodes, and its root.

    What else a row carries stays beside its node.
    """
    row = F.struct(F.expr(f"cast(pos % {2**HEIGHT} as int)").alias("at"), "node", *rest)
    grouped = nodes.groupBy("tree", F.expr(f"shiftright(pos, {HEIGHT})").alias("block")).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    schema = extended(grouped, "height int, nodes binary, root binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(2)
            for k in range(batch.num_rows):  # a block at a time: the nodes of a whole batch are not held
                leaves = rows.slice(k, 1).flatten().field("node").to_pylist()
                # at the edge of a tree of several blocks single nodes are hashed up to the height of the others
                height = HEIGHT if batch.column(1)[k].as_py() else height_of(len(leaves))
                store = built(leaves, height)
                added = [pa.array([height], pa.int32()), pa.array([store], pa.binary()), pa.array([store[:DIGEST]], pa.binary())]
                yield pa.RecordBatch.from_arrays([*batch.slice(k, 1).columns, *added], schema.fieldNames())

    return materialized(grouped.mapInArrow(run, schema), "blocks")


def layers(nodes: DataFrame, rest: Sequence[str] = ()) -> tuple[list[DataFrame], DataFrame]:
    """The stored layers of blocks over ``(tree, pos, node)``, lowest first, and ``(tree, root)``."""
    out = [blocks_of(nodes, rest)]
    while (out[-1].agg(F.max("block")).first()[0] or 0) > 0:
        above = out[-1].select("tree", F.col("block").alias("pos"), F.col("root").alias("node"))
        out.append(blocks_of(above))
    return out, out[-1].select("tree", "root")


def descended(layer: DataFrame, paths: DataFrame) -> DataFrame:
    """Rows of a layer's blocks with their proofs: ``tree``, ``block``, ``rows`` and ``paths``, aligned.

    ``paths`` has, for each (tree, block), the proof of the block's root.
    """
    joined = layer.select("tree", "block", "rows", "height", "nodes").join(paths, ["tree", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {name: k for k, name in enumerate(batch.schema.names)}
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                n = len(one.column(at["rows"]).flatten())
                height, nodes, above = (one.column(at[c])[0].as_py() for c in ("height", "nodes", "path"))
                found = [siblings(nodes, height, n, leaf) + above for leaf in range(n)]
                columns = [one.column(at[c]) for c in shape.fieldNames()[:-1]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([found], pa.list_(pa.binary()))], shape.fieldNames())

    shape = extended(joined.select("tree", "block", "rows", *[c for c in paths.columns if c not in ("tree", "block", "path")]), "paths array<binary>")
    return joined.mapInArrow(run, shape)


def proven(built_layers: Sequence[DataFrame], tops: DataFrame) -> DataFrame:
    """Blocks of the lowest layer with the proofs of their rows; ``tops`` has the proof of each tree's own root."""
    paths = tops.withColumn("block", F.lit(0).cast("bigint"))
    for layer in reversed(built_layers[1:]):
        below = descended(layer, paths)
        kept = [c for c in below.columns if c not in ("rows", "paths", "block")]
        paths = below.select(*kept, "block", F.posexplode("paths").alias("_k", "path")).select(
            *kept, (F.col("block") * 2**HEIGHT + F.col("_k")).alias("block"), "path"
        )
    return descended(built_layers[0], paths)


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id", group: str = "lang", altered: Column | None = None) -> DataFrame:
    """A row for each row: ``key``, ``leaf``, ``subroot``, ``root``, ``proof`` (its siblings), and what follows from the proof.

    ``folded`` is the root that the row's leaf and its proof give, or, where the number ``altered`` isn't null, the row with its
    ``n_chars`` replaced by that number.
    """
    values = [docs[f] for f in fields]
    changed = F.lit(None).cast("binary") if altered is None else F.when(altered.isNotNull(), leaf_of([altered if f == "n_chars" else docs[f] for f in fields]))
    name = F.coalesce(F.concat(F.lit("="), docs[group].cast("string")), F.lit(""))  # null first, then by bytes
    leaves = docs.select(name.alias("tree"), docs[key].alias("id"), leaf_of(values).alias("node"), changed.alias("changed"))
    lower, subroots = layers(numbered(leaves, ["id", "node"]), ["id", "changed"])
    upper, roots = layers(numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("id"), F.col("root").alias("node")), ["id"]), ["id"])
    at_top = proven(upper, roots.select("tree", "root", F.lit(b"").alias("path")))
    tops = at_top.select("root", F.inline(F.arrays_zip("rows", "paths"))).select(
        F.col("rows.id").alias("tree"), F.col("rows.node").alias("subroot"), F.col("root").alias("whole"), F.col("paths").alias("path")
    )
    found = proven(lower, tops).select("subroot", F.col("whole").alias("root"), F.inline(F.arrays_zip("rows", "paths")))
    flat = found.select(F.col("rows.id").alias(key), F.col("rows.node").alias("leaf"), "subroot", "root", F.col("paths").alias("proof"), F.col("rows.changed").alias("changed"))
    shape = extended(flat.drop("changed"), "proof_digest binary, folded binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, changed, paths = (batch.column(k).to_pylist() for k in (1, 5, 4))
            digest = pa.array(map(proof_digest, paths), pa.binary())
            up = pa.array([folded(c or o, p) for o, c, p in zip(own, changed, paths, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], digest, up], shape.fieldNames())

    return flat.mapInArrow(run, shape)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    hit = F.crc32(docs["doc_id"].cast("string")) % 7 == 0
    rows = manifest(docs, altered=F.when(hit, docs["n_chars"] + 1))

    def text(name: str) -> Column:
        return F.lower(F.hex(name))

    return rows.select(
        "doc_id", text("leaf").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"),
        text("proof_digest").alias("proof_sha256"), text("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )


def hashed(n_chars: str = "n_chars") -> str:
    names = [n_chars if f == "n_chars" else f for f in FIELDS]
    parts = [f"CASE WHEN {n} IS NULL THEN '-' ELSE CAST(strlen(CAST({n} AS VARCHAR)) AS VARCHAR) || ':' || CAST({n} AS VARCHAR) END" for n in names]
    return f"sha256({' || '.join(parts)})"


#: Checksum of an id's decimal text, a bit at a time.
CRC = """xor(list_reduce(flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
  lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda s, b: CASE WHEN b >= 0 THEN xor(s, b) ELSE xor(s >> 1, 3988292384 * (s & 1)) END, 4294967295::BIGINT), 4294967295::BIGINT)"""
UP = """list_transform(range((len(nodes) + 1) // 2), lambda k: sha256(nodes[2 * k + 1] || coalesce(nodes[2 * k + 2], '')))"""
ORACLE = f"""WITH RECURSIVE leaves AS (SELECT doc_id, lang, {hashed()} AS leaf,
  CASE WHEN {CRC} % 7 = 0 THEN {hashed("(n_chars + 1)")} END AS changed FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
trees AS (SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY lang
  UNION ALL SELECT lang, level + 1, {UP} FROM trees WHERE len(nodes) > 1),
subroots AS (SELECT lang, max(level) AS top, arg_max(nodes, level)[1] AS subroot FROM trees GROUP BY lang),
langs AS (SELECT *, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS number FROM subroots),
whole AS (SELECT 0 AS level, list(subroot ORDER BY number) AS nodes FROM langs
  UNION ALL SELECT level + 1, {UP} FROM whole WHERE len(nodes) > 1),
siblings AS (SELECT p.doc_id, p.lang, p.pos, t.level, p.pos >> t.level AS place, t.nodes[xor(p.pos >> t.level, 1) + 1] AS other
  FROM placed p JOIN trees t ON p.lang IS NOT DISTINCT FROM t.lang WHERE len(t.nodes) > 1
  UNION ALL SELECT p.doc_id, p.lang, p.pos, l.top + w.level, l.number >> w.level, w.nodes[xor(l.number >> w.level, 1) + 1]
  FROM placed p JOIN langs l ON p.lang IS NOT DISTINCT FROM l.lang CROSS JOIN whole w WHERE len(w.nodes) > 1),
paths AS (SELECT lang, pos, list({{'left': place % 2 = 1, 'other': other}} ORDER BY level) AS path,
  sha256(coalesce(string_agg(other, '' ORDER BY level), '')) AS proof FROM siblings GROUP BY lang, pos),
climbed AS (SELECT p.*, q.path, q.proof, 1 AS k, coalesce(changed, leaf) AS node
  FROM placed p LEFT JOIN paths q ON p.pos = q.pos AND p.lang IS NOT DISTINCT FROM q.lang
  UNION ALL SELECT * REPLACE (k + 1 AS k, sha256(CASE WHEN path[k].left THEN coalesce(path[k].other, '') || node
    ELSE node || coalesce(path[k].other, '') END) AS node) FROM climbed WHERE k <= len(path))
SELECT c.doc_id, c.leaf, l.subroot, (SELECT arg_max(nodes, level)[1] FROM whole) AS root, coalesce(c.proof, sha256('')) AS proof_sha256,
  c.node AS folded_root, c.node = (SELECT arg_max(nodes, level)[1] FROM whole) AS verified
FROM climbed c JOIN langs l ON c.lang IS NOT DISTINCT FROM l.lang WHERE c.k > coalesce(len(c.path), 0)"""
