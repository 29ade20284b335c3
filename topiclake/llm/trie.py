"""Prefix trie of conversations: which opening turns are shared, by how many, and what sharing saves.

Turns are reduced to two 64-bit hashes and a length at the scan; texts are never shuffled.  A prefix is named by
the exclusive or of its turns' hashes, each salted with its place: a running aggregate, so a conversation
of any length is cut into blocks whose last rows carry over.  Then:

1. a count-min sketch counts every prefix, each task its own, merged slice by slice (counters stop at two, as
   only "one" and "more" are asked; 2**25 counters a row at most, so the broadcast is 4 MB a row);
2. an estimate of one proves that one conversation alone has the prefix, as the sketch never counts too little:
   such a tail is emitted where it stands;
3. prefixes that may be shared are shuffled and grouped exactly, whatever the sketch said of them, so a corpus
   too large for the sketch costs a larger shuffle and no row;
4. sums over subtrees take log2(depth) rounds of pointer doubling over the shared prefixes alone.

Edge cases: rows without conversation id are no conversation's and are left out.  Null role or text is empty.  Turns of one
number (repeated rows) are ordered by their hashes and all count; a null number comes first.  An empty table has no
node.  Very long texts are hashed once and very long conversations are numbered in blocks.  Other columns are ignored, whatever their names.
The list of a node's ends is one SHA-256, which can only be fed in order: ids are joined to texts of up to 512 in
parallel, and one task streams a node's texts through the hash, holding one Arrow batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from topiclake.operators.offsets import assign_offsets

from .common import cut, received, send, shared

# Turns of one conversation that a task runs over at most; ids in one text of ends.
BLOCK, RUN = 100_000, 512
# Counters of a row of the sketch (a power of two), rows, and counters a prefix while it can have them.
MOST_COUNTERS, ROWS, ROOM = 1 << 25, 2, 4
_SLICE = 1 << 19
_NOTHING = hashlib.sha256(b"").hexdigest()


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv, pos, a, b, chars) of every turn: its place from 0, the hashes of role and text, the code points of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), text, role).alias("b"), F.length(text).cast("long").alias("chars"),
    ).where("conv IS NOT NULL")
    return assign_offsets(rows, groups=("conv",), order=("turn", "a", "b"), column="pos").drop("turn")


def rebuilt(turns: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Numbered turns of conversations that open as their base (id - id % ``every``) does, and those conversations' lengths.

    Conversation c takes the first h = crc32(c as text) % ``most`` turns of its base, then its own from the h-th on.
    Rows: conv, pos, len, a, b, chars, from_conv, from_pos (where the turn stands); a conversation without turns has one row with a null pos.
    """
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    turns = turns.withColumns({"from_conv": F.col("conv"), "from_pos": F.col("pos")})
    heads = turns.where((F.col("conv") % every == 0) & (F.col("pos") < most - 1)).withColumnRenamed("conv", "base")
    sizes = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("own")).withColumns({"h": h, "base": F.col("conv") - F.col("conv") % every})
    held = heads.groupBy("base").agg(F.count(F.lit(1)).alias("there"))
    sizes = sizes.join(held, "base", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    sizes = sizes.withColumn("len", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).select("conv", "base", "h", "taken", "len")
    sizes = cut(sizes)
    opening = sizes.join(heads, "base").where("pos < h")
    rest = turns.join(sizes, "conv").where("pos >= h").withColumn("pos", F.col("pos") - F.col("h") + F.col("taken"))
    columns = ["conv", "pos", "len", "a", "b", "chars", "from_conv", "from_pos"]
    none = sizes.where("len = 0").select("conv", "len").withColumns({c: F.lit(None).cast("long") for c in columns if c not in ("conv", "len")})
    return opening.select(*columns).unionByName(rest.select(*columns)).unionByName(none.select(*columns))


def prefixes(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Each turn with the name (x, y) of the prefix that it ends, the name (px, py) of the one before, and its depth."""
    words = {"s": F.xxhash64(F.lit(3), "a", "b", "pos"), "t": F.xxhash64(F.lit(4), "b", "a", "pos"), "part": F.floor(F.col("pos") / block).cast("long")}
    rows = turns.where("pos IS NOT NULL").withColumns(words)
    so_far = Window.partitionBy("conv", "part").orderBy("pos")
    rows = rows.withColumns({"x": F.bit_xor("s").over(so_far), "y": F.bit_xor("t").over(so_far)})
    before = Window.partitionBy("conv").orderBy("part")  # a row per full block of a long conversation
    full = rows.where(F.col("pos") % block == block - 1).select("conv", (F.col("part") + 1).alias("part"), F.bit_xor("x").over(before).alias("cx"), F.bit_xor("y").over(before).alias("cy"))
    rows = rows.join(full, ["conv", "part"], "left")
    x, y = (F.col(c).bitwiseXOR(F.coalesce(f"c{c}", F.lit(0))) for c in "xy")
    rows = rows.withColumns({"x": x, "y": y, "depth": F.col("pos") + 1})
    return rows.select("conv", "depth", "len", "x", "y", F.col("x").bitwiseXOR(F.col("s")).alias("px"), F.col("y").bitwiseXOR(F.col("t")).alias("py"), "chars", "from_conv", "from_pos")


def counters(n: int, most: int = MOST_COUNTERS) -> int:
    """Counters of a row of the sketch for ``n`` prefixes."""
    return min(most, max(1 << 10, 1 << (ROOM * max(n, 1) - 1).bit_length()))


def _places(x: np.ndarray, y: np.ndarray, width: int) -> list[np.ndarray]:
    """The counter of each prefix in each row: the words of a name are hashes already."""
    return [w.view(np.uint64) & np.uint64(width - 1) for w in (x, y)[:ROWS]]


def sketch(rows: DataFrame, width: int) -> np.ndarray:
    """Whether each counter of the merged sketch is over one: (ROWS, width / 8) bytes of bits."""
    size = min(_SLICE, width)
    schema = "slice int, once binary, more binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, more = np.zeros((ROWS, width), bool), np.zeros((ROWS, width), bool)
        for b in batches:
            for r, at in enumerate(_places(*(b.column(c).to_numpy() for c in ("x", "y")), width)):
                at, n = np.unique(at, return_counts=True)
                more[r, at] |= once[r, at] | (n > 1)
                once[r, at] = True
        for i, (o, m) in enumerate(zip(once.reshape(-1, size), more.reshape(-1, size))):
            if o.any():
                yield pa.RecordBatch.from_pydict({"slice": pa.array([i], pa.int32()), "once": [np.packbits(o).tobytes()], "more": [np.packbits(m).tobytes()]})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for b in batches:
            for i, o, m in zip(b.column("slice").to_pylist(), b.column("once"), b.column("more")):
                o, m = (np.frombuffer(v.as_buffer(), np.uint8) for v in (o, m))
                was = held.setdefault(i, [np.zeros_like(o), np.zeros_like(m)])
                was[1] = was[1] | m | (was[0] & o)
                was[0] = was[0] | o
        for i, (o, m) in held.items():
            yield pa.RecordBatch.from_pydict({"slice": pa.array([i], pa.int32()), "once": [b""], "more": [m.tobytes()]})

    slices = ROWS * width // size
    parts = rows.select("x", "y").mapInArrow(count, schema).repartition(slices, "slice").mapInArrow(merge, schema)
    out = np.zeros((slices, size // 8), np.uint8)
    for r in parts.select("slice", "more").toLocalIterator():  # ROWS * width bits in all
        out[r["slice"]] = np.frombuffer(r["more"], np.uint8)
    return out.reshape(ROWS, -1)


def screened(rows: DataFrame, most: int = MOST_COUNTERS) -> DataFrame:
    """``rows`` (stored) with ``alone`` and ``parent_alone``: the sketch proves that one conversation has the prefix, and the one before."""
    width = counters(rows.count(), most)
    sent = send(rows.sparkSession, sketch(rows, width))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        more = received(sent)

        def alone(b: pa.RecordBatch, x: str, y: str) -> np.ndarray:
            out = np.zeros(len(b), bool)
            for bits, at in zip(more, _places(b.column(x).to_numpy(), b.column(y).to_numpy(), width)):
                out |= (bits[(at >> np.uint64(3)).astype(np.int64)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 == 0
            return out

        for b in batches:
            top = b.column("depth").to_numpy() == 1  # the root is never taken for a tail
            yield b.append_column("alone", pa.array(alone(b, "x", "y"))).append_column("parent_alone", pa.array(alone(b, "px", "py") & ~top))

    return rows.mapInArrow(probe, rows.withColumns({"alone": F.lit(True), "parent_alone": F.lit(True)}).schema)


def ends(rows: DataFrame) -> DataFrame:
    """(x, y, ends): SHA-256 of the ids in ``rows`` (x, y, conv) of each node, ascending, comma-joined."""
    runs = rows.groupBy("x", "y", F.floor(F.col("conv") / RUN).alias("run")).agg(F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"))
    runs = runs.repartition("x", "y").sortWithinPartitions("x", "y", "run")

    def feed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def out():
            return pa.RecordBatch.from_pydict({"x": pa.array([node[0]], pa.int64()), "y": pa.array([node[1]], pa.int64()), "ends": [state.hexdigest()]})

        for b in batches:
            for x, y, ids in zip(b.column("x").to_pylist(), b.column("y").to_pylist(), b.column("ids").to_pylist()):
                if node != (x, y):
                    if node is not None:
                        yield out()
                    node, state = (x, y), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if node is not None:
            yield out()

    return runs.select("x", "y", "ids").mapInArrow(feed, "x long, y long, ends string")


def below(nodes: DataFrame) -> DataFrame:
    """``nodes`` (x, y, px, py, depth, leaves, saved) with both sums over each node's subtree, by pointer doubling."""
    at = cut(nodes.select("x", "y", F.col("px").alias("ax"), F.col("py").alias("ay"), "depth", "leaves", "saved"))
    deepest, reach = at.agg(F.max("depth")).first()[0] or 0, 1
    while reach <= deepest:  # leaves and saved cover the levels under reach; (ax, ay) is reach levels up
        lower = at.where(F.col("depth") >= reach)
        more = lower.groupBy(F.col("ax").alias("x"), F.col("ay").alias("y")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("v"))
        up = at.select(F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("ax").alias("ux"), F.col("ay").alias("uy"))
        at = at.join(more, ["x", "y"], "left").withColumns({"leaves": F.col("leaves") + F.coalesce("l", F.lit(0)), "saved": F.col("saved") + F.coalesce("v", F.lit(0))})
        at = cut(at.join(up, ["ax", "ay"], "left").select("x", "y", F.col("ux").alias("ax"), F.col("uy").alias("ay"), "depth", "leaves", "saved"))
        reach *= 2
    return at.select("x", "y", "leaves", "saved")


def trie(turns: DataFrame, most: int = MOST_COUNTERS) -> DataFrame:
    """The nodes of the trie of ``turns`` (as ``rebuilt`` gives them).

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and
    from_conv, from_pos: where the node's last turn stands (null for the root).
    """
    spark = turns.sparkSession
    path = shared(spark, "prefixes")
    prefixes(turns).write.parquet(path)
    rows = screened(spark.read.parquet(path), most)
    zero = F.lit(0).cast("long")
    own_end = F.when(F.col("depth") == F.col("len"), F.sha2(F.col("conv").cast("string"), 256)).otherwise(_NOTHING)
    tail = ["conv", "depth", "len", "x", "y", "px", "py", "from_conv", "from_pos"]

    maybe = rows.where("NOT alone")
    exact = cut(maybe.groupBy("x", "y").agg(
        F.count(F.lit(1)).alias("n"), *[F.min(c).alias(c) for c in ("conv", "depth", "px", "py", "chars")], F.max("len").alias("len"),
        F.min_by(F.struct("from_conv", "from_pos"), "conv").alias("stands")).select("*", "stands.*").drop("stands"))
    empty = turns.where("pos IS NULL").select("conv")
    roots = turns.where("pos = 0 OR pos IS NULL").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv")).where("n > 0")
    null = F.lit(None).cast("long")
    roots = roots.select("n", "conv", *[zero.alias(c) for c in ("x", "y", "depth", "chars")], *[null.alias(c) for c in ("px", "py", "from_conv", "from_pos")])
    shared_nodes = cut(exact.where("n > 1").drop("len").unionByName(roots))

    # Tails: those under a prefix that may be shared look for it, the others stand under their own conversation's.  The root, over which
    # very many can stand, is one row and needs no join.
    top = roots.first()
    known = shared_nodes.where("depth > 0").select(F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv").alias("over"))
    alone = rows.where("alone AND NOT parent_alone").select(*tail).unionByName(exact.where("n = 1").select(*tail))
    tops = alone.where("depth > 1").join(known, ["px", "py"], "left")
    tops = tops.unionByName(alone.where("depth = 1").withColumn("over", F.lit(top["conv"] if top else None).cast("long")))
    inner = rows.where("alone AND parent_alone").withColumn("over", F.col("conv")).select(*tail, "over")
    single = tops.select(*tail, F.coalesce("over", "conv").alias("over")).unionByName(inner)
    single = single.select(F.col("conv").alias("conv_id"), "depth", F.col("over").alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
                           (F.col("depth") < F.col("len")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), zero.alias("saved_tokens"),
                           own_end.alias("ends_sha256"), "from_conv", "from_pos")

    hung = tops.where("over IS NOT NULL").groupBy("px", "py").agg(F.count(F.lit(1)).alias("k"))
    hung = hung.unionByName(shared_nodes.where("depth > 0").groupBy("px", "py").agg(F.count(F.lit(1)).alias("s")), allowMissingColumns=True)
    hung = hung.groupBy(F.col("px").alias("x"), F.col("py").alias("y")).agg(F.coalesce(F.sum("k"), zero).alias("tops"), F.coalesce(F.sum("s"), zero).alias("inner"))
    nodes = shared_nodes.join(hung, ["x", "y"], "left").fillna(0, ["tops", "inner"])
    nodes = nodes.withColumns({"n_children": F.col("tops") + F.col("inner"), "saved": (F.col("n") - 1) * F.col("chars")})
    nodes = cut(nodes.withColumn("leaves", F.col("tops") + F.when(F.col("n_children") == 0, 1).otherwise(0)))
    last = maybe.where("depth = len").select("x", "y", "conv").unionByName(empty.select(zero.alias("x"), zero.alias("y"), "conv"))
    last = ends(last.join(nodes.select("x", "y"), ["x", "y"], "left_semi"))
    parents = nodes.select(F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv").alias("parent_conv_id"))
    out = nodes.drop("leaves", "saved").join(below(nodes), ["x", "y"]).join(last, ["x", "y"], "left").join(parents, ["px", "py"], "left")
    out = out.select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", F.col("leaves").alias("n_leaves"),
                     F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(_NOTHING)).alias("ends_sha256"), "from_conv", "from_pos")
    return out.unionByName(single)


def with_turns(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """``nodes`` with the role and text of each node's last turn (null for the root)."""
    at = numbered(conversations).select(F.col("conv").alias("from_conv"), F.col("pos").alias("from_pos"), "a", "b")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    texts = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("from_conv"), F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), text, role).alias("b"), role.alias("role"), text.alias("text"))
    texts = texts.dropDuplicates(["from_conv", "a", "b"])
    return nodes.join(at, ["from_conv", "from_pos"], "left").join(texts, ["from_conv", "a", "b"], "left").drop("a", "b")


def digest(conversations: DataFrame) -> DataFrame:
    return trie(rebuilt(cut(numbered(conversations)))).drop("from_conv", "from_pos")


_CRC = "list_reduce([4294967295] || flatten([[ord(c), -1, -1, -1, -1, -1, -1, -1, -1] for c in string_split(conv_id::VARCHAR, '')]), lambda s, v: CASE WHEN v >= 0 THEN xor(s, v) ELSE xor(s >> 1, 3988292384 * (s & 1)) END)"

#: The same in DuckDB: every prefix as a list of turns, subtrees by comparing prefixes.
ORACLE = f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS p, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS v
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list(v ORDER BY p) AS own FROM t GROUP BY conv_id),
h AS (SELECT *, (4294967295 - {_CRC}) % 6 AS h FROM o),
s AS (SELECT h.conv_id, list_concat(coalesce(b.own[1:h.h], []), h.own[h.h + 1:]) AS s FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % 100),
m AS (SELECT conv_id, len(s) AS n, d, s[1:d] AS path FROM s, unnest(generate_series(0, len(s))) AS g(d)),
n AS (SELECT path, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * CASE WHEN any_value(d) = 0 THEN 0 ELSE any_value(length(path[-1].t)) END AS own_saved,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256 FROM m GROUP BY path),
k AS (SELECT n.*, (SELECT count(*) FROM n c WHERE c.depth = n.depth + 1 AND c.path[1:n.depth] = n.path) AS n_children FROM n)
SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children,
  (SELECT count(*) FROM k u WHERE u.n_children = 0 AND u.path[1:k.depth] = k.path) AS n_leaves,
  (SELECT sum(u.own_saved)::BIGINT FROM k u WHERE u.path[1:k.depth] = k.path) AS saved_tokens, k.ends_sha256
FROM k LEFT JOIN n p ON k.depth > 0 AND p.path = k.path[1:k.depth - 1] AND p.depth = k.depth - 1
"""
