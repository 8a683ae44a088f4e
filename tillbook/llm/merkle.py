"""Merkle manifest of a dataset: a tree of digests per group, and one tree over the groups' roots.

Leaves are numbered without gathering a group: rows are range-partitioned by group and id, a row's number is
its place in its partition plus what earlier partitions hold of its group. An aligned block of 512 consecutive
nodes keeps each level as one string of hex digests. Parents are digests of its substrings of eight digests;
the substrings before and after a node's own digest are the segments of its proof. The roots of blocks are the
nodes of the next round, until a group has one node left. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillbook.llm.common import save

FAN = 8
HEX = 64  # digits of a digest
_LEVELS = 3  # levels of a block
BLOCK = FAN**_LEVELS
_RUN = FAN * HEX
_PATH = "array<struct<left:string,right:string>>"
#: The columns of a leaf in the order in which they are hashed.
LEAF = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_digest(values: list[Column]) -> Column:
    """Digest of values, each as ``-`` if null, else as its number of bytes, a colon and itself."""
    texts = [value.cast("string") for value in values]
    return digest(F.concat(*(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts)))


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``index`` of each row in its ``tree`` and the ``total`` of the tree.

    Rows that are equal in ``order`` are spread too, so none of them makes a large partition.
    """
    spread = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange("tree", *order, "_tie")
    place = F.monotonically_increasing_id()  # number of the partition, then of the row in it
    placed = save(spread.sortWithinPartitions("tree", *order, "_tie").drop("_tie").withColumn("_place", place), "merkle-placed")
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    tree = Window.partitionBy("tree")
    parts = placed.groupBy("tree", "_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    before = F.coalesce(F.sum("_n").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.withColumns({"_before": before, "total": F.sum("_n").over(tree)})
    joined = placed.join(parts, ["tree", "_part"])
    return joined.withColumn("index", F.col("_place") - F.col("_first") + F.col("_before")).drop("_part", "_place", "_n", "_first", "_before")


def _parents(level: str) -> Column:
    """The next level: digests of eight digests each, of fewer at the end."""
    runs = F.sequence(F.lit(0), F.ceil(F.length(level) / F.lit(float(_RUN))).cast("int") - 1)
    return F.array_join(F.transform(runs, lambda k: digest(F.col(level).substr(k * _RUN + 1, F.lit(_RUN)))), "")


def _blocks(nodes: DataFrame) -> DataFrame:
    """tree, block, total, members (index, hash, carried) and the levels of each block as strings, ``top`` its root.

    A block of a larger tree has all its levels, be it of one node; a whole tree only as many as it needs.
    """
    member = F.struct("index", "hash", "carried")
    block = F.floor(F.col("index") / F.lit(BLOCK)).cast("long").alias("block")
    gathered = nodes.groupBy("tree", "total", block).agg(F.sort_array(F.collect_list(member)).alias("members"))
    deep = F.when(F.col("total") > BLOCK, _LEVELS)
    for k in range(_LEVELS):
        deep = deep.when(F.col("total") <= FAN**k, k)
    made = gathered.withColumn("deep", deep.otherwise(_LEVELS))
    made = made.withColumn("level_0", F.array_join(F.transform("members", lambda m: m["hash"]), ""))
    for k in range(_LEVELS):
        made = made.withColumn(f"level_{k + 1}", F.when(F.col("deep") > k, _parents(f"level_{k}")))
    top = F.coalesce(*(f"level_{k}" for k in range(_LEVELS, -1, -1)))
    return save(made.withColumn("top", top).drop(f"level_{_LEVELS}"), "merkle-blocks")


def _above(blocks: DataFrame) -> DataFrame:
    """tree, block, path (segments from the block's root to that of the tree) and summit (the root of the tree)."""
    largest = blocks.agg(F.max("total").alias("most")).first()["most"] or 0
    if largest <= BLOCK:
        return blocks.select("tree", "block", F.array().cast(_PATH).alias("path"), F.col("top").alias("summit"))
    roots = blocks.select(
        "tree", F.col("block").alias("index"), F.ceil(F.col("total") / F.lit(float(BLOCK))).cast("long").alias("total"),
        F.col("top").alias("hash"), F.lit(None).cast("string").alias("carried"),
    )
    inner = _blocks(roots)
    return _members(inner, _above(inner)).select("tree", F.col("index").alias("block"), "path", "summit")


def _members(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """A row per node: tree, index, hash, carried, path and what else ``above`` says of its block."""
    each = blocks.join(above, ["tree", "block"]).select("*", F.posexplode("members").alias("at", "member"))
    segments = []
    for k in range(_LEVELS):
        run = F.floor(F.col("at") / F.lit(FAN ** (k + 1))).cast("int")
        own = (F.floor(F.col("at") / F.lit(FAN**k)) % FAN).cast("int")
        nodes = F.col(f"level_{k}").substr(run * _RUN + 1, F.lit(_RUN))
        segments.append(F.struct(nodes.substr(F.lit(1), own * HEX).alias("left"), nodes.substr(own * HEX + HEX + 1, F.lit(_RUN)).alias("right")))
    path = F.concat(F.slice(F.array(*segments), F.lit(1), F.col("deep")), F.col("path"))
    kept = [name for name in above.columns if name not in ("tree", "block", "path")]
    return each.select("tree", "member.*", path.alias("path"), *kept)


def manifest(
    documents: DataFrame, id_col: str = "doc_id", group_col: str = "lang", columns: tuple[str, ...] = LEAF, carry: Column | None = None
) -> DataFrame:
    """doc_id, leaf, subroot, root, proof (left and right siblings of each level) and carried of every row.

    ``columns`` make the leaf. The leaves of a group are ordered by id, rows without one first, equal ids by
    leaf; a null group is a group of its own and the first. ``carry`` is a text that travels along. Repeated rows
    are leaves of their own. Other columns are left out, whatever their names; an empty table has no rows and no root.
    """
    leaves = documents.select(
        F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("-")).alias("tree"),
        F.col(id_col).alias("id"),
        leaf_digest([F.col(name) for name in columns]).alias("hash"),
        (F.lit(None) if carry is None else carry).cast("string").alias("extra"),
    )
    numbered = _numbered(save(leaves, "merkle-leaves"), ["id", "hash"])
    blocks = _blocks(numbered.select("tree", "index", "total", "hash", F.struct("id", "extra").alias("carried")))
    above = save(_above(blocks), "merkle-above")

    groups = above.filter("block = 0").select(F.lit("").alias("tree"), F.col("tree").alias("group"), F.col("summit").alias("hash"))
    group_nodes = _numbered(groups, ["group"])
    group_blocks = _blocks(group_nodes.select("tree", "index", "total", "hash", F.col("group").alias("carried")))
    over = _members(group_blocks, _above(group_blocks)).select(
        F.col("carried").alias("tree"), F.col("path").alias("group_path"), F.col("summit").alias("root")
    )
    above = above.join(over, "tree").select("tree", "block", F.concat("path", "group_path").alias("path"), F.col("summit").alias("subroot"), "root")
    return _members(blocks, above).select(
        F.col("carried.id").alias(id_col), F.col("hash").alias("leaf"), "subroot", "root", F.col("path").alias("proof"), F.col("carried.extra").alias("carried")
    )


def fold(leaf: Column, proof: Column) -> Column:
    """The root that follows from a leaf and the siblings of its proof; a level of siblings is hashed even if it has none."""
    return F.aggregate(proof, leaf, lambda node, level: digest(F.concat(level["left"], node, level["right"])))


def proof_digest(proof: Column) -> Column:
    return digest(F.array_join(F.transform(proof, lambda level: F.concat(level["left"], level["right"])), ""))


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Rows whose crc32(doc_id) is divisible by 3 are verified after their text was lower-cased (A-Z only).
    """
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    values = [lower if name == "text" else F.col(name) for name in LEAF]
    rows = manifest(documents, carry=F.when(tampered, leaf_digest(values)))
    folded = rows.withColumn("folded_root", fold(F.coalesce("carried", "leaf"), F.col("proof")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


_VALUE = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR) END"
_PLAIN = " || ".join(_VALUE.format(name) for name in LEAF)
_LOWER = " || ".join(_VALUE.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')" if name == "text" else name) for name in LEAF)
_STEP = "list_reduce(list_concat([xor(c, b)], range(8)), lambda a, k: xor(a >> 1, 3988292384 * (a & 1)))"

#: Level by level: nodes of a tree become those of the next level while it has more than one. Trees are the groups,
#: then one over the groups; a leaf climbs the first and then the second.
ORACLE = f"""
WITH RECURSIVE leaves AS (
    SELECT row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, * FROM (
        SELECT doc_id, lang, sha256({_PLAIN}) AS leaf,
            CASE WHEN xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: ascii(d)::BIGINT)),
                lambda c, b: {_STEP}), 4294967295) % 3 = 0 THEN sha256({_LOWER}) END AS other
        FROM documents)
), nodes AS (
    SELECT lang, 0 AS level, i, leaf AS h, count(*) OVER (PARTITION BY lang) AS total FROM leaves
    UNION ALL
    SELECT lang, level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (any_value(total) + 7) // 8
    FROM nodes WHERE total > 1 GROUP BY lang, level, i // 8
), subroots AS (
    SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM nodes WHERE total = 1
), upper_nodes AS (
    SELECT 0 AS level, g AS i, subroot AS h, count(*) OVER () AS total FROM subroots
    UNION ALL
    SELECT level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (any_value(total) + 7) // 8
    FROM upper_nodes WHERE total > 1 GROUP BY level, i // 8
), root AS (
    SELECT h AS root FROM upper_nodes WHERE total = 1
), sides AS (
    SELECT lang, level, i, total, coalesce(string_agg(h, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
        coalesce(string_agg(h, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM nodes WINDOW run AS (PARTITION BY lang, level, i // 8 ORDER BY i)
), upper_sides AS (
    SELECT level, i, total, coalesce(string_agg(h, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
        coalesce(string_agg(h, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM upper_nodes WINDOW run AS (PARTITION BY level, i // 8 ORDER BY i)
), climb AS (
    SELECT doc_id, lang, leaf, 0 AS level, i, total = 1 AS done, coalesce(other, leaf) AS node, '' AS proof
    FROM (SELECT leaves.*, count(*) OVER (PARTITION BY lang) AS total FROM leaves)
    UNION ALL
    SELECT c.doc_id, c.lang, c.leaf, c.level + 1, c.i // 8, s.total <= 8, sha256(s.l || c.node || s.r), c.proof || s.l || s.r
    FROM climb c JOIN sides s ON s.lang IS NOT DISTINCT FROM c.lang AND s.level = c.level AND s.i = c.i WHERE NOT c.done
), upper_climb AS (
    SELECT doc_id, leaf, subroot, 0 AS level, g AS i, (SELECT count(*) FROM subroots) = 1 AS done, node, proof
    FROM climb JOIN subroots ON climb.lang IS NOT DISTINCT FROM subroots.lang WHERE done
    UNION ALL
    SELECT c.doc_id, c.leaf, c.subroot, c.level + 1, c.i // 8, s.total <= 8, sha256(s.l || c.node || s.r), c.proof || s.l || s.r
    FROM upper_climb c JOIN upper_sides s ON s.level = c.level AND s.i = c.i WHERE NOT c.done
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified
FROM upper_climb, root WHERE done
"""
