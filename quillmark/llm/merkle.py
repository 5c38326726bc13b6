"""A Merkle manifest of a table: one leaf digest a row, a tree for each group, a tree over the groups.

The tree is built by pivots. Rows know their position in their group; the children of one
parent are spread into slot columns by conditional aggregates, the concatenated columns are
hashed, and all columns but a node's own are its siblings. One pivot spreads ``SLOTS`` columns,
which are several levels of a narrow tree at once: the levels above the first are hashes of
columns of the same row. So a level costs no shuffle of its own, and a tree over n rows takes
log(n) / log(SLOTS) of them, each a sixteenth of the one before.

On the way down each node gets its path: for each level the digests to the left and to the
right of it. The path of a row is made in the last projection and is never shuffled.

Positions come from range slices of the leaves, never from a window over a whole group: a group
that holds most rows is many slices. Rows with one key are ordered by their digest; rows that are
equal in all fields have equal digests, so which of them comes first changes nothing. A null key
comes first, and rows whose group is null are a group of their own, the first one. An empty table
has no root and gives no rows. Columns that are not named take no part, whatever they are called.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmark.sources.staging import stage

# Slot columns of one pivot.
SLOTS = 16

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf(*fields: Column) -> Column:
    """The digest of a row: each field as its length in bytes, a colon and its value, or ``-`` if null."""
    texts = [field.cast("string") for field in fields]
    return digest(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]))


def group_key(group: Column) -> Column:
    """A key without nulls that sorts as ``group`` does, null first."""
    return F.coalesce(F.concat(F.lit("+"), group.cast("string")), F.lit(""))


def _positions(nodes: DataFrame, order: list[Column]) -> DataFrame:
    """``nodes`` with their position in ``tree``, from 0, and the number ``n`` of nodes of the tree."""
    cut = stage(
        nodes.repartitionByRange(F.col("tree"), *order).withColumn("slice", F.spark_partition_id()), "merkle-slices"
    )
    # A row for each tree of a slice: as many as there are slices, and one more a tree.
    before = W.partitionBy("tree").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    starts = cut.groupBy("tree", "slice").agg(F.count("*").alias("rows")).select(
        "tree", "slice", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"),
        F.sum("rows").over(W.partitionBy("tree")).alias("n"),
    )
    inside = F.row_number().over(W.partitionBy("tree", "slice").orderBy(*order))
    return cut.join(starts, ["tree", "slice"]).withColumn("pos", F.col("start") + inside - 1).drop("slice", "start")


def _levels(fanout: int) -> int:
    """How many levels a pivot holds."""
    if fanout < 2:
        raise ValueError("a parent has two children at least")
    levels = 1
    while fanout ** (levels + 1) <= SLOTS:
        levels += 1
    return levels


# The columns of a pivot are many and alike, so they are written as SQL text.


def _nodes_at(level: int, fanout: int) -> str:
    """How many nodes the tree has ``level`` levels above the slots."""
    return f"ceil(n / {fanout**level})"


def _pivot(nodes: DataFrame, fanout: int) -> DataFrame:
    """Blocks of nodes: payloads, slot columns ``node_0_i``, the digests ``node_j_i`` above them, and ``top``.

    ``nodes`` have tree, n, pos, node and payload. A missing node is null.
    """
    levels = _levels(fanout)
    width = fanout**levels
    spread = [
        F.expr(f"max(CASE WHEN pos % {width} = {k} THEN struct(node, payload) END) AS slot_{k}") for k in range(width)
    ]
    blocks = nodes.groupBy("tree", "n", F.expr(f"pos div {width} AS block")).agg(*spread).selectExpr(
        "tree", "n", "block",
        *[f"slot_{k}.node AS node_0_{k}" for k in range(width)],
        *[f"slot_{k}.payload AS payload_{k}" for k in range(width)],
    )
    for level in range(1, levels + 1):
        above = []
        for i in range(width // fanout**level):
            children = [f"node_{level - 1}_{k}" for k in range(i * fanout, (i + 1) * fanout)]
            # A tree that is down to one node ends there.
            above.append(
                f"CASE WHEN {_nodes_at(level - 1, fanout)} <= 1 THEN {children[0]} WHEN {children[0]} IS NOT NULL "
                f"THEN sha2(concat_ws('', {', '.join(children)}), 256) END AS node_{level}_{i}"
            )
        blocks = blocks.selectExpr("*", *above)
    return blocks.withColumnRenamed(f"node_{levels}_0", "top")


def _steps(slot: int, fanout: int) -> str:
    """What lies beside the way from a slot up to the top of its block: one (left, right) for each level."""
    steps = []
    for level in range(_levels(fanout)):
        own = slot // fanout**level
        first = own - own % fanout
        left = ", ".join(["''", *[f"node_{level}_{k}" for k in range(first, own)]])
        right = ", ".join(["''", *[f"node_{level}_{k}" for k in range(own + 1, first + fanout)]])
        steps.append(
            f"CASE WHEN {_nodes_at(level, fanout)} > 1 THEN "
            f"named_struct('left', concat_ws({left}), 'right', concat_ws({right})) END"
        )
    return f"array_compact(array({', '.join(steps)}))"


def _with_paths(blocks: DataFrame, above: DataFrame, fanout: int) -> DataFrame:
    """The nodes of ``blocks`` with the whole path to the root, below that of their block in ``above``."""
    width = fanout ** _levels(fanout)
    met = blocks.join(above.withColumnsRenamed({"pos": "block", "path": "further"}), ["tree", "block"])
    slots = ", ".join(
        f"named_struct('pos', block * {width} + {k}, 'node', node_0_{k}, 'payload', payload_{k}, "
        f"'path', concat({_steps(k, fanout)}, further))"
        for k in range(width)
    )
    return met.selectExpr("tree", "subroot", "root", f"inline(array({slots}))").where("node IS NOT NULL")


def _forest(nodes: DataFrame, order: list[Column], fanout: int) -> list[DataFrame]:
    """The pivots of all levels, from the leaves up; each block of the last one is a whole tree."""
    current = stage(_positions(nodes, order), "merkle-leaves")
    largest = current.agg(F.max("n")).first()[0] or 0
    width = fanout ** _levels(fanout)
    pivots = []
    while True:
        pivots.append(stage(_pivot(current, fanout), "merkle-level"))
        if largest <= width:
            return pivots
        largest = -(-largest // width)
        current = pivots[-1].select(
            "tree", F.ceil(F.col("n") / width).alias("n"), F.col("block").alias("pos"), F.col("top").alias("node"),
            F.lit(None).cast("string").alias("payload"),
        )


def _descend(pivots: list[DataFrame], above: DataFrame, fanout: int) -> DataFrame:
    """The leaves of the trees with their paths; ``above`` has tree, pos 0, path, subroot and root of each tree."""
    for blocks in reversed(pivots[1:]):
        above = _with_paths(blocks, above, fanout).select("tree", "pos", "path", "subroot", "root")
    return _with_paths(pivots[0], above, fanout)


_PATH = "array<struct<left:string,right:string>>"


def manifest(leaves: DataFrame, order: list[Column], fanout: int = 2) -> DataFrame:
    """The leaves with ``subroot``, ``root`` and ``path``, the digests beside the way from leaf to root.

    ``leaves`` have a column ``group`` (any type), ``leaf`` (a digest), the columns of ``order``
    and any others; all are returned. Equal leaves in one place of the order are interchangeable.
    """
    if "leaf" not in leaves.columns or "group" not in leaves.columns:
        raise ValueError("leaves need the columns group and leaf")
    payload = F.struct(*[F.col(c) for c in leaves.columns]).alias("payload")
    nodes = leaves.select(group_key(F.col("group")).alias("tree"), F.col("leaf").alias("node"), payload,
                          *[column.alias(f"by_{i}") for i, column in enumerate(order)])
    keys = [F.asc_nulls_first(f"by_{i}") for i in range(len(order))] + [F.asc("node")]
    groups = _forest(nodes, keys, fanout)

    tops = groups[-1].select(F.lit("").alias("tree"), F.col("top").alias("node"), F.col("tree").alias("payload"))
    roots = _forest(tops, [F.asc("payload")], fanout)
    root = roots[-1].select("tree", F.lit(0).cast("bigint").alias("pos"), F.array().cast(_PATH).alias("path"),
                            F.col("top").alias("subroot"), F.col("top").alias("root"))
    above = _descend(roots, root, fanout).select(
        F.col("payload").alias("tree"), F.lit(0).cast("bigint").alias("pos"), "path", F.col("node").alias("subroot"), "root"
    )
    return _descend(groups, above, fanout).select("payload.*", "subroot", "root", "path")


def proof_digest(path: Column) -> Column:
    """The digest of all siblings on a path, level by level from the leaf, each level from left to right."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step.left, step.right)), ""))


def fold(leaf_digest: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf_digest, lambda below, step: digest(F.concat(step.left, below, step.right)))


def tampered(doc_id: Column) -> Column:
    """Whether the audit changes the row: 7 divides the unsigned CRC-32 of its id in decimal; not for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 0, F.lit(False))


def audit(docs: DataFrame, fanout: int = 2) -> DataFrame:
    """Each row's proof in the manifest of ``docs``, and what becomes of it when rows are tampered with.

    Returns doc_id, leaf, subroot, root, proof_sha256, folded_root and verified. Tampering adds 1 to
    ``n_chars``; a row without ``n_chars`` stays as it is and verifies. Repeated rows are leaves each.
    """
    fields = [F.col(c) for c in FIELDS]
    changed = [F.col("n_chars") + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    # The texts are read once: from here on a row is its digests.
    leaves = stage(docs.select(
        "doc_id", F.col("lang").alias("group"), leaf(*fields).alias("leaf"),
        F.when(tampered(F.col("doc_id")) & F.col("n_chars").isNotNull(), leaf(*changed)).alias("changed"),
    ), "merkle-digests")
    proofs = manifest(leaves, [F.col("doc_id")], fanout)
    folded = fold(F.coalesce("changed", "leaf"), F.col("path")).alias("folded_root")
    found = proofs.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), folded)
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _sql_leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_sql_field(n_chars if c == "n_chars" else c) for c in FIELDS) + ")"


# CRC-32 by its definition, a bit at a time: the polynomial is a fixed value.
_SQL_CRC32 = (
    "xor(list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), "
    "lambda c: [ascii(c)::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))), "
    "lambda a, b: xor(xor(a, b) >> 1, 3988292384::UBIGINT * (xor(a, b) & 1::UBIGINT))), 4294967295::UBIGINT)"
)


def _sql_tree(name: str, start: str) -> str:
    return (
        f"{name} AS ({start} UNION ALL SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) "
        f"FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 2, n)"
    )


def _sql_climb(name: str, start: str, tree: str) -> str:
    return (
        f"{name} AS ({start} UNION ALL SELECT c.r, c.tree, c.level + 1, c.pos // 2, (c.n + 1) // 2, "
        "sha256(CASE WHEN c.pos % 2 = 0 THEN c.h || coalesce(t.h, '') ELSE t.h || c.h END), c.proof || coalesce(t.h, '') "
        f"FROM {name} c LEFT JOIN {tree} t ON t.tree = c.tree AND t.level = c.level AND t.pos = xor(c.pos, 1) WHERE c.n > 1)"
    )


SQL = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('+' || lang, '') AS tree, {_sql_leaf('n_chars')} AS leaf,
  CASE WHEN coalesce({_SQL_CRC32} % 7 = 0, false) THEN {_sql_leaf('(n_chars + 1)')} ELSE {_sql_leaf('n_chars')} END AS changed
  FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
  count(*) OVER (PARTITION BY tree) AS n FROM d),
{_sql_tree('t', 'SELECT tree, 0 AS level, pos, n, leaf AS h FROM p')},
s AS (SELECT tree AS g, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
{_sql_tree('u', "SELECT '' AS tree, 0 AS level, pos, n, h FROM s")},
{_sql_climb('c', "SELECT r, tree, 0 AS level, pos, n, changed AS h, '' AS proof FROM p", 't')},
{_sql_climb('e', "SELECT c.r, '' AS tree, 0 AS level, s.pos, s.n, c.h, c.proof FROM c JOIN s ON s.g = c.tree WHERE c.n = 1", 'u')}
SELECT p.doc_id, p.leaf, s.h AS subroot, root.h AS root, sha256(e.proof) AS proof_sha256, e.h AS folded_root, e.h = root.h AS verified
FROM p JOIN s ON s.g = p.tree JOIN e ON e.r = p.r AND e.n = 1, (SELECT h FROM u WHERE n = 1) root
"""
