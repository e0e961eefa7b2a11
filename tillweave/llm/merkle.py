"""Merkle manifest of a table: leaf digests, one tree for each group, one tree over the groups, a proof for every row.

A pass takes the nodes of one level, numbered from 0 within their group, in windows of at most ``WINDOW`` neighbours and
hashes as many levels as fit in place: at level h the nodes lie on the rows whose place is a multiple of ``fanout ** h``, so
lag and lead columns of the fixed offsets 1, 2, ... times ``fanout ** h`` hold the siblings. They are masked by the
node's slot in its run and by the run's length, and the row of the first child hashes the parent. What remains of each window
is a node of the next pass, so two passes do for a million rows of a group and three for a thousand million. No window
holds a whole group: places come from a range sort, whose tasks are numbered by a prefix sum over their row counts.

Defined results: a group is hashed in order of its key, null first, then of the leaf; equal rows stay apart, in either order. A null
group is a group of its own and comes first. Null fields are hashed as ``-``, so a null and an empty text differ. A lone leaf is its own
subroot and a lone subroot the root; a row without siblings has the digest of the empty text as its proof. An empty table
gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillweave.llm import frames

FANOUT = 2
WINDOW = 1 << 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """A value as it is hashed: its length in UTF-8 bytes, a colon and its text; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def numbered(nodes: DataFrame, *order: str) -> DataFrame:
    """``nodes`` with (at, n): the place within its grp from 0, and the number of nodes of the grp."""
    spread = nodes.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
    rows = frames.store(spread.withColumn("row", F.monotonically_increasing_id()), "merkle-order")
    rows = rows.withColumn("task", F.shiftright("row", 33))
    runs = rows.groupBy("grp", "task").agg(F.min("row").alias("first"), F.count("*").alias("rows"))
    whole = Window.partitionBy("grp")
    before = F.sum("rows").over(whole.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("grp", "task", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("rows").over(whole).alias("n"))
    return rows.join(runs, ["grp", "task"]).withColumn("at", F.col("row") + F.col("shift")).drop("row", "task", "shift")


def levels_of(fanout: int, most: int = WINDOW) -> int:
    """Levels of which a window of ``WINDOW`` nodes holds whole trees, or fewer if ``most`` nodes need fewer."""
    levels = 0
    while fanout ** (levels + 1) <= WINDOW and fanout**levels < most:
        levels += 1
    return levels


def climb(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``nodes`` (grp, at, n, node, ...) with their path through ``levels`` levels and, on first rows, the node above as ``top``."""
    window = Window.partitionBy("grp", F.expr(f"at div {fanout**levels}")).orderBy("at")
    rows = nodes.withColumn("top", F.col("node"))
    for level in range(levels):
        step = fanout**level
        index = F.expr(f"at div {step}")
        count = F.expr(f"(n + {step - 1}) div {step}")
        slot = index % fanout
        run = F.least(F.lit(fanout), count - (index - slot))
        live = (F.col("at") % step == 0) & (count > 1)
        lefts = [F.when(slot >= k, F.lag("top", k * step).over(window)) for k in range(fanout - 1, 0, -1)]
        rights = [F.when(slot + k < run, F.lead("top", k * step).over(window)) for k in range(1, fanout)]
        joined = lambda found: F.concat(*[F.coalesce(one, F.lit("")) for one in found])
        rows = rows.withColumns({f"left{level}": F.when(live, joined(lefts)), f"right{level}": F.when(live, joined(rights))})
        parent = F.when(count > 1, digest(F.col("top"), F.col(f"right{level}"))).otherwise(F.col("top"))
        rows = rows.withColumn("top", F.when(F.col("at") % (step * fanout) == 0, parent))
    # A node's siblings are known on its first row, which is the last such row at or before any of its rows.
    past = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = [F.struct(*[F.last(f"{side}{level}", ignorenulls=True).over(past).alias(side) for side in ("left", "right")])
             for level in range(levels)]
    path = F.filter(F.array(*steps), lambda s: s["left"].isNotNull()) if steps else F.array().cast(PATH)
    return rows.select(*nodes.columns, "top", path.alias("path"))


def trees(nodes: DataFrame, fanout: int) -> list[DataFrame]:
    """Stored passes over ``nodes`` (grp, at, n, node, ...); the last has one row for each grp, whose ``top`` is its root."""
    passes = []
    most = nodes.agg(F.max("n")).first()[0] or 1
    while True:
        levels = levels_of(fanout, most)
        size = fanout**levels
        passes.append(frames.store(climb(nodes, fanout, levels), "merkle-pass"))
        heads = passes[-1].where(F.col("at") % size == 0)
        nodes = heads.select("grp", F.expr(f"at div {size}").alias("at"), F.expr(f"(n + {size - 1}) div {size}").alias("n"),
                             F.col("top").alias("node"))
        most = -(-most // size)
        if most <= 1:
            return [*passes, nodes.withColumn("path", F.array().cast(PATH))]


def descend(passes: list[DataFrame], above: DataFrame, fanout: int, carried: list[str]) -> DataFrame:
    """Rows of the first pass with whole paths; ``above`` has one row (grp, at = 0, path, carried columns) for each grp."""
    for lower in reversed(passes):
        upper = above.select(F.col("grp"), F.col("at").alias("block"), F.col("path").alias("rest"), *carried)
        size = fanout ** levels_of(fanout)
        lower = lower.withColumn("block", F.expr(f"at div {size}"))
        above = lower.join(upper, ["grp", "block"]).withColumn("path", F.concat("path", "rest")).drop("block", "rest")
    return above


def manifest(rows: DataFrame, group: str, key: str, fields: tuple[str, ...], changed: dict[str, Column] | None = None,
             fanout: int = FANOUT) -> DataFrame:
    """(key, leaf, changed_leaf, subroot, root, path) of every row.

    ``path`` lists, from leaf to root, the siblings to the left and to the right of the row's node. ``changed`` replaces fields in
    ``changed_leaf``, a leaf that takes no part in the trees.
    """
    changed = changed or {}
    leaf = digest(*[field(F.col(name)) for name in fields])
    other = digest(*[field(changed.get(name, F.col(name))) for name in fields]) if changed else leaf
    leaves = rows.select(
        F.col(key).alias("key"), F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("grp"),
        leaf.alias("node"), other.alias("changed_leaf"), F.monotonically_increasing_id().alias("tie"))
    leaves = numbered(frames.store(leaves, "merkle-leaves"), "key", "node", "tie").drop("tie")
    *passes, tops = trees(leaves, fanout)
    tops = frames.store(tops, "merkle-subroots")
    subroots = numbered(tops.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "node"), "name")
    *over, root = trees(subroots, fanout)
    root = root.select("grp", "at", "path", F.col("node").alias("root"))
    upper = descend(over, root, fanout, ["root"]).select(
        F.col("name").alias("grp"), F.lit(0).cast("bigint").alias("at"), F.col("node").alias("subroot"), "root", "path")
    upper = frames.store(upper, "merkle-upper")
    found = descend(passes, upper, fanout, ["subroot", "root"])
    return found.select(F.col("key").alias(key), F.col("node").alias("leaf"), "changed_leaf", "subroot", "root", "path")


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["left"], node, s["right"]))


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    docs = frames.table(spark, sf_dir, "documents").select(*FIELDS)
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    tampered = F.when(frames.remainder("doc_id", 7) == 0, more).otherwise(F.col("n_chars").cast("string"))
    found = manifest(docs, "lang", "doc_id", FIELDS, {"n_chars": tampered})
    folded = fold(F.col("changed_leaf"), F.col("path"))
    return found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


MERKLE_SQL = """
WITH RECURSIVE
raw AS (
  SELECT *, list_reduce([4294967295::BIGINT] || flatten([[ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]
      for c in string_split(coalesce(doc_id::VARCHAR, ''), '') if c <> '']),
    lambda r, b: CASE WHEN b >= 0 THEN xor(r, b) WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::BIGINT) ELSE r >> 1 END) AS reg
  FROM documents),
written AS (
  SELECT doc_id, lang, doc_id IS NOT NULL AND xor(reg, 4294967295::BIGINT) % 7 = 0 AS touched, n_chars,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM raw),
leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen((n_chars + touched::INT)::VARCHAR) || ':' || (n_chars + touched::INT), '-') || tail) AS other
  FROM written),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g
  FROM leaves),
up AS (
  SELECT g, 0 AS h, i, leaf AS d, n FROM placed
  UNION ALL
  SELECT g, h + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), any_value(n + 1) // 2 FROM up WHERE n > 1 GROUP BY g, h, i // 2),
sub AS (SELECT g, d, count(*) OVER () AS n FROM up WHERE n = 1),
over AS (
  SELECT 0 AS h, g AS i, d, n FROM sub
  UNION ALL
  SELECT h + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), any_value(n + 1) // 2 FROM over WHERE n > 1 GROUP BY h, i // 2),
steps AS (
  SELECT p.g, p.i, s.h, x.d, (p.i >> s.h) & 1 AS slot
  FROM placed p JOIN (SELECT DISTINCT g, h FROM up WHERE n > 1) s ON p.g = s.g
  LEFT JOIN up x ON x.g = s.g AND x.h = s.h AND x.i = xor(p.i >> s.h, 1)
  UNION ALL
  SELECT p.g, p.i, 1000 + s.h, x.d, (p.g >> s.h) & 1
  FROM placed p CROSS JOIN (SELECT DISTINCT h FROM over WHERE n > 1) s
  LEFT JOIN over x ON x.h = s.h AND x.i = xor(p.g >> s.h, 1)),
paths AS (
  SELECT g, i, string_agg(coalesce(d, ''), '' ORDER BY h) AS proof,
    list(CASE WHEN d IS NULL THEN '-' WHEN slot = 1 THEN 'L' || d ELSE 'R' || d END ORDER BY h) AS path
  FROM steps GROUP BY g, i),
folded AS (
  SELECT p.doc_id, p.leaf, sub.d AS subroot, (SELECT d FROM over WHERE n = 1) AS root, sha256(coalesce(q.proof, '')) AS proof_sha256,
    list_reduce([p.other] || coalesce(q.path, []), lambda a, s:
      sha256(CASE s[1] WHEN 'L' THEN s[2:] || a WHEN 'R' THEN a || s[2:] ELSE a END)) AS folded_root
  FROM placed p JOIN sub ON sub.g = p.g LEFT JOIN paths q ON q.g = p.g AND q.i = p.i)
SELECT *, folded_root = root AS verified FROM folded
"""
