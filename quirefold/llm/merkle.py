"""A Merkle manifest of a dataset, and a check of single documents against its root by a recursive query.

Every document is a leaf, every run of three neighbours becomes a node, first within each source and then over the
sources' roots. Nodes are stored as rows of their block, a subtree of up to four levels: the digests of each level, and a
link to the block that its own digest lies in. A recursive query climbs from every leaf at once along these links; each
step folds the leaf's digest, true or tampered with, through the runs of a block into its digest. The siblings met in the
first block are a leaf's own; those further up are the same for all leaves of that block and are put together once for them.
"""

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirefold.sources.shared import shared_path

ARITY = 3
#: Levels of a block, and nodes at its foot.
LEVELS = 4
SPAN = ARITY ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows of one range when leaves are ordered.
RANGE_ROWS = 1_000_000
#: Runs near the root, of some 130 bytes, that every task may hold (7 MB) in their blocks; those below are met by shuffling.
HELD_RUNS = 50_000
#: Levels of the tree over sources are stored from this one on; a source's own tree has fewer.
TOP = 40
_PLACE = (1 << 33) - 1


def field(name: str, value: Column | None = None) -> Column:
    """A column as it goes into a leaf: ``-`` if null, else its number of UTF-8 bytes, a colon and the value."""
    text = (F.col(f"`{name}`") if value is None else value).cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(text: Column | None = None) -> Column:
    """Digest of a document, as bytes; with ``text`` in place of its own."""
    return F.unhex(F.sha2(F.concat(*[field(c, text if c == "text" else None) for c in FIELDS]), 256))


def tampered() -> Column:
    """The text as the check finds it: without line feeds where 2 divides the CRC of the id; a null id is left alone."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(even, leaf(F.replace(F.col("text"), F.lit("\n"), F.lit("")))).otherwise(leaf())


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _stored(rows: DataFrame, name: str) -> DataFrame:
    path = shared_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Stored rows with ``rank``, from 0 in the given order: places within sorted ranges, after the sizes of the ranges before."""
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // RANGE_ROWS))
    placed = _stored(rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("range"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE)).alias("place")), "merkle-ranges")
    sizes = placed.groupBy("range").count().select(  # one row per range
        "range", F.expr("coalesce(sum(count) OVER (ORDER BY range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("before"))
    return placed.join(F.broadcast(sizes), "range").withColumn("rank", F.col("before") + F.col("place")).drop("range", "place", "before")


@dataclass
class Manifest:
    """``leaves``: rank, doc_id, source_no, leaf, claimed, up, slot. ``runs``: id, up, slot, levels, n, digest, level.

    ``runs`` holds blocks: the digests of their levels and the number of runs. ``up`` is the id of the block that a node lies at
    the foot of and ``slot`` its place there; the root has neither.
    ``subroots``: source_no, subroot. ``root`` is null without documents.
    """

    leaves: DataFrame
    runs: DataFrame
    subroots: DataFrame
    root: str | None


def _links(depth: int, position: str, n_sources: int) -> tuple[Column, Column]:
    """Where a node of a source's tree hangs: id of its block and the slot there. A source's root hangs in the tree above.

    A block's id is made of the rank of its first leaf and its depth in blocks; blocks over sources have negative ids.
    """
    own = (F.col("first_rank") + F.expr(f"{position} div {SPAN}") * F.lit(SPAN ** (depth + 1))) * 64 + (depth + 1)
    inside = F.col("height") > LEVELS * depth
    above = F.lit(None).cast("long") if n_sources < 2 else -(F.expr(f"source_no div {SPAN}") * 64 + 1)
    over = F.lit(None).cast("int") if n_sources < 2 else (F.col("source_no") % SPAN).cast("int")
    return (F.when(inside, own).otherwise(above).alias("up"),
            F.when(inside, (F.expr(position) % SPAN).cast("int")).otherwise(over).alias("slot"))


def _folded(nodes: str) -> str:
    """Digests of all runs of an array of nodes."""
    return (f"transform(sequence(0, CAST((size({nodes}) - 1) div {ARITY} AS INT)), i -> "
            f"unhex(sha2(array_join(transform(slice({nodes}, {ARITY} * i + 1, {ARITY}), x -> lower(hex(x))), ''), 256)))")


def _blocks(nodes: DataFrame, keys: list[str], levels: str) -> DataFrame:
    """Nodes (keys, position, digest) as blocks of so many levels: keys, position, levels, n, digest."""
    foot = nodes.withColumn("place", F.col("position") % SPAN).withColumn("position", F.expr(f"position div {SPAN}"))
    grouped = foot.groupBy(*keys, "position").agg(F.array_sort(F.collect_list(F.struct("place", "digest"))).alias("foot"))
    numbers = ", ".join(str(i) for i in range(1, LEVELS))
    return (grouped.withColumn("foot", F.col("foot.digest"))
            .withColumn("levels", F.expr(f"aggregate(slice(array({numbers}), 1, CAST({levels} AS INT) - 1), array(foot), "
                                         f"(met, k) -> concat(met, array({_folded('element_at(met, -1)')})))"))
            .withColumn("n", F.expr(f"aggregate(levels, 0L, (sum, l) -> sum + (size(l) + {ARITY - 1}) div {ARITY})"))
            .withColumn("digest", F.expr(f"element_at({_folded('element_at(levels, -1)')}, 1)")).drop("foot"))


def build(docs: DataFrame) -> Manifest:
    """Order the leaves, store the levels one by one, and give the manifest.

    Null sources make a source of their own, which comes first. Within a source null ids come first, and rows of one id
    are ordered by their digests, so the root depends on the rows alone. Other columns are not read.
    """
    spark = docs.sparkSession
    hashed = _stored(docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), leaf().alias("digest"),
                                 tampered().alias("claimed")), "merkle-leaves")
    ranked = _stored(numbered(hashed, ["source", "doc_id", "digest", "claimed"]), "merkle-ranks")
    sources = ranked.groupBy("source").agg(F.min("rank").alias("first_rank"), F.count("*").alias("n"))
    height = sum((F.col("n") > ARITY ** k).cast("int") for k in range(TOP))
    sources = _stored(numbered(sources, ["first_rank"]).withColumnRenamed("rank", "source_no").withColumn("height", height), "merkle-sources")
    n_sources, tallest = sources.agg(F.count("*"), F.max("height")).first()
    plain = ranked.join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    leaves = _stored(plain.withColumn("position", F.col("rank") - F.col("first_rank")).select(
        "rank", "doc_id", "source_no", "first_rank", "height", "position", "digest", "claimed", *_links(0, "position", n_sources)), "merkle-placed")

    path, keys = shared_path(spark, "merkle-runs"), ["first_rank", "height", "source_no"]
    schema = ("id long, first_rank long, height int, source_no long, position long, levels array<array<binary>>, n long, digest binary, "
              "up long, slot int")
    nodes, depth = leaves.select(*keys, "position", "digest"), -(-(tallest or 0) // LEVELS)
    for h in range(1, depth + 1):
        grouped = _blocks(nodes.where(F.col("height") > LEVELS * (h - 1)), keys, f"least({LEVELS}, height - {LEVELS * (h - 1)})")
        number = (F.col("first_rank") + F.col("position") * F.lit(SPAN ** h)) * 64 + h
        grouped.select(number.alias("id"), *keys, "position", "levels", "n", "digest", *_links(h, "position", n_sources)).write.parquet(f"{path}/level={h}")
        nodes = spark.read.schema(schema).parquet(f"{path}/level={h}").select(*keys, "position", "digest")
    stored = spark.read.schema(schema + ", level int").parquet(path) if depth else spark.createDataFrame([], schema + ", level int")
    subroots = leaves.where("height = 0").select("source_no", "digest").unionByName(
        stored.where(f"level = (height + {LEVELS - 1}) div {LEVELS}").select("source_no", "digest"))
    subroots = _stored(subroots, "merkle-subroots")

    nodes, left, k = subroots.select(F.col("source_no").alias("position"), "digest"), n_sources, 0
    while left > 1:
        levels = next(i for i in range(1, LEVELS + 1) if i == LEVELS or ARITY ** i >= left)
        k, left = k + 1, -(-left // SPAN)
        none = [F.lit(None).cast(t).alias(c) for c, t in (("first_rank", "long"), ("height", "int"), ("source_no", "long"))]
        up = F.lit(None).cast("long") if left == 1 else -(F.expr(f"position div {SPAN}") * 64 + (k + 1))
        slot = F.lit(None).cast("int") if left == 1 else (F.col("position") % SPAN).cast("int")
        _blocks(nodes, [], str(levels)).select((-(F.col("position") * 64 + k)).alias("id"), *none, "position", "levels", "n", "digest",
                                               up.alias("up"), slot.alias("slot")).write.parquet(f"{path}/level={TOP + k}")
        nodes = spark.read.schema(schema).parquet(f"{path}/level={TOP + k}").select("position", "digest")
    runs = spark.read.schema(schema + ", level int").parquet(path) if tallest or k else stored
    top = nodes.first() if n_sources else None  # one row is left
    return Manifest(leaves.withColumnRenamed("digest", "leaf"), runs, subroots.withColumnRenamed("digest", "subroot"),
                    None if top is None else bytes(top["digest"]).hex())


_POWERS = "array(" + ", ".join(str(ARITY ** i) for i in range(LEVELS + 1)) + ")"


def _runs(levels: str, slot: str) -> str:
    """For each level of a block the run above a slot at its foot (``run``) and the place in it (``at``)."""
    return (f"transform({levels}, (l, i) -> struct(slice(l, CAST({ARITY} * ({slot} div {_POWERS}[i + 1]) + 1 AS INT), {ARITY}) AS run, "
            f"({slot} div {_POWERS}[i]) % {ARITY} AS at))")


def _siblings(levels: str, slot: str) -> str:
    """Text of the siblings that are met in a block on the way up from a slot."""
    return (f"array_join(flatten(transform({_runs(levels, slot)}, "
            "m -> transform(filter(m.run, (x, j) -> j <> m.at), x -> lower(hex(x))))), '')")


# ``own`` is the block that the leaf lies in; of each block's leaves one at least is ``lead`` and keeps its steps. Rows that
# ``starts`` has from an earlier climb are not given out again.
_CLIMB = f"""
WITH RECURSIVE climb(rank, own, lead, up, slot, folded, step) AS (
  SELECT rank, own, lead, up, slot, folded, step FROM {{starts}}
  UNION ALL
  SELECT {{hint}} c.rank, c.own, c.lead, r.up, r.slot,
         aggregate({_runs('r.levels', 'c.slot')}, c.folded, (met, m) ->
                   unhex(sha2(array_join(transform(m.run, (x, j) -> lower(hex(if(j = m.at, met, x)))), ''), 256))),
         c.step + 1
  FROM climb c JOIN {{runs}} r ON c.up = r.id)
SELECT * FROM climb WHERE lead OR up IS NULL OR {{open}}"""
_ROWS = "spark.sql.cteRecursionRowLimit"


def climb(starts: DataFrame, runs: DataFrame, held: bool, goes_on: str = "false") -> DataFrame:
    """A recursive climb from ``starts`` (rank, own, lead, up, slot, folded, step), stored.

    Given are the steps of leading leaves, of every leaf the last one, which has no ``up``, and what goes on above ``runs``.
    """
    spark = starts.sparkSession
    frames = {"starts": starts, "runs": runs.select("id", "up", "slot", "levels")}
    names = {n: f"merkle_{n}_{uuid.uuid4().hex}" for n in frames}
    for n, frame in frames.items():
        frame.createOrReplaceTempView(names[n])
    limit = spark.conf.get(_ROWS, None)
    spark.conf.set(_ROWS, "-1")  # every leaf climbs
    try:
        return _stored(spark.sql(_CLIMB.format(hint="/*+ BROADCAST(r) */" if held else "", open=goes_on, **names)), "merkle-climb")
    finally:
        spark.conf.unset(_ROWS) if limit is None else spark.conf.set(_ROWS, limit)
        for name in names.values():
            spark.catalog.dropTempView(name)


def proofs(manifest: Manifest) -> DataFrame:
    """``rank, proof_sha256, folded_root`` of every leaf.

    Blocks near the root are counted and held by every task, as all leaves meet there; the others, of which each has few
    leaves below it, are met by shuffling.
    """
    sizes = sorted((r["level"], r["n"]) for r in manifest.runs.groupBy("level").agg(F.sum("n").alias("n")).collect())  # one row per level
    low, rest = [], sum(n for _, n in sizes)
    for level, n in sizes:
        if rest <= HELD_RUNS:
            break
        low.append(level)
        rest -= n
    begin = manifest.leaves.select("rank", F.col("up").alias("own"), F.expr(f"height = 0 OR position % {SPAN} = 0").alias("lead"), "up", "slot",
                                   F.col("claimed").alias("folded"), F.lit(0).alias("step"))
    high, steps = manifest.runs, begin.limit(0)
    if low:
        # The rows whose block is not among those below go on from there.
        own, over = [x for x in low if x < TOP], [x - TOP for x in low if x > TOP]
        within = " OR ".join([f"(up > 0 AND up & 63 IN ({', '.join(map(str, own))}))"] * bool(own)
                             + [f"(up < 0 AND -up & 63 IN ({', '.join(map(str, over))}))"] * bool(over))
        goes_on = f"(up IS NOT NULL AND NOT ({within}))"
        steps = climb(begin, manifest.runs.where(F.col("level").isin(low)), False, goes_on)
        begin, steps = steps.where(goes_on), steps.where(f"NOT {goes_on}")
        high = manifest.runs.where(~F.col("level").isin(low))
    steps = steps.unionByName(climb(begin, high, True))
    ladder = steps.where("lead AND step > 0 AND up IS NOT NULL").select("own", "step", "up", "slot").distinct()
    above = (ladder.join(manifest.runs.select(F.col("id").alias("up"), "levels"), "up")
             .select("own", "step", F.expr(_siblings("levels", "slot")).alias("met")).groupBy("own")
             .agg(F.array_join(F.array_sort(F.collect_list(F.struct("step", "met")))["met"], "").alias("above")))
    feet = manifest.runs.where(F.col("level").isin(1, TOP + 1)).select(F.col("id").alias("own"), "levels").join(above, "own", "left")
    met = F.concat(F.coalesce(F.expr(_siblings("levels", "slot")), F.lit("")), F.coalesce("above", F.lit("")))
    proof = (manifest.leaves.select("rank", F.col("up").alias("own"), "slot").join(feet, "own", "left")
             .select("rank", F.unhex(F.sha2(met, 256)).alias("proof")))
    return (proof.join(steps.where("up IS NULL").select("rank", "folded"), "rank")
            .select("rank", _hex(F.col("proof")).alias("proof_sha256"), _hex(F.col("folded")).alias("folded_root")))


def report(docs: DataFrame) -> DataFrame:
    """The contract's row per document; an empty table gives no rows. Repeated rows are leaves of their own."""
    manifest = build(docs)
    leaves = manifest.leaves.select("rank", "doc_id", "source_no", _hex(F.col("leaf")).alias("leaf"))
    return (leaves.join(manifest.subroots.select("source_no", _hex(F.col("subroot")).alias("subroot")), "source_no")
            .join(proofs(manifest), "rank").withColumn("root", F.lit(manifest.root).cast("string"))
            .select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")))


_SQL_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || {0}, '-')"
_SQL_LEAF = "sha256(" + " || ".join(_SQL_FIELD.format(c) for c in FIELDS[:-1]) + " || " + _SQL_FIELD.format("{text}") + ")"

SQL = f"""
WITH RECURSIVE
crc(doc_id, rest, c) AS (
  SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR), CAST(4294967295 AS BIGINT) FROM documents
  UNION ALL
  SELECT doc_id, substr(rest, 2), list_reduce(list_concat([xor(c, CAST(ascii(rest) AS BIGINT))], [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END) FROM crc WHERE rest <> ''),
even AS (SELECT doc_id AS even_id FROM crc WHERE rest = '' AND xor(c, 4294967295) % 2 = 0),
hashed AS (
  SELECT doc_id, source, {_SQL_LEAF.format(text='text')} AS leaf,
    CASE WHEN even_id IS NULL THEN {_SQL_LEAF.format(text='text')}
         ELSE {_SQL_LEAF.format(text="replace(text, chr(10), '')")} END AS claimed
  FROM documents LEFT JOIN even ON doc_id = even_id),
leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS src, count(*) OVER (PARTITION BY source) AS n,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS pos FROM hashed),
levels(src, h, pos, d, n) AS (
  SELECT src, 0, pos, leaf, n FROM leaves
  UNION ALL
  SELECT src, h + 1, pos // 3, sha256(string_agg(d, '' ORDER BY pos)), (n + 2) // 3 FROM levels WHERE n > 1 GROUP BY src, h, pos // 3, n),
subroots AS (SELECT src, d, count(*) OVER () AS n FROM levels WHERE n = 1),
tops(h, pos, d, n) AS (
  SELECT 0, src, d, n FROM subroots
  UNION ALL
  SELECT h + 1, pos // 3, sha256(string_agg(d, '' ORDER BY pos)), (n + 2) // 3 FROM tops WHERE n > 1 GROUP BY h, pos // 3, n),
climb(leaf, src, first, h, pos, n, folded, siblings) AS (
  SELECT leaf, src, pos, 0, pos, n, claimed, '' FROM leaves
  UNION ALL
  SELECT c.leaf, c.src, first, c.h + 1, c.pos // 3, (c.n + 2) // 3,
    sha256(string_agg(CASE WHEN l.pos = c.pos THEN c.folded ELSE l.d END, '' ORDER BY l.pos)),
    c.siblings || coalesce(string_agg(l.d, '' ORDER BY l.pos) FILTER (WHERE l.pos <> c.pos), '')
  FROM climb c JOIN levels l ON l.src = c.src AND l.h = c.h AND l.pos // 3 = c.pos // 3 WHERE c.n > 1
  GROUP BY c.leaf, c.src, first, c.h, c.pos, c.n, c.siblings),
top_climb(src, first, h, pos, n, folded, siblings) AS (
  SELECT c.src, first, 0, c.src, s.n, folded, siblings FROM climb c JOIN subroots s ON s.src = c.src WHERE c.n = 1
  UNION ALL
  SELECT c.src, first, c.h + 1, c.pos // 3, (c.n + 2) // 3,
    sha256(string_agg(CASE WHEN l.pos = c.pos THEN c.folded ELSE l.d END, '' ORDER BY l.pos)),
    c.siblings || coalesce(string_agg(l.d, '' ORDER BY l.pos) FILTER (WHERE l.pos <> c.pos), '')
  FROM top_climb c JOIN tops l ON l.h = c.h AND l.pos // 3 = c.pos // 3 WHERE c.n > 1
  GROUP BY c.src, first, c.h, c.pos, c.n, c.siblings)
SELECT l.doc_id, l.leaf, s.d AS subroot, t.d AS root, sha256(c.siblings) AS proof_sha256, c.folded AS folded_root, c.folded = t.d AS verified
FROM leaves l JOIN subroots s ON s.src = l.src JOIN top_climb c ON c.src = l.src AND c.first = l.pos AND c.n = 1 JOIN tops t ON t.n = 1"""
