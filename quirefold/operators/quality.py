"""Table constraints as queries that return violations (rule, key, n)."""

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirefold import fixed_values as fv
from quirefold import schemas


def row_rules(required=(), allowed: dict | None = None, dims: dict | None = None) -> list[tuple[str, Column]]:
    """(rule, condition under which a row breaks it) of the constraints that a row alone can break.

    Not null, in a set (null is another rule's matter), and vectors of one length (an absent vector is allowed).
    """
    rules = [("not_null:" + c, F.col(c).isNull()) for c in required]
    rules += [("in_set:" + c, F.coalesce(~F.col(c).isin(*values), F.lit(False))) for c, values in (allowed or {}).items()]
    return rules + [("dims:" + c, F.coalesce(F.size(c) != n, F.lit(False)) & F.col(c).isNotNull()) for c, n in (dims or {}).items()]


def first_broken(rules) -> Column:
    """The first rule that a row breaks, null if it keeps all."""
    return F.coalesce(*[F.when(broken, F.lit(rule)) for rule, broken in rules]) if rules else F.lit(None).cast("string")


def row_violations(df: DataFrame, rules, key: str) -> DataFrame:
    """One row per broken rule and row of the table, all rules in one pass."""
    broken = F.filter(F.array(*[F.when(hit, F.lit(rule)) for rule, hit in rules]), lambda r: r.isNotNull())
    return (df.where(functools.reduce(lambda a, b: a | b, [hit for _, hit in rules]))
            .select(F.explode(broken).alias("rule"), F.col(key).cast("string").alias("key"), F.lit(1).cast("bigint").alias("n")))


def unique_violations(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their number of rows (partial counts before the shuffle)."""
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return (df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
            .select(F.lit("unique:" + ",".join(keys)).alias("rule"), key.alias("key"), "n"))


def orphan_violations(child: DataFrame, parent: DataFrame, key: str = "document_id") -> DataFrame:
    """Child keys without a parent; children are counted per key first, so a hot parent is one row."""
    return (child.groupBy(key).agg(F.count("*").alias("n")).join(parent.select(key), key, "left_anti")
            .select(F.lit("references:" + key).alias("rule"), F.col(key).cast("string").alias("key"), "n"))


def validate(documents: DataFrame, chunks: DataFrame, dims: int, doc_types=fv.DOC_TYPES) -> DataFrame:
    """Every constraint of the two tables in one frame: one pass for the rules of rows, one for each key, one for references."""
    checks = [
        row_violations(documents, row_rules(schemas.REQUIRED["documents"], {"doc_type": doc_types}), "document_id"),
        row_violations(chunks, row_rules(schemas.REQUIRED["chunks"], dims={"embedding": dims}), "document_id"),
        unique_violations(documents, ["source_hash"]),
        unique_violations(documents, ["document_id"]),
        unique_violations(chunks, list(schemas.CHUNK_KEY)),
        orphan_violations(chunks, documents),
    ]
    return functools.reduce(DataFrame.unionByName, checks)
