"""Scanning files of any size, block by block."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.compiled import CompiledRules
from ..sources.blocks import BLOCK_BYTES, read_byte_blocks
from .scan import scan, with_traits

# bytes next to a match that a word boundary looks at
CONTEXT = 1


def scan_files(spark: SparkSession, path: str, compiled: CompiledRules, block_bytes: int = BLOCK_BYTES, separator: str = "\n") -> DataFrame:
    """(path, ruleset, rule_id, start, end): the matches of a byte scan of each whole file, `end` exclusive.

    Every block is scanned with so many bytes of the one before as the widest rule can match, and reports the matches that end
    in it; so a match over an edge is found once, with its leftmost start. Rules that may match any number of bytes, look
    at the ends of the text, see characters (UTF8), follow `find()` or are combinations need a whole text and are refused.
    A rule with SINGLEMATCH reports its match of earliest end in the file. Without SOM_LEFTMOST, start is 0.
    """
    bounded = ~F.col("combination") & ~F.col("java") & ~F.col("utf8") & F.col("widest").isNotNull()
    refused = compiled.table.where(~bounded).select("rule_id", "pattern").limit(100).collect()
    if refused:
        raise ValueError("these rules need a whole text and cannot be scanned block by block: "
                         + "; ".join(f"{r.rule_id}: {r.pattern}" for r in refused))
    before = (compiled.table.agg(F.max("widest")).first()[0] or 0) + CONTEXT
    blocks = read_byte_blocks(spark, path, block_bytes, before, CONTEXT, separator)
    found = scan(blocks, with_traits(compiled, single=False), ["path", "block", "at"], "data", byte_scan=True, with_ruleset=True)
    end = F.col("at") + F.col("end")
    tracked = compiled.table.select(F.col("ruleset").alias("_set"), F.col("rule_id").alias("_id"), "som", "single")
    tracked = F.broadcast(tracked) if compiled.fits else tracked
    here = found.where((end > F.col("block") * block_bytes) & (end <= (F.col("block") + 1) * block_bytes)).join(
        tracked, F.col("ruleset").eqNullSafe(F.col("_set")) & (F.col("rule_id") == F.col("_id"))).select(
        "path", "ruleset", "rule_id", F.when(F.col("som"), F.col("at") + F.col("start")).otherwise(F.lit(0).cast("bigint")).alias("start"),
        end.alias("end"), "single")
    every = here.where("NOT single").drop("single")
    if not compiled.has("single"):
        return every
    first = here.where("single").groupBy("path", "ruleset", "rule_id").agg(F.min(F.struct("end", "start")).alias("m")).select(
        "path", "ruleset", "rule_id", "m.start", "m.end")
    return every.unionByName(first)
