"""Table layouts and fixed values shared by every operator."""

from pyspark.sql import types as T

RULES = T.StructType([
    T.StructField("rule_id", T.IntegerType()),
    T.StructField("pattern", T.StringType(), False),
    T.StructField("flags", T.ArrayType(T.StringType()), False),
    T.StructField("dialect", T.StringType(), False),
    T.StructField("ruleset", T.StringType()),
    T.StructField("pos", T.IntegerType()),
])

# The flag names of the direct dialect and their bit masks.
FLAG_BITS = {
    "NO_FLAG": 0,
    "CASELESS": 1,
    "DOTALL": 2,
    "MULTILINE": 4,
    "SINGLEMATCH": 8,
    "ALLOWEMPTY": 16,
    "UTF8": 32,
    "UCP": 64,
    "PREFILTER": 128,
    "SOM_LEFTMOST": 256,
    "COMBINATION": 512,
    "QUIET": 1024,
}

# Java.util.regex.Pattern option bits, by the name used in `flags`.
JAVA_FLAG_BITS = {
    "UNIX_LINES": 1,
    "CASELESS": 2,
    "COMMENTS": 4,
    "MULTILINE": 8,
    "LITERAL": 16,
    "DOTALL": 32,
    "UNICODE_CASE": 64,
    "CANON_EQ": 128,
    "UNICODE_CHARACTER_CLASS": 256,
}

DIRECT = "direct"
JAVA = "java"
