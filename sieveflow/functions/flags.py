"""Rule flags as Column expressions."""

from functools import reduce

from pyspark.sql import Column, functions as F

from ..schemas import FLAG_BITS, JAVA, JAVA_FLAG_BITS


def has_flag(flags: Column, name: str) -> Column:
    return F.array_contains(flags, name)


def flag_bits(flags: Column) -> Column:
    """OR of the bit masks of an array of flag names."""
    masks = F.create_map(*[F.lit(x) for pair in FLAG_BITS.items() for x in pair])
    return F.aggregate(
        F.transform(flags, lambda f: masks[f]), F.lit(0), lambda a, b: a.bitwiseOR(b))


def names_from_bits(bits: Column, masks: dict[str, int]) -> Column:
    named = F.array(*[F.when(bits.bitwiseAND(F.lit(m)) != 0, F.lit(n)) for n, m in masks.items() if m])
    return F.array_compact(named)


def java_flag_names(bits: Column) -> Column:
    """java.util.regex option bits to flag names."""
    return names_from_bits(bits, JAVA_FLAG_BITS)


def unicode_case(flags: Column, dialect: Column) -> Column:
    """Does caseless matching fold beyond ASCII?"""
    return F.when(
        dialect == JAVA,
        has_flag(flags, "UNICODE_CASE") | has_flag(flags, "UNICODE_CHARACTER_CLASS"),
    ).otherwise(has_flag(flags, "UCP") | (has_flag(flags, "CASELESS") & has_flag(flags, "UTF8")))


def regex_options(flags: Column, dialect: Column) -> Column:
    """The inline option letters, as in ``(?is)``, that a rule's flags ask for."""
    java = dialect == JAVA
    letters = [
        (~java | has_flag(flags, "UNIX_LINES"), "d"),
        (has_flag(flags, "CASELESS"), "i"),
        (has_flag(flags, "DOTALL"), "s"),
        (has_flag(flags, "MULTILINE"), "m"),
        (F.when(java, has_flag(flags, "UNICODE_CASE"))
          .otherwise(has_flag(flags, "CASELESS") & has_flag(flags, "UTF8")), "u"),
        (F.when(java, has_flag(flags, "UNICODE_CHARACTER_CLASS"))
          .otherwise(has_flag(flags, "UCP")), "U"),
        (java & has_flag(flags, "COMMENTS"), "x"),
    ]
    return F.concat(*[F.when(on, F.lit(c)).otherwise(F.lit("")) for on, c in letters])


def quote_literal(pattern: Column) -> Column:
    r"""``\Q…\E`` around a pattern that is meant as plain text."""
    return F.concat(
        F.lit(r"\Q"), F.replace(pattern, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def with_options(body: Column, flags: Column, dialect: Column, grouped: Column | None = None) -> Column:
    """`body` under the rule's options, as one group unless `grouped` says it need not be.

    Java searches for a bare literal faster than for one in brackets. Callers put the
    result into a group of their own, which also ends the options.
    """
    options = regex_options(flags, dialect)
    prefix = F.when(options == "", F.lit("")).otherwise(F.concat(F.lit("(?"), options, F.lit(")")))
    comments = has_flag(flags, "COMMENTS")
    group = F.concat(F.lit("(?:"), body, F.when(comments, F.lit("\n)")).otherwise(F.lit(")")))
    bare = F.lit(False) if grouped is None else ~grouped & ~comments
    return F.concat(prefix, F.when(bare, body).otherwise(group))


def unknown_flags(flags: Column, dialect: Column) -> Column:
    """The names in `flags` that no dialect knows."""
    direct = F.array(*[F.lit(n) for n in FLAG_BITS])
    java = F.array_union(direct, F.array(*[F.lit(n) for n in JAVA_FLAG_BITS]))
    return F.array_except(flags, F.when(dialect == JAVA, java).otherwise(direct))


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)
