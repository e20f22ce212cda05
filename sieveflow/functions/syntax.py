r"""What can be told from a rule's text with string functions alone.

A pattern is cut into tokens (escape, class, group opener, quantifier, single character)
by one `regexp_extract_all`; everything here is a Column over that array. All derivations
are one-sided: where a construct is not understood, a rule merely loses a speed-up.
"""

from functools import reduce

from pyspark.sql import Column, functions as F

from ..schemas import DIRECT, JAVA
from .binding import let
from .flags import any_of, has_flag, unicode_case, with_options
from .offsets import latin1_view

TOKEN = (
    r"\\Q[\s\S]*?(?:\\E|\z)"
    r"|\\(?:[xpPN]\{[^}]*\}|x[0-9A-Fa-f]{1,2}|u[0-9A-Fa-f]{4}|[pP][A-Za-z]|c[\s\S]|0[0-7]{1,3}"
    r"|[1-9][0-9]*|[kg](?:<\w+>|\{-?\w+\})|[\s\S])"
    r"|\[\^?\]?(?:\[:\^?\w+:\]|\\[\s\S]|[^\]\\])*\]"
    r"|\(\*[^)]*\)|\(\?(?:[:=!>|#&]|<[=!]|P?<\w+>|[a-zA-Z]*(?:-[a-zA-Z]+)?[:)]|\(|R|\d)|\("
    r"|(?:[*+?]|\{\d+(?:,\d*)?\})[+?]?"
    r"|[\s\S]"
)

QUANTIFIER = r"^(?:[*+?]|\{\d+(?:,\d*)?\})[+?]?$"
OPTIONAL = r"^(?:[*?]|\{0+(?:,\d*)?\})"
VARIABLE = r"^(?:[*+?]|\{\d+,)"
POSSESSIVE = r"^(?:[*+?]|\{\d+(?:,\d*)?\})\+$"
GROUP = r"^\((?:\?(?::|P?<\w+>|[a-zA-Z]*(?:-[a-zA-Z]+)?:))?$"
CAPTURE = r"^\((?:\?P?<\w+>)?$"
OPTION_SWITCH = r"^\(\?[a-zA-Z]*(?:-[a-zA-Z]+)?[:)]$"
LOOKAROUND = r"^\(\?(?:[=!]|<[=!])$"
BACK_REFERENCE = r"^\\(?:[1-9][0-9]*|[kg](?:<\w+>|\{-?\w+\}))$"
UNUSUAL_GROUP = r"^\((?:\*.*|\?(?:[>|#&(R]|\d))"
ZERO_WIDTH = r"^(?:[\^$]|\\[bBAzZG])$"
SIMPLE_ESCAPE = (
    r"^\\(?:[dDwWsShHvVntrfae]|x[0-9A-Fa-f]{1,2}|x\{[^}]*\}|u[0-9A-Fa-f]{4}|[pP][A-Za-z]"
    r"|[pP]\{[^}]*\}|c[\s\S]|0[0-7]{1,3}|[^A-Za-z0-9])$"
)

# POSIX class names and their java.util.regex spelling.
POSIX_CLASSES = {
    "alpha": "Alpha",
    "digit": "Digit",
    "alnum": "Alnum",
    "upper": "Upper",
    "lower": "Lower",
    "space": "Space",
    "punct": "Punct",
    "print": "Print",
    "graph": "Graph",
    "cntrl": "Cntrl",
    "xdigit": "XDigit",
    "blank": "Blank",
    "word": "IsWord",
}

# ASCII word boundaries spelled out: Java's \b follows Unicode letters.
WORD_EDGE = r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))"
NO_WORD_EDGE = r"(?:(?<=\w)(?=\w)|(?<!\w)(?!\w))"

ANY_CHARACTER = r"[\s\S]"


def tokens(pattern: Column) -> Column:
    return F.regexp_extract_all(pattern, F.lit(TOKEN), F.lit(0))


def _is_class(t: Column) -> Column:
    return t.startswith("[") & (F.length(t) > 1)


def _has(toks: Column, regex: str) -> Column:
    return F.exists(toks, lambda t: F.rlike(t, F.lit(regex)))


def _java_class(t: Column) -> Column:
    """A bracket class of the direct dialect as a Java class."""
    named = F.regexp_replace(F.regexp_replace(t, r"\[:(\w+):\]", r"\\p{$1}"), r"\[:\^(\w+):\]", r"\\P{$1}")
    named = reduce(lambda c, kv: F.replace(c, F.lit("{%s}" % kv[0]), F.lit("{%s}" % kv[1])),
                   POSIX_CLASSES.items(), named)
    inner = F.substring(named, F.lit(2), F.length(named))
    plain = F.regexp_replace(inner, r"\G((?:\\.|[^\\\[])*)\[", r"$1\\[")
    return F.concat(F.lit("["), F.replace(plain, F.lit("&&"), F.lit(r"&\&")))


def java_tokens(toks: Column, dialect: Column) -> Column:
    """Tokens whose classes mean the same to Java; word boundaries are left alone."""
    return F.when(dialect == JAVA, toks).otherwise(
        F.transform(toks, lambda t: F.when(_is_class(t), _java_class(t)).otherwise(t)))


def merged_repeats(java_toks: Column) -> Column:
    """Tokens with a repeat of nothing but a repeated character made one repeat: ``(?:a+)*`` is ``(?:a*)``.

    They match the same texts, but a backtracking engine tries all ways to share the characters between the two. A capturing
    group stays, and holds the same text, where both repeats are ``+``.
    """
    def at(i: Column) -> Column:
        return F.get(java_toks, i)

    def inner(i: Column) -> Column:
        atom = at(i - 1)
        single = (atom == ".") | _is_class(atom) | F.rlike(atom, F.lit(SIMPLE_ESCAPE)) | F.rlike(atom, F.lit(r"^[^\\()|^$\[]$"))
        both = (at(i) == "+") & (at(i + 2) == "+")
        return F.coalesce(at(i).isin("*", "+") & (at(i + 1) == ")") & at(i + 2).isin("*", "+") & single
                          & ((at(i - 2) == "(?:") | ((at(i - 2) == "(") & both)), F.lit(False))

    def merged(t: Column, i: Column) -> Column:
        return F.when(inner(i - 2), F.lit("")).when(inner(i), F.when((t == "+") & (at(i + 2) == "+"), F.lit("+")).otherwise(F.lit("*"))).otherwise(t)

    return F.filter(F.transform(java_toks, merged), lambda t: t != "")


def plain_edge(t: Column) -> Column:
    """A token of the direct dialect with word boundaries spelled out."""
    return F.when(t == r"\b", F.lit(WORD_EDGE)).when(t == r"\B", F.lit(NO_WORD_EDGE)).otherwise(t)


def java_source(java_toks: Column, dialect: Column) -> Column:
    """A Java regex from :func:`java_tokens`."""
    return F.array_join(F.when(dialect == JAVA, java_toks).otherwise(F.transform(java_toks, plain_edge)), "")


def needs_byte_view(toks: Column, pattern: Column, flags: Column, dialect: Column) -> Column:
    """Does the rule see single bytes, so that non-ASCII text may match differently?

    Without UTF8 a direct rule works on bytes. That only shows when the rule itself is not
    ASCII or has an atom (dot, negated class) that a byte of a longer character can match.
    """
    wide = F.exists(toks, lambda t: (t == ".") | t.startswith("[^")
                    | F.rlike(t, F.lit(r"^(?:\[.*)?\\[DWSHVPpXRN]")))
    return (dialect == DIRECT) & ~has_flag(flags, "UTF8") & (wide | F.rlike(pattern, F.lit(r"[^\x00-\x7F]")))


def last_atom(java_toks: Column, dialect: Column) -> Column:
    """What the last character of every match matches, where the rule says so plainly, else NULL.

    That is a literal, an escape for a class or a class at the very end, bare or repeated at least once, in a
    rule without branches and option switches.
    """
    end = F.try_element_at(java_toks, F.lit(-1))
    repeated = F.rlike(end, F.lit(r"^\+\??$"))
    atom = F.when(repeated, F.try_element_at(java_toks, F.lit(-2))).otherwise(end)
    plain = F.rlike(atom, F.lit(r"""^(?:[A-Za-z0-9 _,;:!@%=~"'<>/-]|\\[dws]|\[.+\])$"""))
    unsure = F.array_contains(java_toks, "|") | _has(java_toks, OPTION_SWITCH) | _has(java_toks, UNUSUAL_GROUP) | _has(java_toks, r"^\\Q")
    return F.when((dialect == DIRECT) & plain & ~unsure, atom)


# Marks of a rule cut into steps.
STEP, STEP_LEAST = chr(14), chr(15)
STEP_QUANTIFIER = r"^(?:[*+]|\{\d+,?\})\??$"
STEP_GAP = r"^(?:[*+]|\{\d+,\})\??$"
# Blocks and repeated characters of a chain, and what stands for the least number of its step.
CHAIN_BLOCK = r"""^[A-Za-z0-9 _,;:!@%=~"'<>/-]+$"""
CHAIN_REPEAT = r"""^(?:\.|\\[dDwWsS]|\[\^?(?:\\[dDwWsSnrt]|[A-Za-z0-9 _,;:!@%=~"'<>/.])+\])$"""
CHAIN, CHAIN_ALWAYS, CHAIN_TO_END = -1, -2, -3


def steps(java_toks: Column, flags: Column, dialect: Column) -> Column:
    """A rule as blocks of fixed width with unbounded repeats of one character between them, else NULL.

    array<struct<rx, lo>>: blocks (`lo` NULL, perhaps empty) and repeats of at least `lo` characters take turns,
    beginning and ending with a block. There is no branch, group or optional part in such a rule.

    Steps with repeats of one character whose blocks consist of it are taken together, as a chain: in a run of the character the
    first place reached leads to all that later ones lead to. A chain (`lo` CHAIN, or CHAIN_ALWAYS if it cannot fail) has the groups
    1 (to the first place reached), 2 (the rest of the run) and 3 (a run in which it fails). Of CHAIN_TO_END only the run's end is reached.
    """
    return _stepwise(java_toks, flags, dialect)["steps"]


def chain_test(java_toks: Column, flags: Column, dialect: Column) -> Column:
    """The chain of a rule that matches wherever its chain does, if it is one and can fail, else NULL."""
    return _stepwise(java_toks, flags, dialect)["test"]


def _stepwise(java_toks: Column, flags: Column, dialect: Column) -> Column:
    """struct<steps, test>, or NULL for a rule that is not made of steps."""
    def quantifier(i: Column) -> Column:
        return F.coalesce(F.when(F.rlike(F.get(java_toks, i + 1), F.lit(QUANTIFIER)), F.get(java_toks, i + 1)), F.lit(""))

    zero_width = r"^(?:[\^$]|\\[bB])$"

    def usable(t: Column, i: Column) -> Column:
        single = (t == ".") | _is_class(t) | F.rlike(t, F.lit(SIMPLE_ESCAPE)) | ((F.length(t) == 1) & ~t.isin("(", ")", "|", "^", "$", "\\", "["))
        return F.when(F.rlike(t, F.lit(QUANTIFIER)), F.rlike(t, F.lit(STEP_QUANTIFIER))).otherwise(
            single | (F.rlike(t, F.lit(zero_width)) & (quantifier(i) == "")))

    def part(t: Column, i: Column) -> Column:
        q = quantifier(i)
        least = F.when(q.startswith("*"), F.lit("0")).when(q.startswith("+"), F.lit("1")).otherwise(F.regexp_extract(q, r"\d+", 0))
        return F.when(F.rlike(t, F.lit(QUANTIFIER)), F.lit("")).when(
            F.rlike(q, F.lit(STEP_GAP)), F.concat(F.lit(STEP), least, F.lit(STEP_LEAST), t, F.lit(STEP))).otherwise(F.concat(plain_edge(t), q))

    def step(text: Column) -> Column:
        least = F.when(F.contains(text, F.lit(STEP_LEAST)), F.substring_index(text, STEP_LEAST, 1).cast("int"))
        body = F.when(least.isNull(), text).otherwise(F.concat(F.substring_index(text, STEP_LEAST, -1), F.lit("+")))
        return F.struct(F.when(body == "", body).otherwise(with_options(body, flags, dialect)).alias("rx"), least.alias("lo"))

    joined = F.array_join(F.transform(java_toks, part), "")
    plain = ~F.exists(F.transform(java_toks, usable), lambda ok: ~ok) & ~_has(java_toks, f"[{STEP}{STEP_LEAST}]")
    unsure = has_flag(flags, "COMMENTS") | has_flag(flags, "LITERAL") | has_flag(flags, "COMBINATION")

    def chained(parts: Column) -> Column:
        """The chain at the beginning of `parts` and the steps behind it."""
        n = ((F.size(parts) - 1) / 2).cast("int")
        atom = F.substring_index(F.get(parts, F.lit(1)), STEP_LEAST, -1)

        def least(j) -> Column:
            return F.substring_index(F.get(parts, j * 2 + 1), STEP_LEAST, 1)

        def inside(j: Column, r: Column) -> Column:
            """Is block `j` a literal of characters that `r` repeats?"""
            block = F.get(parts, j * 2)
            return F.rlike(block, F.lit(CHAIN_BLOCK)) & F.when(r == ".", F.lit(True)).when(
                F.rlike(r, F.lit(CHAIN_REPEAT)) & ~has_flag(flags, "CASELESS"),
                F.rlike(block, with_options(F.concat(F.lit(r"\A(?:"), r, F.lit(r")+\z")), flags, dialect))).otherwise(F.lit(False))

        def joins(j: Column, r: Column) -> Column:
            begin = inside(j, r) | ((j == 0) & (r == ".") & (F.get(parts, F.lit(0)) == "^"))
            return begin & (F.substring_index(F.get(parts, j * 2 + 1), STEP_LEAST, -1) == r)

        def of(k: Column, r: Column) -> Column:
            first, last = F.get(parts, F.lit(0)), F.get(parts, k * 2)
            between = F.array_join(F.transform(F.slice(F.sequence(F.lit(0), n), F.lit(2), k - 1), lambda j: F.concat(
                F.lit("(?>"), r, F.lit("{"), least(j - 1), F.lit(",}?"), F.get(parts, j * 2), F.lit(")"))), "")
            more = F.when(least(k - 1) == "0", F.lit("")).otherwise(F.concat(r, F.lit("{"), least(k - 1), F.lit("}")))
            whole = k == n
            ahead = F.when(whole & inside(k, r), F.concat(F.lit("(?="), r, F.lit("*?"), last, F.lit(")"))).otherwise(F.lit(""))
            fails = (k > 1) | (more != "") | (ahead != "")
            # where a repeat of any character ends, the rule's end is met
            ends = (last == "$") & (r == ".") & (has_flag(flags, "MULTILINE") | has_flag(flags, "DOTALL"))
            to_end = whole & fails & ends & ~has_flag(flags, "DOTALL")
            kind = F.when(to_end, CHAIN_TO_END).when(fails, CHAIN).otherwise(CHAIN_ALWAYS)
            body = F.concat(F.lit("("), first, between, more, F.lit(")"), ahead, F.lit("("), r, F.lit("*+)|("), first, r, F.lit("*+)"))
            return let(with_options(body, flags, dialect), lambda rx: F.struct(
                F.concat(F.array(F.struct(rx.alias("rx"), kind.alias("lo"))), F.transform(
                    F.slice(parts, k * 2 + 1, F.when(to_end, 0).otherwise(F.size(parts))), step)).alias("steps"),
                F.when(whole & fails & ((last == "") | (ahead != "") | ends), rx).alias("test")))

        def with_repeat(r: Column) -> Column:
            taken = F.array_position(F.transform(F.sequence(F.lit(0), n - 1), lambda j: joins(j, r)), False).cast("int")
            return let(F.when(taken == 0, n).otherwise(taken - 1), lambda k: F.when(k > 0, of(k, r)).otherwise(
                F.struct(F.transform(parts, step).alias("steps"), F.lit(None).cast("string").alias("test"))))

        return let(atom, with_repeat)

    return F.when((dialect == DIRECT) & plain & ~unsure & F.contains(joined, F.lit(STEP)), let(F.split(joined, STEP, -1), chained))


ANCHOR = r"^(?:[\^$]|\\[AzZG])$"
WIDEST = 1 << 20


def widest(java_toks: Column, pattern: Column, flags: Column) -> Column:
    """A number of characters that no match of the rule exceeds, or NULL if there is none or an anchor ties it to the text's ends.

    Each atom counts as often as all bounded repeats of the rule together would allow.
    """
    def times(t: Column) -> Column:
        most = F.coalesce(F.try_element_at(F.regexp_extract_all(t, F.lit(r"\d+"), F.lit(0)), F.lit(-1)), F.lit("1"))
        return F.when(F.rlike(t, F.lit(QUANTIFIER)), F.greatest(most.try_cast("double"), F.lit(1.0))).otherwise(F.lit(1.0))

    def atoms(t: Column) -> Column:
        nothing = F.rlike(t, F.lit(QUANTIFIER)) | F.rlike(t, F.lit(ZERO_WIDTH)) | t.isin("|", ")") | F.rlike(t, F.lit(GROUP)) | F.rlike(t, F.lit(OPTION_SWITCH))
        return F.when(nothing, 0).when(t.startswith("\\Q"), F.length(t)).otherwise(1)

    unbounded = any_of([_has(java_toks, r"^(?:[*+]|\{\d+,\})"), _has(java_toks, BACK_REFERENCE), _has(java_toks, UNUSUAL_GROUP),
                        _has(java_toks, LOOKAROUND), _has(java_toks, r"^\\[RXCN]"), _has(java_toks, ANCHOR)])
    bound = F.aggregate(java_toks, F.lit(0.0), lambda n, t: n + atoms(t)) * F.aggregate(java_toks, F.lit(1.0), lambda n, t: n * times(t))
    return F.when(has_flag(flags, "LITERAL"), F.octet_length(pattern)).when(~unbounded & (bound <= WIDEST), bound.cast("int"))


def marked_groups(java_toks: Column) -> Column:
    """struct<rx, groups, unsure>: the rule with names for its groups and for what precedes each one inside the group around it.

    Capturing group n is called zcn, others zg and their number; zp and the number is what precedes a group, zr all repeats
    of a repeated one. Tokens are read from the right, so that where a branch begins it is known what to open there.
    `unsure`: a group lies inside a repeated one or a lookaround, where lengths do not tell its place, or is referred to by name.
    """
    entry = "struct<id:int,n:int,parent:int,repeated:boolean,many:boolean,opaque:boolean>"
    level = "struct<id:int,text:string,open:string,quant:string>"
    state = f"struct<levels:array<{level}>,quant:string,n:int,ids:int,groups:array<{entry}>>"

    def lit(text: str) -> Column:
        return F.lit(text)

    def made(a: Column, levels: Column, quant=None, n=None, ids=None, groups=None) -> Column:
        return F.struct(levels.alias("levels"), (lit("") if quant is None else quant).alias("quant"), (a["n"] if n is None else n).alias("n"),
                        (a["ids"] if ids is None else ids).alias("ids"), (a["groups"] if groups is None else groups).alias("groups")).cast(state)

    def top_with(levels: Column, text: Column, opened: Column) -> Column:
        """`levels` with another text and other openings at the top."""
        top = F.element_at(levels, -1)
        return F.concat(F.slice(levels, F.lit(1), F.size(levels) - 1), F.array(F.struct(
            top["id"].alias("id"), text.alias("text"), opened.alias("open"), top["quant"].alias("quant"))))

    def opener(a: Column, t: Column) -> Column:
        inner, below = F.element_at(a["levels"], -1), F.slice(a["levels"], F.lit(1), F.size(a["levels"]) - 1)
        around = F.element_at(below, -1)
        capture, opaque = F.rlike(t, lit(CAPTURE)), F.rlike(t, lit(LOOKAROUND)) | F.rlike(t, lit(r"^\(\?<[=!]$"))
        number = inner["id"].cast("string")
        body = F.concat(inner["open"], inner["text"])
        named = F.concat(F.when(capture, F.concat(lit("(?<zc"), a["n"].cast("string"))).otherwise(F.concat(lit("(?<zg"), number)), lit(">"),
                         F.when(capture | (t == "(?:"), body).otherwise(F.concat(t, body, lit(")"))), lit(")"))
        repeated = inner["quant"] != ""
        group = F.when(opaque, F.concat(t, body, lit(")"), inner["quant"], around["text"])).otherwise(F.concat(
            lit(")"), F.when(repeated, F.concat(lit("(?<zr"), number, lit(">"), named, inner["quant"], lit(")"))).otherwise(named), around["text"]))
        entered = F.concat(a["groups"], F.array(F.struct(
            inner["id"].alias("id"), F.when(capture, a["n"]).otherwise(0).alias("n"), around["id"].alias("parent"),
            repeated.alias("repeated"), (repeated & ~F.rlike(inner["quant"], lit(r"^(?:\?|\{1\}|\{0,1\})"))).alias("many"), opaque.alias("opaque"))))
        opened = F.when(opaque, around["open"]).otherwise(F.concat(around["open"], lit("(?<zp"), number, lit(">")))
        return made(a, top_with(below, group, opened), n=F.when(capture, a["n"] - 1).otherwise(a["n"]), groups=entered)

    def take(a: Column, t: Column) -> Column:
        top = F.element_at(a["levels"], -1)
        pushed = F.concat(a["levels"], F.array(F.struct((a["ids"] + 1).alias("id"), lit("").alias("text"), lit("").alias("open"), a["quant"].alias("quant"))))
        branch = top_with(a["levels"], F.concat(t, top["open"], top["text"]), lit(""))
        number = F.regexp_extract(t, r"^\\([1-9][0-9]*)$", 1)
        atom = F.when(number != "", F.concat(lit("\\k<zc"), number, lit(">"))).otherwise(t)
        single = top_with(a["levels"], F.concat(atom, a["quant"], top["text"]), top["open"])
        return (F.when(F.rlike(t, lit(QUANTIFIER)), made(a, a["levels"], quant=t))
                .when(t == ")", made(a, pushed, ids=a["ids"] + 1))
                .when(t.startswith("(") & ~F.rlike(t, lit(r"^\((?:\?[a-zA-Z]*(?:-[a-zA-Z]+)?\)|\*)")), opener(a, t))
                .when(t == "|", made(a, branch))
                .otherwise(made(a, single)))

    def finish(a: Column) -> Column:
        top = F.element_at(a["levels"], 1)
        groups = F.array_sort(a["groups"])
        # a parent's number is smaller than a child's
        inside = F.aggregate(groups, F.array().cast("array<boolean>"), lambda known, g: F.concat(known, F.array(F.coalesce(
            F.get(known, g["parent"] - 1) | F.get(groups, g["parent"] - 1)["many"] | F.get(groups, g["parent"] - 1)["opaque"], F.lit(False)))))
        unsure = let(inside, lambda known: F.exists(groups, lambda g: (g["n"] > 0) & F.get(known, g["id"] - 1)))
        return F.struct(F.concat(top["open"], top["text"]).alias("rx"), groups.alias("groups"),
                        (unsure | _has(java_toks, r"^\\[kg]")).alias("unsure"))

    captures = F.size(F.filter(java_toks, lambda t: F.rlike(t, lit(CAPTURE)))).cast("int")
    start = F.struct(F.array(F.struct(F.lit(0).alias("id"), lit("").alias("text"), lit("").alias("open"), lit("").alias("quant"))).alias("levels"),
                     lit("").alias("quant"), captures.alias("n"), F.lit(0).alias("ids"), F.array().cast(f"array<{entry}>").alias("groups")).cast(state)
    return F.aggregate(F.reverse(java_toks), start, take, finish)


def looks_around(java_toks: Column) -> Column:
    """Does the rule look further than a few characters beyond a match?"""
    return _has(java_toks, LOOKAROUND) | _has(java_toks, r"^\\[GX]$")


def capture_groups(toks: Column) -> Column:
    return F.size(F.filter(toks, lambda t: F.rlike(t, F.lit(CAPTURE)))).cast("int")


def fixed_width(toks: Column) -> Column:
    """Do all matches have one length, so that each start has one end and the reverse?"""
    return ~any_of([
        F.array_contains(toks, "|"),
        _has(toks, VARIABLE), _has(toks, BACK_REFERENCE), _has(toks, UNUSUAL_GROUP),
        _has(toks, r"^\\[RXCN]"),
    ])


def run_class(java_toks: Column, flags: Column) -> Column:
    r"""A class that holds every character a match can consume.

    A match then lies inside one maximal run of such characters. Constructs that reach
    outside a run, or that are not understood, give ``[\s\S]``: the whole text is one run.
    """
    dot = F.when(has_flag(flags, "DOTALL"), F.lit(ANY_CHARACTER)).otherwise(F.lit(r"[^\n]"))

    def atom(t: Column) -> Column:
        return (
            F.when(F.rlike(t, F.lit(QUANTIFIER)) | F.rlike(t, F.lit(ZERO_WIDTH)) | t.isin("|", ")"), F.lit(""))
            .when(F.rlike(t, F.lit(OPTION_SWITCH)) & (t != "(?:"), F.lit(None))
            .when(F.rlike(t, F.lit(GROUP)), F.lit(""))
            .when(t == ".", dot)
            .when(_is_class(t) | F.rlike(t, F.lit(SIMPLE_ESCAPE)), t)
            .when(t.startswith("\\") | t.startswith("("), F.lit(None))
            .when(F.rlike(t, F.lit(r"^[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]$")), F.concat(F.lit("\\"), t))
            .otherwise(t))

    def joined(parts: Column) -> Column:
        unknown = F.exists(parts, lambda p: p.isNull()) | has_flag(flags, "COMMENTS") | has_flag(flags, "LITERAL")
        text = F.array_join(F.array_distinct(parts), "")
        return F.when(unknown | (text == ""), F.lit(ANY_CHARACTER)).otherwise(
            F.concat(F.lit("["), text, F.lit("]")))

    return let(F.transform(java_toks, atom), joined)


def run_with_match(run: Column, body: Column) -> Column:
    """A regex for the maximal runs of class `run` in which `body` matches."""
    return F.concat(F.lit("(?<!"), run, F.lit(")"), run, F.lit("*?(?:"), body, F.lit(")"), run, F.lit("*+"))


def never_overlaps(java_toks: Column, flags: Column) -> Column:
    """Can two matches of a fixed-width rule not share a character?

    So it is if what the rule starts with can occur nowhere else in it, or if it is plain
    text of which no end is also a beginning.
    """
    def plain(text: Column) -> Column:
        return ~F.exists(F.sequence(F.lit(0), F.length(text) - 1), lambda k: (k > 0) & (
            F.substring(text, F.lit(1), k) == F.substring(text, F.length(text) - k + 1, k)))

    first = F.get(java_toks, F.lit(0))
    rest = F.slice(java_toks, F.lit(2), F.greatest(F.size(java_toks) - 1, F.lit(0)))
    repeated = F.coalesce(F.rlike(F.get(java_toks, F.lit(1)), F.lit(QUANTIFIER)), F.lit(False))
    ascii_letter = F.rlike(first, F.lit(r"^[A-Za-z0-9 ]$")) & ~repeated
    elsewhere = F.concat(F.lit("(?iu)"), run_class(rest, flags))
    all_plain = ~F.exists(java_toks, lambda t: ~F.rlike(t, F.lit(r"^[A-Za-z0-9 ]$")))
    return F.when(all_plain, plain(F.lower(F.array_join(java_toks, "")))).otherwise(
        ascii_letter & ~F.rlike(first, elsewhere))


# Marks of the skeleton that required_literals works on.
GAP, OPEN, CLOSE, ALT, MAYBE, REPEAT, CHOICE = (chr(c) for c in range(1, 8))
MIN_LITERAL = 3


def _skeleton(toks: Column) -> Column:
    def mark(t: Column) -> Column:
        return (
            F.when(F.rlike(t, F.lit(QUANTIFIER)),
                   F.when(F.rlike(t, F.lit(OPTIONAL)), F.lit(MAYBE)).otherwise(F.lit(REPEAT)))
            .when(F.rlike(t, F.lit(GROUP)), F.lit(OPEN))
            .when(t == ")", F.lit(CLOSE))
            .when(t == "|", F.lit(ALT))
            .when(F.rlike(t, F.lit(r"^\\[^A-Za-z0-9]$")), F.substring(t, 2, 1))
            .when((F.length(t) == 1) & ~t.isin(".", "^", "$"), t)
            .otherwise(F.lit(GAP)))

    return F.array_join(F.transform(toks, mark), "")


def _longest_run(branch: Column) -> Column:
    runs = F.filter(F.split(branch, "[\x01-\x07]+"), lambda r: (F.length(r) >= MIN_LITERAL)
                    | ((F.length(r) == 2) & F.rlike(r, F.lit(r"[^\x00-\x7F]"))))
    best = F.array_max(F.transform(runs, lambda r: F.struct(F.length(r).alias("n"), r.alias("run"))))
    return F.lower(best["run"])


def _one_per_branch(text: Column) -> Column:
    """A literal for every branch of an alternation, or NULL if one has none."""
    found = F.transform(F.split(text, ALT), _longest_run)
    return F.when(~F.exists(found, lambda f: f.isNull()), F.array_distinct(found))


def _all_runs(flat: Column) -> Column:
    """Every run that a match of a skeleton without branches must hold."""
    runs = F.filter(F.split(F.replace(flat, F.lit(CHOICE), F.lit(GAP)), "[\x01-\x07]+"), lambda r: (F.length(r) >= MIN_LITERAL)
                    | ((F.length(r) == 2) & F.rlike(r, F.lit(r"[^\x00-\x7F]"))))
    return F.array_distinct(F.transform(runs, F.lower))


def required_literals(toks: Column, pattern: Column, flags: Column, dialect: Column, every: bool = False) -> Column:
    """Lower-case literals of which every match of the rule contains at least one, or NULL.

    To be looked up in the lower-case text. Letters whose case folding or lower-casing
    leaves ASCII, or depends on the neighbours, are not used. With `every`: literals that each match contains all of
    (NULL if the rule has branches outside of brackets).
    """
    folds = unicode_case(flags, dialect)
    unsure = any_of([
        has_flag(flags, "COMMENTS"), has_flag(flags, "COMBINATION"), has_flag(flags, "CANON_EQ"),
        F.rlike(pattern, F.lit("[\x01-\x07]")),
        _has(toks, LOOKAROUND), _has(toks, UNUSUAL_GROUP), _has(toks, r"^\(\?[a-zA-Z]*(?:-[a-zA-Z]+)?[xuU]"),
        _has(toks, r"^\(\?[a-wyzA-TV-Z]*[xuU]"),
        # a class inside a class ends later than its first bracket
        (dialect == JAVA) & _has(toks, r"^\[(?:\^?\]|.+\[)"),
    ])
    literal = has_flag(flags, "LITERAL")
    text = F.when(literal, pattern).otherwise(_skeleton(toks))
    text = F.regexp_replace(text, rf"[^\x01-\x07]{MAYBE}", GAP)
    text = F.regexp_replace(text, r"[^\x01-\x7F\p{Lo}]", GAP)
    text = F.when(folds, F.regexp_replace(text, "[iksIKS]", GAP)).otherwise(text)

    def reduced(skeleton: Column) -> Column:
        # the first alternation in brackets is set aside; it counts if it is mandatory
        choice = f"{OPEN}([^{OPEN}{CLOSE}]*{ALT}[^{OPEN}{CLOSE}]*){CLOSE}(?!{MAYBE})"
        options = F.regexp_extract(skeleton, choice, 1)
        x = F.regexp_replace(skeleton, f"^([\\s\\S]*?){choice}([\\s\\S]*)$", f"$1{CHOICE}$3")
        for _ in range(5):
            x = F.regexp_replace(x, f"{OPEN}([^{OPEN}{CLOSE}{ALT}]*){CLOSE}(?!{MAYBE})", "$1")
            x = F.regexp_replace(x, f"{OPEN}[^{OPEN}{CLOSE}]*{CLOSE}{MAYBE}?", GAP)

        def all_of(flat: Column) -> Column:
            return F.when(~F.rlike(flat, F.lit(f"[{OPEN}{CLOSE}{ALT}]")), _all_runs(flat))

        def chosen(flat: Column) -> Column:
            mandatory = F.contains(flat, F.lit(CHOICE)) & ~F.contains(flat, F.lit(ALT))
            return F.when(~F.rlike(flat, F.lit(f"[{OPEN}{CLOSE}]")), F.coalesce(
                _one_per_branch(flat), F.when(mandatory, _one_per_branch(options))))

        return let(x, all_of if every else chosen)

    return F.when(~unsure, let(text, reduced))


def refused_construct(toks: Column) -> Column:
    """Message for a construct that the direct dialect has no meaning for, else NULL."""
    checks = [
        (BACK_REFERENCE, "back-references are not supported"),
        (POSSESSIVE, "possessive quantifiers are not supported"),
        (LOOKAROUND, "lookaround is not supported"),
        (r"^\(\?>$", "atomic groups are not supported"),
        (r"^\(\*", "backtracking verbs are not supported"),
        (r"^\(\?(?:\(|R|\d|&|\|)", "conditional, recursive and reset groups are not supported"),
        (r"^\\[KGXRC]$", "this escape is not supported"),
    ]
    return F.coalesce(*[F.when(_has(toks, rx), F.lit(msg)) for rx, msg in checks])


def latin1_tokens(toks: Column) -> Column:
    return F.transform(toks, latin1_view)
