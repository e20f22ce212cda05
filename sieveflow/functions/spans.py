r"""Where a rule matches inside one text, as an array column.

Spans are structs ``s`` (start), ``e`` (exclusive end) in the asked unit and ``m`` (text).
The regex runs once: `regexp_replace` puts a mark around every match and `split` cuts there,
so positions are running totals of piece lengths and no text is searched twice.
"""

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from .binding import let, running_totals
from .offsets import measure
from .syntax import CHAIN_ALWAYS, CHAIN_TO_END

NO_SPANS = "array<struct<s:bigint,e:bigint,m:string>>"
# Noncharacters: they may occur in a text, which is why the mark adapts to it.
MARK, MARK_END = "\uFDD0", "\uFDD1"
BLOCK = 64
MAX_LENGTH = (1 << 31) - 1


def free_mark(text: Column) -> Column:
    """A string that does not occur in `text`, nor across a cut of it."""
    longest = F.array_max(F.transform(
        F.regexp_extract_all(text, F.lit(MARK + "+"), F.lit(0)), lambda r: F.length(r)))
    return F.when(~F.contains(text, F.lit(MARK)), F.lit(MARK)).otherwise(
        F.concat(F.repeat(F.lit(MARK), longest + 1), F.lit(MARK_END)))


def _pieces(text: Column, regex: Column, group: str) -> Column:
    """[gap, match, gap, match, …, gap] of `text`."""
    return let(free_mark(text), lambda mark: F.split(
        F.regexp_replace(text, regex, F.concat(mark, F.lit(group), mark)), mark, -1))


def _with_offsets(parts: Column, unit: str, body) -> Column:
    """``body(offset)``, where ``offset(i)`` is the total length of the first `i` of `parts`.

    Appending to an array copies it, so running totals are kept per block only, and the
    rest is the length of the few parts before `i` in its block.
    """
    def joined(first: Column, n) -> Column:
        return measure(F.array_join(F.slice(parts, first, n), ""), unit)

    blocks = F.transform(
        F.sequence(F.lit(1), F.size(parts), F.lit(BLOCK)), lambda first: joined(first, BLOCK))

    def from_totals(totals: Column) -> Column:
        def offset(i: Column) -> Column:
            block = F.floor(i / BLOCK).cast("int")
            return totals[block] + joined(block * BLOCK + 1, i - block * BLOCK)
        return body(offset)

    return let(running_totals(blocks), from_totals)


def _spans_of_pieces(pieces: Column, unit: str, overlapping: bool) -> Column:
    def span(start: Column, match: Column) -> Column:
        return let(start, lambda s: F.struct(
            s.alias("s"), (s + measure(match, unit)).alias("e"), match.alias("m")))

    def one_after_another(p: Column) -> Column:
        return _with_offsets(p, unit, lambda offset: F.transform(
            _match_numbers(p), lambda i: span(offset(i), p[i])))

    def copies(p: Column) -> Column:
        gaps = F.filter(p, lambda _, i: i % 2 == 0)
        return let(gaps, lambda g: _with_offsets(g, unit, lambda offset: F.transform(
            F.sequence(F.lit(1), F.size(g) - 1), lambda i: span(offset(i), p[i * 2 - 1]))))

    return let(pieces, lambda p: F.when(
        F.size(p) > 1, copies(p) if overlapping else one_after_another(p)).otherwise(F.array().cast(NO_SPANS)))


def _match_numbers(pieces: Column) -> Column:
    return F.sequence(F.lit(1), F.size(pieces) - 2, F.lit(2))


def _whole_characters(text: Column, rx: Column) -> Column:
    """`rx`, kept from starting between the two halves of a surrogate pair."""
    return F.when(measure(text, "utf16") == F.length(text), rx).otherwise(
        F.concat(F.lit(r"(?![\x{DC00}-\x{DFFF}])"), rx))


def find_spans(text: Column, rx: Column, unit: str) -> Column:
    """Leftmost, non-overlapping matches in order, as repeated ``find()`` gives them."""
    return _spans_of_pieces(_pieces(text, _whole_characters(text, rx), "$0"), unit, overlapping=False)


def spans_at_every_start(text: Column, rx: Column, unit: str) -> Column:
    """One match per start, overlaps included: all matches of a fixed-width rule."""
    ahead = F.concat(F.lit("(?=("), rx, F.lit("))"))
    return _spans_of_pieces(_pieces(text, _whole_characters(text, ahead), "$1"), unit, overlapping=True)


# Reached places: from `lo` to `hi`, all with the leftmost start `s`; in order and apart.
REACHED = "array<struct<lo:bigint,hi:bigint,s:bigint>>"


def _reached(lo: Column, hi: Column, s: Column) -> Column:
    return F.struct(lo.cast("bigint").alias("lo"), hi.cast("bigint").alias("hi"), s.cast("bigint").alias("s"))


def _not_beyond(values: Column, field: str, limit: Column) -> Column:
    """How many of the `values`, sorted by `field`, do not exceed `limit`: a binary search."""
    strides = F.transform(F.sequence(F.lit(0), F.length(F.bin(F.size(values)))), lambda k: F.call_function(
        "shiftleft", F.lit(1), F.length(F.bin(F.size(values))) - k))
    return F.aggregate(strides, F.lit(0), lambda n, step: F.when(
        F.coalesce(F.get(values, n + step - 1)[field] <= limit, F.lit(False)), n + step).otherwise(n))


def _after_block(reached: Column, found: Column) -> Column:
    """Behind each occurrence of a block that begins at a reached place (at any place, before the first step)."""
    def joined(o: Column) -> Column:
        return let(F.get(reached, _not_beyond(reached, "lo", o["s"]) - 1), lambda r: F.when(
            r["hi"] >= o["s"], _reached(o["e"], o["e"], r["s"])))

    return F.when(reached.isNull(), F.transform(found, lambda o: _reached(o["e"], o["e"], o["s"]))).otherwise(
        F.array_compact(F.transform(found, joined)))


def _after_repeat(reached: Column, runs: Column, least: Column, n: Column) -> Column:
    """What at least `least` characters further inside a run lies behind a reached place.

    Starts never fall from one reached place to the next, so the first one in a run is the leftmost for all of it.
    """
    def from_first(run: Column) -> Column:
        return let(F.get(reached, _not_beyond(reached, "hi", run["s"] - 1)), lambda r: F.when(
            F.greatest(r["lo"], run["s"]) + least <= run["e"], _reached(F.greatest(r["lo"], run["s"]) + least, run["e"], r["s"])))

    def outside(lo: Column, hi: Column) -> Column:
        return F.filter(F.sequence(lo, hi), lambda p: F.coalesce(
            F.get(runs, _not_beyond(runs, "s", p) - 1)["e"] < p, F.lit(True)))

    begun = F.when(reached.isNull(), F.transform(
        F.filter(runs, lambda r: r["e"] - r["s"] >= least), lambda r: _reached(r["s"] + least, r["e"], r["s"]))).otherwise(
        F.array_compact(F.transform(runs, from_first)))
    skipped = F.when(reached.isNull(), F.transform(outside(F.lit(0).cast("bigint"), n), lambda p: _reached(p, p, p))).otherwise(
        F.flatten(F.transform(reached, lambda r: F.transform(outside(r["lo"], r["hi"]), lambda p: _reached(p, p, r["s"])))))
    return F.when(least > 0, begun).otherwise(F.array_sort(F.concat(begun, skipped)))


def _after_chain(text: Column, step: Column) -> Column:
    """What a chain, as the first step, reaches in each run of the character it repeats."""
    def marked(mark: Column) -> Column:
        # a point after each match tells one that failed, which is unmarked again, from one beside another
        found = F.regexp_replace(text, step["rx"], F.concat(F.lit("$3"), mark, F.lit("$1"), mark, F.lit("$2"), mark, F.lit(".")))
        return F.split(F.when(step["lo"] == CHAIN_ALWAYS, found).otherwise(F.replace(found, F.concat(mark, mark, mark, F.lit(".")), F.lit(""))), mark, -1)

    def reached(p: Column) -> Column:
        return _with_offsets(p, "codepoint", lambda offset: F.transform(
            F.sequence(F.lit(1), F.size(p) - 3, F.lit(3)), lambda i: let(offset(i), lambda s: let(
                s + F.length(p[i]), lambda lo: let(lo + F.length(p[i + 1]), lambda hi: _reached(
                    F.when(step["lo"] == CHAIN_TO_END, hi).otherwise(lo), hi, s))))))

    without_points = F.transform(let(free_mark(text), marked), lambda p, i: F.when((i > 0) & (i % 3 == 0), F.substring(p, 2, MAX_LENGTH)).otherwise(p))
    return let(without_points, lambda p: F.when(F.size(p) > 1, reached(p)).otherwise(F.array().cast(REACHED)))


def _unit_of(text: Column, unit: str, body) -> Column:
    """``body(offset)``, where ``offset(cp)`` is the code-point offset `cp` in `unit`."""
    if unit == "codepoint":
        return body(lambda cp: cp)

    def with_blocks(b: Column) -> Column:
        def offset(cp: Column) -> Column:
            i = F.floor(cp / BLOCK).cast("int")
            rest = F.substring(F.coalesce(F.get(b["parts"], i), F.lit("")), F.lit(1), (cp % BLOCK).cast("int"))
            return F.when(b["same"], cp).otherwise(F.get(b["totals"], i) + measure(rest, unit))
        return body(offset)

    parts = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    same = measure(text, unit) == F.length(text)
    return let(F.struct(same.alias("same"), F.when(~same, parts).alias("parts"), F.when(~same, running_totals(
        F.transform(parts, lambda p: measure(p, unit)))).alias("totals")), with_blocks)


def ends_by_steps(text: Column, rule: Column, unit: str) -> Column:
    """A span for every end of a rule made of blocks and unbounded repeats, in about linear time.

    Steps are taken one after the other for all places of the text at once: occurrences of a block and runs of a repeated
    character are found by one pass each, and how far a rule gets is intervals of places. A chain of steps is one pass.
    """
    n = F.length(text).cast("bigint")

    def take(reached: Column, step: Column) -> Column:
        block = F.when(step["rx"] == "", reached).otherwise(
            let(spans_at_every_start(text, step["rx"], "codepoint"), lambda found: _after_block(reached, found)))
        repeat = let(find_spans(text, step["rx"], "codepoint"), lambda runs: _after_repeat(reached, runs, step["lo"], n))
        return F.when(F.size(reached) == 0, reached).when(step["lo"].isNull(), block).when(
            step["lo"] < 0, _after_chain(text, step)).otherwise(repeat).cast(REACHED)

    def spans_of(reached: Column) -> Column:
        def span(s: Column, e: Column, offset) -> Column:
            m = F.when(rule["som"], F.substring(text, (s + 1).cast("int"), (e - s).cast("int"))).otherwise(F.lit(""))
            return F.struct(offset(s).alias("s"), offset(e).alias("e"), m.alias("m"))

        return _unit_of(text, unit, lambda offset: F.flatten(F.transform(reached, lambda r: F.transform(
            F.filter(F.sequence(r["lo"], r["hi"]), lambda e: (e > r["s"]) | rule["nullable"]), lambda e: span(r["s"], e, offset)))))

    return let(F.aggregate(rule["steps"], F.lit(None).cast(REACHED), take), spans_of)


def windows(text: Column, rule: Column, unit: str) -> Column:
    """The parts of a text that hold matches of a variable-width rule.

    Each is a maximal run of characters the rule can consume, with one character of context
    before and two after, which is all that ``^ $ \\b`` look at. Structs: ``w`` window,
    ``c`` context before, ``n`` run length, ``at`` run start in `unit`. A rule that can match
    the empty text has matches anywhere, so its window is the text.
    """
    whole = F.array(F.struct(
        text.alias("w"), F.lit(0).alias("c"), F.length(text).alias("n"), F.lit(0).cast("bigint").alias("at")))

    def located(pieces: Column) -> Column:
        def of_run(i: Column, start: Column, at: Column) -> Column:
            context = F.when(start > 0, F.lit(1)).otherwise(F.lit(0))
            n = F.length(pieces[i])
            return F.struct(
                F.substring(text, (start + 1).cast("int") - context, n + context + 2).alias("w"),
                context.alias("c"), n.alias("n"), at.alias("at"))

        def runs_at(cp, at) -> Column:
            return F.when(F.size(pieces) > 1, F.transform(
                _match_numbers(pieces), lambda i: let(cp(i), lambda s: of_run(i, s, s if at is cp else at(i)))))

        return _with_offsets(pieces, "codepoint", lambda cp: runs_at(cp, cp) if unit == "codepoint" else
                             _with_offsets(pieces, unit, lambda at: runs_at(cp, at)))

    runs = let(_pieces(text, _whole_characters(text, rule["run_rx"]), "$0"), located)
    return F.when(rule["kind"] == "whole", whole).otherwise(runs)


def ends_in_window(w: Column, rule: Column, unit: str, first: Column, last: Column,
                   only_first: bool = False) -> Column:
    """A span for every offset of [first, last] at which some match ends, or the first such.

    The regex is tried against the window with a fixed number of characters left over, so it
    backtracks through all its ways to match; the shortest prefix is the leftmost start.
    """
    def ending_at(e: Column) -> Column:
        return F.concat(
            F.lit(r"(?s:\A.{"), w["c"].cast("string"), F.lit(r"}(.*?))((?:"), rule["rx"],
            F.lit(r"))(?=(?s:.{"), (F.length(w["w"]) - w["c"] - e).cast("string"), F.lit(r"})\z)"))

    def span(e: Column) -> Column:
        before = F.when(rule["som"], F.call_function("regexp_extract", w["w"], ending_at(e), F.lit(1))).otherwise(F.lit(""))
        return let(before, lambda b: F.struct(
            (w["at"] + measure(b, unit)).alias("s"),
            (w["at"] + measure(F.substring(w["w"], w["c"] + 1, e), unit)).alias("e"),
            F.when(rule["som"], F.substring(w["w"], w["c"] + 1 + F.length(b), e - F.length(b)))
            .otherwise(F.lit("")).alias("m")))

    # the whole regex is only tried where the character before the end can be a match's last one
    offsets = F.filter(F.sequence(first, last), lambda e: rule["last_rx"].isNull() | (
        (e > 0) & F.rlike(F.substring(w["w"], w["c"] + e, F.lit(1)), rule["last_rx"])))
    if not only_first:
        return F.transform(F.filter(offsets, lambda e: F.rlike(w["w"], ending_at(e))), span)
    # CASE is lazy: once an end is found, the regex is not tried again
    least = F.aggregate(offsets, F.lit(-1), lambda found, e: F.when(found >= 0, found).when(
        F.rlike(w["w"], ending_at(e)), e).otherwise(F.lit(-1)))
    return F.transform(F.filter(F.array(least), lambda e: e >= 0), span)


def first_end(rule: Column) -> Column:
    """The least end a match of the rule can have in a run."""
    return F.when(rule["nullable"], F.lit(0)).otherwise(F.lit(1))


@dataclass(frozen=True)
class Shape:
    """What kinds of rules a set holds, so that expressions for absent kinds are left out."""

    apart: bool = True
    fixed: bool = True
    steps: bool = True
    variable: bool = True
    java: bool = True
    direct: bool = True
    single: bool = True


def _case(options: list) -> Column:
    """CASE over (condition, needed, column builder); the last needed one is the default."""
    needed = [(on, build) for on, wanted, build in options if wanted]
    *conditional, (_, default) = needed
    if not conditional:
        return default()
    case = F.when(conditional[0][0], conditional[0][1]())
    for on, build in conditional[1:]:
        case = case.when(on, build())
    return case.otherwise(default())


def all_ends(text: Column, rule: Column, unit: str, shape: Shape = Shape()) -> Column:
    """A span for every offset at which the rule matches, with its leftmost start."""
    def over_windows(ws: Column) -> Column:
        def every(w: Column) -> Column:
            return ends_in_window(w, rule, unit, first_end(rule), w["n"])

        def first(w: Column) -> Column:
            return ends_in_window(w, rule, unit, first_end(rule), w["n"], only_first=True)

        found = F.flatten(F.transform(ws, every))
        if not shape.single:
            return found
        return F.when(rule["single"], F.flatten(F.transform(F.slice(ws, 1, 1), first))).otherwise(found)

    return _case([
        (rule["kind"] == "apart", shape.apart, lambda: find_spans(text, rule["rx"], unit)),
        (rule["kind"] == "fixed", shape.fixed, lambda: spans_at_every_start(text, rule["rx"], unit)),
        (rule["kind"] == "steps", shape.steps, lambda: ends_by_steps(text, rule, unit)),
        (F.lit(True), shape.variable, lambda: let(windows(text, rule, unit), over_windows)),
    ])


def spans(text: Column, rule: Column, unit: str, semantics: str | None = None, shape: Shape = Shape()) -> Column:
    """Spans of one rule in one text, under `semantics` or else those of its dialect."""
    if semantics not in (None, "find", "all_ends"):
        raise ValueError(f"unknown semantics {semantics!r}, expected 'all_ends' or 'find'")
    found = _case([
        (rule["java"], semantics == "find" or (semantics is None and shape.java),
         lambda: find_spans(text, rule["rx"], unit)),
        (~rule["java"], semantics == "all_ends" or (semantics is None and shape.direct),
         lambda: all_ends(text, rule, unit, shape)),
    ])
    # matches come in order of their ends, so the first one is the one of earliest end
    return F.when(rule["single"], F.slice(found, 1, 1)).otherwise(found) if shape.single else found
