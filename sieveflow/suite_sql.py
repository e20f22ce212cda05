"""The registered queries as SQL over the same tables, for comparison in another engine.

Written from the definition of each operator (brute force over rules, starts and ends where
the Spark side does not), with RE2 regexes of the same meaning.
"""

from __future__ import annotations

from .suite import (
    BOUNDED, BYTES, COMBINED, EVENT_COMBINED, EVENT_RULES, FLAG_CASES, GROUPS, NAMES, OPTIONAL_GROUPS, PERSONAL_DATA, QUIET_IDS, RUNS,
    SWEPT_COMBINED, SWEPT_IDS, TAG_SETS, WORDS,
)

UTF16 = "length({x}) + length(regexp_replace({x}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g'))"
CODEPOINT = "length({x})"
BYTE = "strlen({x})"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def re2(pattern: str, flags) -> str:
    options = "".join(c for f, c in (("CASELESS", "i"), ("DOTALL", "s"), ("MULTILINE", "m")) if f in flags)
    if pattern.endswith("$") and "MULTILINE" not in flags:
        pattern = pattern[:-1] + r"\n?\z"
    return f"(?{options}){pattern}" if options else pattern


def rules(triples, name="rules") -> str:
    rows = ", ".join(f"({i}, {quoted(re2(p, f))})" for i, p, f in triples)
    return f"{name}(rule_id, pat) AS (VALUES {rows})"


def hits(source: str, key: str, text: str, triples, extra="") -> str:
    return (f"WITH {rules(triples)} SELECT {key}, CAST(rule_id AS INTEGER) AS rule_id{extra} "
            f"FROM {source}, rules WHERE regexp_matches({text}, pat)")


def exists(source: str, columns: str, text: str, triples, negated=False) -> str:
    return (f"WITH {rules(triples)} SELECT {columns} FROM {source} WHERE {'NOT ' if negated else ''}EXISTS "
            f"(SELECT 1 FROM rules WHERE regexp_matches({text}, pat))")


def find(source: str, key: str, text: str, triples, length=CODEPOINT, end_shift=1) -> str:
    """All `find()` matches; a CTE body named found(key…, rule_id, start, end, matched)."""
    size, gap = length.format(x="x"), length.format(x="gap")
    return f"""{rules(triples)},
    cut AS (SELECT {key}, rule_id, regexp_extract_all({text}, pat) AS m, string_split_regex({text}, pat) AS g
            FROM {source}, rules WHERE regexp_matches({text}, pat)),
    numbered AS (SELECT {key}, rule_id, unnest(m) AS x, unnest(g[1:len(m)]) AS gap, unnest(range(len(m))) AS i FROM cut),
    placed AS (SELECT {key}, rule_id, x, sum({gap}) OVER (PARTITION BY {key}, rule_id ORDER BY i)
        + coalesce(sum({size}) OVER (PARTITION BY {key}, rule_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING
                                    AND 1 PRECEDING), 0) AS s FROM numbered),
    found AS (SELECT {key}, CAST(rule_id AS INTEGER) AS rule_id, CAST(s AS BIGINT) AS start,
        CAST(s + {size} - {end_shift} AS BIGINT) AS "end", x AS matched FROM placed)"""


def all_ends(source: str, key: str, text: str, triples) -> str:
    """Every (start, end) that the rule matches exactly, leftmost start per end. For short texts."""
    return f"""{rules(triples)},
    pairs AS (SELECT {key}, rule_id, {text} AS t, s.s, e.e FROM {source}, rules,
        LATERAL (SELECT unnest(range(0, length({text}))) AS s) s,
        LATERAL (SELECT unnest(range(1, length({text}) + 1)) AS e) e
        WHERE e.e > s.s AND regexp_full_match(substr({text}, s.s + 1, e.e - s.s), pat)),
    found AS (SELECT {key}, CAST(rule_id AS INTEGER) AS rule_id, CAST(min(s) AS BIGINT) AS start,
        CAST(e - 1 AS BIGINT) AS "end", any_value(substr(t, 1, e)) AS upto FROM pairs GROUP BY {key}, rule_id, e)"""


def all_ends_in_runs(source: str, key: str, text: str, triples, runs: dict[int, str]) -> str:
    """The same inside the runs of characters a rule can consume, for long texts."""
    run_rules = [(i, runs[i], ()) for i, _, _ in triples]

    def by_rule(function: str, value: str) -> str:
        cases = " ".join(f"WHEN {i} THEN {function}({value}, {quoted(re2(p, f))})" for i, p, f in triples)
        return f"CASE rule_id {cases} END"

    return f"""{find(source, key, text, run_rules)},
    ended AS (SELECT {key}, rule_id, start, matched, unnest(range(1, length(matched) + 1)) AS e FROM found
        WHERE {by_rule("regexp_matches", "matched")}),
    tried AS (SELECT *, unnest(range(0, e)) AS s FROM ended),
    pairs AS (SELECT {key}, rule_id, start + s AS s, start + e AS e, substr(matched, s + 1, e - s) AS matched
        FROM tried WHERE {by_rule("regexp_full_match", "substr(matched, s + 1, e - s)")})
    SELECT {key}, CAST(rule_id AS INTEGER) AS rule_id, CAST(min(s) AS BIGINT) AS start,
        CAST(e - 1 AS BIGINT) AS "end", arg_min(matched, s) AS matched FROM pairs GROUP BY {key}, rule_id, e"""


def combined(pattern: str, has: str) -> str:
    """A combination as SQL; `has` formats the test for one rule id."""
    out, digits = [], ""
    for c in pattern + " ":
        if c.isdigit():
            digits += c
            continue
        if digits:
            out.append(has.format(id=digits))
            digits = ""
        out.append({"!": " NOT ", "&": " AND ", "|": " OR "}.get(c, c))
    return "".join(out)


SHOWN = 'SELECT {key}, rule_id, start, "end", matched FROM found'
ALL = PERSONAL_DATA + WORDS
RUN_CLASSES = {1: r"[0-9.]+", 30: r"[%*]+", 31: r"[traeioun]+"}
LITERALS = {
    0: [".com"], 1: None, 2: ["licensed under", "released under"], 3: ['token = "'], 4: ["+1 ("], 5: None,
    6: ["mit license"],
}
CONV_TEXT = "(SELECT conv_id, turn, '\U0001F600 ' || text || ' \U0001D11E the' AS text FROM conversations) c"
PART_RULES = r"""part_rules AS (SELECT p_partkey, p_type, p_brand,
    CASE p_type WHEN 'ECONOMY' THEN p_name || '(' WHEN 'SMALL' THEN p_name || '++'
        WHEN 'LARGE' THEN '(' || p_name || ')\1' WHEN 'PROMO' THEN '(?:' || p_name || ')*'
        WHEN 'STANDARD' THEN '(?:' || p_name || ')*' ELSE p_name END AS pattern,
    CASE p_type WHEN 'STANDARD' THEN 'ALLOWEMPTY,UTF8' WHEN 'SMALL' THEN 'UTF8,CASELESS,UTF8' ELSE 'NO_FLAG' END AS flags
    FROM part)"""

_doc_hits = f"{rules(ALL)}, h AS (SELECT doc_id, rule_id FROM documents, rules WHERE regexp_matches(text, pat))"
_per_doc = f"""{_doc_hits}, d AS (SELECT documents.doc_id, coalesce(list(rule_id) FILTER (rule_id IS NOT NULL), []) AS ids
    FROM documents LEFT JOIN h ON h.doc_id = documents.doc_id GROUP BY documents.doc_id)"""
_combination = " UNION ALL ".join(
    f"SELECT doc_id, CAST({i} AS INTEGER) AS rule_id FROM d WHERE {combined(p, 'list_contains(ids, {id})')}"
    for i, p in COMBINED)
_candidates = " UNION ALL ".join(
    f"SELECT doc_id, CAST({i} AS INTEGER) AS rule_id, {'false' if lits is None else 'true'} AS filterable FROM documents"
    + ("" if lits is None else " WHERE " + " OR ".join(f"contains(lower(text), {quoted(w)})" for w in lits))
    for i, lits in LITERALS.items())


def _groups(source, key, text, triples, counts) -> str:
    return " UNION ALL ".join(
        f"""SELECT {key}, CAST({i} AS INTEGER) AS rule_id, CAST(pos - 1 AS INTEGER) AS match_no,
        CAST({g} AS INTEGER) AS group_no, vals[pos] AS value FROM (
            SELECT {key}, vals, unnest(range(1, len(vals) + 1)) AS pos FROM (
                SELECT {key}, regexp_extract_all({text}, {quoted(re2(p, f))}, {g}) AS vals FROM {source}))"""
        for i, p, f in triples for g in range(counts[i] + 1))


_words = """words AS (SELECT DISTINCT lower(w) AS pattern FROM (
    SELECT unnest(regexp_extract_all(text, '[A-Za-z]{9,}')) AS w FROM benchmark))"""
_event_hits = f"{rules(EVENT_RULES)}, h AS (SELECT event_id, user_id, ts, CAST(rule_id AS INTEGER) AS rule_id " \
              "FROM events, rules WHERE regexp_matches(props, pat))"
_sessions = f"""{_event_hits},
    gaps AS (SELECT event_id, user_id, ts,
        CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
    numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM gaps),
    d AS (SELECT numbered.user_id, n, min(numbered.ts) AS session_start, max(numbered.ts) + INTERVAL 2 HOUR AS session_end,
        coalesce(list(rule_id) FILTER (rule_id IS NOT NULL), []) AS ids
        FROM numbered LEFT JOIN h ON h.event_id = numbered.event_id GROUP BY numbered.user_id, n),
    closed AS (SELECT * FROM d WHERE session_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events))"""
_session_combination = " UNION ALL ".join(
    f"SELECT user_id, strftime(session_start, '%Y-%m-%d %H:%M:%S') AS session_start, CAST({i} AS INTEGER) AS rule_id "
    f"FROM closed WHERE {combined(p, 'list_contains(ids, {id})')}" for i, p in EVENT_COMBINED)
_tags = ", ".join(f"({quoted(s)}, {i}, {quoted('(?i)' + p)})" for s, i, p in TAG_SETS)
_order = 'ORDER BY "end", start, rule_id'
_visible = [r for r in ALL if r[0] not in QUIET_IDS]

ORACLE = {
    "hits_by_lang": f"WITH {rules(PERSONAL_DATA)} SELECT CAST(rule_id AS INTEGER) AS rule_id, lang, count(*) AS n_docs "
                    "FROM documents, rules WHERE regexp_matches(text, pat) GROUP BY ALL",
    "scan_hits": hits("documents", "doc_id", "text", ALL),
    "has_match": exists("documents", "doc_id, lang", "text", PERSONAL_DATA),
    "no_match": exists("documents", "doc_id, lang", "text", PERSONAL_DATA, negated=True),
    "has_match_flag": f"WITH {rules(WORDS)} SELECT page_id, EXISTS (SELECT 1 FROM rules WHERE regexp_matches(html, pat)) "
                      "AS has_match FROM pages",
    "has_match_bytes": exists("documents", "doc_id", "text", BYTES),
    "match_counts_by_lang": f"WITH {rules(ALL)} SELECT lang, CAST(rule_id AS INTEGER) AS rule_id, "
                            "CAST(sum(len(regexp_extract_all(text, pat))) AS BIGINT) AS n_matches, count(*) AS n_texts "
                            "FROM documents, rules WHERE regexp_matches(text, pat) GROUP BY ALL",
    "find_spans_codepoint": f"WITH {find('documents', 'doc_id', 'text', ALL)} {SHOWN.format(key='doc_id')}",
    "find_spans_utf16": f"WITH {find(CONV_TEXT, 'conv_id, turn', 'text', WORDS, UTF16)} {SHOWN.format(key='conv_id, turn')}",
    "find_spans_byte": f"WITH {find('conversations', 'conv_id, turn', 'text', WORDS, BYTE)} "
                       f"{SHOWN.format(key='conv_id, turn')}",
    "all_end_matches": f"""WITH {all_ends('part', 'p_partkey', 'p_name', NAMES)}
        SELECT p_partkey, rule_id, start, "end", substr(upto, start + 1) AS matched FROM found""",
    "all_end_matches_documents": f"WITH {all_ends_in_runs('documents', 'doc_id', 'text', RUNS, RUN_CLASSES)}",
    "all_end_matches_spread": f"WITH {all_ends_in_runs('documents', 'doc_id', 'text', RUNS, RUN_CLASSES)}",
    "single_match": f"""WITH {all_ends('part', 'p_partkey', 'p_name', NAMES)}
        SELECT p_partkey, rule_id, arg_min(start, "end") AS start, min("end") AS "end",
            arg_min(substr(upto, start + 1), "end") AS matched FROM found GROUP BY p_partkey, rule_id""",
    "matches_as_list": f"WITH {rules(PERSONAL_DATA)} SELECT doc_id, CAST(sum(len(regexp_extract_all(text, pat))) AS INTEGER) "
                       "AS n_matches FROM documents, rules GROUP BY doc_id",
    "ordered_matches": f"WITH {find('documents', 'doc_id', 'text', PERSONAL_DATA, UTF16)} SELECT doc_id, "
                       f"CAST(row_number() OVER (PARTITION BY doc_id {_order}) - 1 AS INTEGER) AS seq, rule_id, start, "
                       '"end", matched FROM found',
    "first_k": f"WITH {find('conversations', 'conv_id, turn', 'text', WORDS, UTF16)} SELECT conv_id, turn, rule_id, start, "
               f'"end", matched FROM found QUALIFY row_number() OVER (PARTITION BY conv_id, turn {_order}) <= 3',
    "take_until": f"WITH {find('conversations', 'conv_id, turn', 'text', WORDS, UTF16)} SELECT conv_id, turn, rule_id, "
                  'start, "end", matched FROM found QUALIFY coalesce(sum(CASE WHEN rule_id = 10 THEN 1 ELSE 0 END) OVER '
                  f"(PARTITION BY conv_id, turn {_order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0",
    "selected_matches": f"WITH {find('documents', 'doc_id', 'text', ALL)} {SHOWN.format(key='doc_id')} "
                        "WHERE \"end\" - start >= 11 AND matched[1] = 'T'",
    "combination": f"WITH {_per_doc} {_combination}",
    "hits_per_text": f"WITH {_per_doc} SELECT doc_id, array_to_string(list_sort(ids), ',') AS hits FROM d",
    "quiet": f"WITH {_per_doc}, {rules(_visible, 'visible')} SELECT doc_id, CAST(rule_id AS INTEGER) AS rule_id, "
             "CAST(len(regexp_extract_all(text, pat)) AS BIGINT) AS n_matches FROM documents, visible "
             f"WHERE regexp_matches(text, pat) UNION ALL SELECT doc_id, rule_id, 1 AS n_matches FROM ({_combination})",
    "prefilter_candidates": _candidates,
    "prefilter_confirmed": hits("documents", "doc_id", "text", PERSONAL_DATA),
    "full_matches": f"WITH {rules(NAMES)} SELECT p_partkey, CAST(rule_id AS INTEGER) AS rule_id FROM part, rules "
                    "WHERE regexp_full_match(p_name, pat)",
    "capture_groups": _groups("documents", "doc_id", "text", GROUPS, {0: 2, 1: 3, 2: 1}),
    "capture_groups_events": _groups("events", "event_id", "props", [(0, r'"k": (\d)(\d?)', ())], {0: 2}),
    "any_match_alternation": exists("documents", "doc_id", "text", PERSONAL_DATA),
    "byte_scan": f"WITH {find('conversations', 'conv_id, turn', 'text', BYTES, BYTE, end_shift=0)} "
                 'SELECT conv_id, turn, rule_id, start, "end" FROM found',
    "byte_slice_scan": f"""WITH {all_ends("(SELECT page_id, substr(url, 5, 30) AS u FROM pages)", 'page_id', 'u',
                                          [(0, 'a[a-z]', ()), (1, '[0-9]+/', ())])}
        SELECT page_id, rule_id, start, "end" + 1 AS "end" FROM found""",
    "flag_matrix": hits("documents", "doc_id", "text", FLAG_CASES),
    "java_flag_matrix": hits("documents", "doc_id", "text", [
        (0, "the (of|and)", ()), (1, "the (of|and)", ["CASELESS"]), (2, "^the", ["CASELESS", "MULTILINE"]),
        (3, r"re\..Th", ["DOTALL"]), (4, r"\+1 \(", ()), (5, "licensedunder", ["CASELESS"])]),
    "rule_lookup": f"WITH {_doc_hits}, p(rule_id, pattern) AS (VALUES "
                   + ", ".join(f"({i}, {quoted(p)})" for i, p, _ in ALL)
                   + ") SELECT CAST(h.rule_id AS INTEGER) AS rule_id, doc_id, pattern FROM "
                     "(SELECT doc_id, CASE WHEN rule_id = 5 THEN 99 ELSE rule_id END AS rule_id FROM h) h "
                     "LEFT JOIN p ON p.rule_id = h.rule_id",
    "multi_ruleset": f"WITH rules(ruleset, rule_id, pat) AS (VALUES {_tags}) SELECT page_id, ruleset, "
                     "CAST(rule_id AS INTEGER) AS rule_id, CAST(len(regexp_extract_all(html, pat)) AS BIGINT) AS n_matches "
                     "FROM pages, rules WHERE regexp_matches(html, pat)",
    "many_rules": f"WITH {_words} SELECT doc_id, pattern FROM documents, words WHERE contains(lower(text), pattern)",
    "many_rules_joined": f"WITH {_words} SELECT doc_id, pattern FROM documents, words WHERE contains(lower(text), pattern)",
    "many_rules_any_match": f"WITH {_words} SELECT doc_id FROM documents WHERE EXISTS "
                            "(SELECT 1 FROM words WHERE contains(lower(text), pattern))",
    "validate_rules": """SELECT CAST(p_partkey AS INTEGER) AS rule_id, p_type IN ('MEDIUM', 'STANDARD') AS is_valid,
        CASE p_type WHEN 'ECONOMY' THEN 'not a well-formed regex' WHEN 'SMALL' THEN 'possessive quantifiers are not supported'
            WHEN 'LARGE' THEN 'back-references are not supported'
            WHEN 'PROMO' THEN 'matches the empty text, which needs ALLOWEMPTY' END AS error FROM part""",
    "duplicate_rule_ids": "SELECT p_brand AS ruleset, p_size AS rule_id, count(*) AS count FROM part GROUP BY ALL HAVING count(*) > 1",
    "positional_ids": "SELECT p_brand AS ruleset, CAST(p_partkey AS INTEGER) AS pos, "
                      "CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS INTEGER) AS rule_id FROM part",
    "ruleset_roundtrip": f"WITH {PART_RULES} SELECT CAST(p_partkey AS INTEGER) AS rule_id, pattern, flags, "
                         "'direct' AS dialect, p_brand AS ruleset FROM part_rules",
    "flag_bits": "SELECT CAST(p_partkey AS INTEGER) AS rule_id, CAST(CASE p_type WHEN 'STANDARD' THEN 48 "
                 "WHEN 'SMALL' THEN 33 ELSE 0 END AS INTEGER) AS flag_bits FROM part",
    "normalized_rules": "SELECT CAST(p_partkey AS INTEGER) AS rule_id, CASE p_type WHEN 'STANDARD' THEN 'ALLOWEMPTY,UTF8' "
                        "WHEN 'SMALL' THEN 'CASELESS,UTF8' ELSE '' END AS flags FROM part",
    "ruleset_diff": """SELECT CAST(p_partkey AS INTEGER) AS rule_id,
        CASE p_type WHEN 'SMALL' THEN 'added' WHEN 'LARGE' THEN 'removed' ELSE 'changed' END AS change,
        CASE WHEN p_type <> 'SMALL' THEN p_name END AS old_pattern,
        CASE p_type WHEN 'LARGE' THEN NULL WHEN 'PROMO' THEN p_name || '|' || p_brand ELSE p_name END AS new_pattern
        FROM part WHERE p_type IN ('SMALL', 'LARGE', 'PROMO')""",
    "offset_conversion": """WITH chars AS (SELECT conv_id, turn, text, i, strlen(text[1:i]) AS upto FROM (
            SELECT conv_id, turn, text, unnest(range(1, length(text) + 1)) AS i FROM conversations))
        SELECT c.conv_id, c.turn, CAST(strlen(c.text[1:length(c.text) // 2]) AS BIGINT) AS byte_offset,
            CAST(length(c.text) // 2 AS BIGINT) AS utf16_offset,
            CAST((SELECT min(i) - 1 FROM chars k WHERE k.conv_id = c.conv_id AND k.turn = c.turn
                AND k.upto > strlen(c.text) // 2) AS BIGINT) AS char_at_half FROM conversations c""",
    "clean_utf8_prefixes": """WITH chars AS (SELECT conv_id, turn, strlen(text[1:i]) AS upto FROM (
            SELECT conv_id, turn, text, unnest(range(0, length(text) + 1)) AS i FROM conversations))
        SELECT c.conv_id, c.turn, EXISTS (SELECT 1 FROM chars k WHERE k.conv_id = c.conv_id AND k.turn = c.turn
            AND k.upto = strlen(c.text) // 2) AS clean FROM conversations c""",
    "stream_scan": hits("documents", "doc_id", "text", ALL),
    "stream_spans": f"WITH {find('documents', 'doc_id', 'text', PERSONAL_DATA)} {SHOWN.format(key='doc_id')}",
    "stream_single_alert": f"WITH {_event_hits} SELECT DISTINCT user_id, rule_id FROM h",
    "windowed_matches": f"""WITH {_event_hits}, w AS (SELECT date_trunc('hour', ts) AS ws, rule_id, count(*) AS n_hits FROM h GROUP BY ALL)
        SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, rule_id, n_hits FROM w
        WHERE ws + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM h)""",
    "session_combination": f"WITH {_sessions} {_session_combination}",
    "windowed_matches_whole": f"""WITH {_event_hits} SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
        rule_id, count(*) AS n_hits FROM h GROUP BY ALL""",
    "session_combination_whole": f"WITH {_sessions} {_session_combination}".replace("FROM closed", "FROM d"),
}
_thirds = "CASE WHEN doc_id % 3 > 0 THEN doc_id % 3 END AS doc_id"
ORACLE["large_no_match"] = exists("documents", f"{_thirds}, lang", "text", PERSONAL_DATA, negated=True)
ORACLE["large_flag"] = f"WITH {rules(PERSONAL_DATA)} SELECT {_thirds}, lang, EXISTS (SELECT 1 FROM rules WHERE " \
                       "regexp_matches(text, pat)) AS has_match FROM documents"
ORACLE["untracked_starts"] = f"WITH {find('documents', 'doc_id', 'text', PERSONAL_DATA, UTF16)} SELECT doc_id, rule_id, " \
                             "CAST(0 AS BIGINT) AS start, \"end\", '' AS matched FROM found"
ORACLE["saved_rules_scan"] = hits("documents", "doc_id", "text", PERSONAL_DATA)
ORACLE["large_combination"] = ORACLE["combination"]
ORACLE["large_first_k"] = ORACLE["first_k"]
ORACLE["stream_large_hits"] = ORACLE["stream_scan"]
# line by line: a.*x ends at each x behind the first a; ^.*the.*and.*$ is all of a line, or of a text
ORACLE["all_end_matches_repeats"] = """
    WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
            generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
    placed AS (SELECT doc_id, line, strpos(line, 'a') AS a, CAST(coalesce(sum(length(line) + 1) OVER (
            PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off FROM lines),
    ends AS (SELECT *, unnest(range(a + 1, length(line) + 1)) AS e FROM placed WHERE a > 0)
    SELECT doc_id, CAST(40 AS INTEGER) AS rule_id, off + a - 1 AS start, off + e - 1 AS "end", substr(line, a, e - a + 1) AS matched
        FROM ends WHERE substr(line, e, 1) = 'x'
    UNION ALL SELECT doc_id, 41, off, off + length(line) - 1, line FROM placed WHERE regexp_matches(line, 'the.*and')
    UNION ALL SELECT doc_id, 42, 0, length(text) - 1, text FROM documents WHERE regexp_matches(text, '(?s)the.*and')
    UNION ALL SELECT doc_id, 42, 0, length(text) - 2, text[1:length(text) - 1] FROM documents
        WHERE regexp_matches(text, '(?s)the.*and') AND ends_with(text, chr(10))"""
_swept = [r for r in ALL if r[0] in SWEPT_IDS]
_swept_events = " UNION ALL ".join(
    f"""SELECT doc_id, CAST({i} AS INTEGER) AS rule_id, e AS "end", holds FROM (SELECT doc_id, e,
        {combined(p, "list_contains(now, {id})")} AS holds, e IS NOT NULL AND {"(" + combined(p, "list_contains(before, {id})") + ")"} AS held
        FROM places) WHERE holds <> held""" for i, p in SWEPT_COMBINED)
# the first match of these rules is also the one of earliest end
ORACLE["combination_events"] = f"""WITH {rules(_swept)},
    firsts AS (SELECT doc_id, rule_id, CAST(length(string_split_regex(text, pat)[1]) + length(regexp_extract(text, pat)) - 1 AS BIGINT) AS e
        FROM documents, rules WHERE regexp_matches(text, pat)),
    swept AS (SELECT DISTINCT doc_id, e FROM firsts UNION ALL SELECT doc_id, NULL FROM documents),
    places AS (SELECT s.doc_id, s.e, coalesce(list(rule_id) FILTER (f.e <= s.e), []) AS now,
        coalesce(list(rule_id) FILTER (f.e < s.e), []) AS before
        FROM swept s LEFT JOIN firsts f ON f.doc_id = s.doc_id GROUP BY s.doc_id, s.e)
    {_swept_events}"""
# (group, where it begins in the match, its length or NULL), from the shape of each rule
_group_places = {
    0: ["(1, 0, strpos(m, '@') - 1)", "(2, strpos(m, '@'), length(m) - strpos(m, '@') - 4)"],
    1: ["(1, 4, 3)", "(2, 9, 3)", "(3, 13, 4)"],
    2: ["(1, 0, length(m) - 6)"],
    3: ["(1, 2, CASE WHEN m[3] = 'e' THEN 1 END)", "(2, CASE WHEN m[3] = 'e' THEN 3 ELSE 2 END, CASE WHEN right(m, 1) IN ('s', 'r') THEN 1 END)"],
    4: ["(1, 0, 3)", "(2, 0, CASE WHEN m[1] = 'T' THEN 1 END)", "(3, 0, CASE WHEN m[1] = 'A' THEN 1 END)",
        "(4, 4, CASE WHEN length(m) > 4 THEN 2 END)", "(5, 5, CASE WHEN length(m) > 4 THEN 1 END)"],
}
ORACLE["group_spans"] = f"""WITH {find('documents', 'doc_id', 'text', OPTIONAL_GROUPS)},
    numbered_matches AS (SELECT doc_id, rule_id, start AS s, matched AS m,
        CAST(row_number() OVER (PARTITION BY doc_id, rule_id ORDER BY start) - 1 AS INTEGER) AS match_no FROM found),
    g AS (SELECT doc_id, rule_id, match_no, s, m, 0 AS group_no, 0 AS off, length(m) AS size FROM numbered_matches UNION ALL """ + " UNION ALL ".join(
    f"SELECT doc_id, rule_id, match_no, s, m, v.* FROM numbered_matches, LATERAL (SELECT * FROM (VALUES {', '.join(places)})) v(group_no, off, size) "
    f"WHERE rule_id = {i}" for i, places in _group_places.items()) + """)
    SELECT doc_id, rule_id, match_no, CAST(group_no AS INTEGER) AS group_no, CAST(CASE WHEN size IS NOT NULL THEN s + off END AS BIGINT) AS start,
        CAST(s + off + size AS BIGINT) AS "end", substr(m, CAST(off + 1 AS BIGINT), CAST(size AS BIGINT)) AS value FROM g"""
ORACLE["reloaded_rules_scan"] = hits("documents", "doc_id", "text", ALL)
# rows of a text file end with a line feed, which no rule matches: what texts hold is what files hold
_bounded = {i: (p, f) for i, p, f in BOUNDED}
ORACLE["file_blocks_scan"] = f"""WITH ends AS (WITH {all_ends_in_runs('documents', 'doc_id', 'text', [r for r in BOUNDED if r[0] == 52], {52: RUN_CLASSES[1]})})
    SELECT CAST(52 AS INTEGER) AS rule_id, count(*) AS n_matches, CAST(sum("end" - start + 1) AS BIGINT) AS n_bytes FROM ends HAVING count(*) > 0
    UNION ALL SELECT 51, CAST(sum(n) AS BIGINT), CAST(sum(16 * n) AS BIGINT) FROM (SELECT length(unnest(regexp_extract_all(text, '[0-9]{{16,}}'))) - 15 AS n FROM documents)
        HAVING count(*) > 0
    """ + " ".join(f"""UNION ALL SELECT {i}, CAST(sum(n) AS BIGINT), {"NULL" if i == 53 else f"CAST(sum({size} * n) AS BIGINT)"}
        FROM (SELECT len(regexp_extract_all(text, {quoted(re2(*_bounded[i]))})) AS n FROM documents) HAVING sum(n) > 0""" for i, size in ((50, 3), (53, 0), (54, 3)))
ORACLE["single_match_flag"] = ORACLE["single_match"]
ORACLE["empty_matches"] = """WITH ends AS (SELECT p_partkey, p_name, unnest(range(0, length(p_name) + 1)) AS e FROM part),
    found AS (SELECT p_partkey, e, regexp_extract(substr(p_name, 1, e), '[aeiou]*$') AS matched FROM ends)
    SELECT p_partkey, CAST(60 AS INTEGER) AS rule_id, CAST(e - length(matched) AS BIGINT) AS start, CAST(greatest(e - 1, 0) AS BIGINT) AS "end",
        matched, matched = '' AS is_empty FROM found"""
ORACLE["unicode_classes"] = hits("documents", "doc_id", "text", [
    (61, r"(^|[^\p{L}\p{N}\p{M}_])é[\p{L}\p{N}\p{M}_]+", ()), (62, r"(^|[^\p{L}\p{N}\p{M}_])[Éé][\p{L}\p{N}\p{M}_]+", ()),
    (63, r"(?s)\p{Nd}[^\p{L}\p{N}\p{M}_][\p{L}\p{N}\p{M}_]", ())])
_every_end = all_ends("part", "p_partkey", "p_name", NAMES)
ORACLE["match_counts_own"] = f"""WITH {_every_end}, branded AS (SELECT p_brand, rule_id, found.p_partkey FROM found JOIN part ON part.p_partkey = found.p_partkey)
    SELECT p_brand, rule_id, count(*) AS n_matches, count(DISTINCT p_partkey) AS n_texts, false AS single FROM branded GROUP BY ALL
    UNION ALL SELECT p_brand, rule_id, count(DISTINCT p_partkey), count(DISTINCT p_partkey), true FROM branded GROUP BY ALL"""
_found = f"WITH {find('documents', 'doc_id', 'text', PERSONAL_DATA)}"
ORACLE["handled_matches"] = f"{_found} SELECT count(*) AS n_matches, CAST(sum(length(matched)) AS BIGINT) AS n_chars FROM found"
ORACLE["listed_matches"] = f"""{_found} SELECT d.doc_id, coalesce(string_agg(rule_id || '|' || start || '|' || "end" || '|' || matched, chr(10) ORDER BY rule_id, start), '')
    AS matches FROM documents d LEFT JOIN found f ON f.doc_id = d.doc_id GROUP BY d.doc_id"""
_tag_rules = [(n, "(?i)" + p, ()) for n, (_, _, p) in enumerate(TAG_SETS)]
_tag_names = ", ".join(f"({n}, {quoted(s)}, {i})" for n, (s, i, _) in enumerate(TAG_SETS))
ORACLE["ordered_tags"] = f"""WITH {find('pages', 'page_id', 'html', _tag_rules)}, names(n, ruleset, id) AS (VALUES {_tag_names})
    SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY "end", start, id, ruleset) - 1 AS INTEGER) AS seq, ruleset,
        CAST(id AS INTEGER) AS rule_id, start, "end", matched FROM found JOIN names ON n = rule_id"""
ORACLE["candidate_tags"] = f"""WITH r(ruleset, rule_id, pat) AS (VALUES {_tags}), found AS (
        SELECT page_id, ruleset, CAST(rule_id AS INTEGER) AS rule_id FROM pages, r WHERE regexp_matches(html, pat))
    SELECT *, 'confirmed' AS kind FROM found UNION ALL SELECT page_id, ruleset, CAST(rule_id AS INTEGER), 'candidate' FROM pages, r
    WHERE contains(lower(html), CASE pat WHEN '(?i)https?://' THEN 'http' ELSE substr(pat, 5) END)"""
ORACLE["ruleset_problems"] = """WITH r AS (SELECT p_brand AS ruleset, CASE p_type WHEN 'PROMO' THEN NULL WHEN 'SMALL' THEN -p_partkey
            WHEN 'LARGE' THEN p_size ELSE p_partkey + 1000 END AS id FROM part)
    SELECT ruleset, 'some rules have an id and some have none' AS problem, count(*) - count(id) AS n FROM r GROUP BY ruleset HAVING count(id) > 0 AND count(id) < count(*)
    UNION ALL SELECT ruleset, 'negative rule id', count(*) FROM r WHERE id < 0 GROUP BY ruleset
    UNION ALL SELECT ruleset, 'duplicate rule ids', count(id) - count(DISTINCT id) FROM r GROUP BY ruleset HAVING count(id) > count(DISTINCT id)"""
ORACLE["equal_rulesets"] = "SELECT p_brand AS ruleset, bool_and(p_partkey % 50 <> 7) AS same FROM part GROUP BY p_brand"
ORACLE["rule_counts"] = "SELECT p_brand AS ruleset, count(*) AS n_rules FROM part GROUP BY p_brand"
ORACLE["cleaned_prefixes"] = """WITH chars AS (SELECT conv_id, turn, text, strlen(text) // 2 AS half, unnest(range(0, length(text) + 1)) AS i FROM conversations),
    kept AS (SELECT conv_id, turn, any_value(text) AS text, any_value(half) AS half, max(i) FILTER (strlen(text[1:i]) <= half) AS k FROM chars GROUP BY conv_id, turn)
    SELECT conv_id, turn, text[1:k] || CASE WHEN strlen(text[1:k]) < half THEN chr(65533) ELSE '' END AS cleaned FROM kept"""
ORACLE["prefilter_factors"] = " UNION ALL ".join(
    f"SELECT doc_id, CAST({i} AS INTEGER) AS rule_id, true AS filterable FROM documents WHERE "
    + " AND ".join(f"contains(lower(text), {quoted(w)})" for w in words)
    for i, words in ((70, ["the", "license"]), (71, ["ing ", "tion", ".com"]), (72, ["user", "@example.com"])))
ORACLE["stream_alerts_once"] = ORACLE["stream_single_alert"]
