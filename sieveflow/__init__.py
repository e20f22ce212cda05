"""Scanning tables and streams of text against large sets of regular expressions, on Spark."""

from .operators.combine import combination_events, combinations, rule_hits_per_text
from .operators.files import scan_files
from .operators.hits import any_match, hits, lookup_rules, no_match, with_has_match
from .operators.order import first_k, match_counts, ordered_matches, take_until
from .operators.prefilter import any_match_alternation, candidates, capture_groups, confirmed, group_spans
from .operators.rulesets import rule_count, rule_counts, ruleset_diff, same_rules, same_rulesets, with_flag_bits
from .operators.scan import matches_per_text, scan, single_matches
from .operators.validate import RuleError, check_ruleset, ruleset_problems, set_apart_slow, validate_rules
from .plans.compiled import CompiledRules, choose_factors, compile_rules, load_compiled, save_compiled
from .sources.blocks import read_byte_blocks
from .sources.inputs import byte_slice, read_blobs, read_table
from .sources.rules import (
    load_rules, rule, rules_from_df, rules_from_regex, rules_table, save_rules, with_positional_ids,
)
from .sources.sinks import for_each_match, work_folder, write_matches

__all__ = [
    "CompiledRules", "RuleError", "any_match", "any_match_alternation", "byte_slice", "candidates",
    "capture_groups", "check_ruleset", "choose_factors", "combination_events", "combinations", "compile_rules", "confirmed", "first_k",
    "for_each_match", "group_spans", "hits", "load_compiled", "load_rules", "lookup_rules", "match_counts", "matches_per_text",
    "no_match", "ordered_matches", "read_blobs", "read_byte_blocks", "read_table", "rule", "rule_count", "rule_counts",
    "rule_hits_per_text", "rules_from_df", "rules_from_regex", "rules_table", "ruleset_diff", "ruleset_problems",
    "same_rules", "same_rulesets", "save_compiled", "save_rules", "scan", "scan_files", "set_apart_slow", "single_matches", "take_until", "validate_rules",
    "with_flag_bits", "with_has_match", "with_positional_ids", "work_folder", "write_matches",
]
