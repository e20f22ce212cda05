"""Files in blocks against the same files as one value."""

import os
import random
import re

import pytest

from sieveflow import compile_rules, read_byte_blocks, rule, rules_table, scan_files, work_folder

SOM = "SOM_LEFTMOST"
RULES = [
    rule("ab{1,3}c", SOM, 0), rule(r"\xff\x00[\x00-\x20]?", SOM, 1), rule(r"\bxy\b", SOM, 2), rule("needle in a haystack", ["CASELESS"], 3),
    rule("a", [SOM, "SINGLEMATCH"], 4), rule(r"(?:\d{1,2}\.){2}\d", SOM, 5), rule("a\nb", SOM, 6),
]
PYTHON = {0: rb"ab{1,3}c", 1: rb"\xff\x00[\x00-\x20]?", 2: rb"(?<!\w)xy(?!\w)", 3: rb"(?i)needle in a haystack", 4: b"a", 5: rb"(?:\d{1,2}\.){2}\d", 6: b"a\nb"}
BOM = b"\xef\xbb\xbf"


def contents(rng: random.Random) -> dict[str, bytes]:
    words = [b"abbc", b"xy", b" ", b"\n", b"Needle in a haystack", b"\xff\x00\x07", b"12.3.4", b"\xc3\xa9", b"a\nb", b"_", b"\r\n"]
    made = {f"f{i}": b"".join(rng.choice(words) for _ in range(rng.randrange(400))) for i in range(6)}
    return made | {"empty": b"", "lines": b"\n" * 50, "bom": BOM + b"abc\nabbc", "bom_end": BOM + b"a\n", "long": b"q" * 5000 + b"abbbc" + b"\0" * 70}


@pytest.fixture(scope="module")
def files(spark):
    path = work_folder(spark, "bytes")
    os.makedirs(path)
    made = contents(random.Random(3))
    for name, data in made.items():
        with open(f"{path}/{name}", "wb") as f:
            f.write(data)
    return path, made


@pytest.mark.parametrize("split", ["64", "128m"])
def test_blocks_hold_all_bytes(spark, files, split):
    path, made = files
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = read_byte_blocks(spark, path, 100, before=7, after=3).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {(os.path.basename(r.path), r.block): (r.at, bytes(r.data)) for r in rows}
    want = {(n, k): (max(k * 100 - 7, 0), d[max(k * 100 - 7, 0): k * 100 + 103]) for n, d in made.items() for k in range(-(-len(d) // 100))}
    assert got == want


def test_scan_is_that_of_whole_files(spark, files):
    path, made = files
    want = set()
    for name, data in made.items():
        for i, p in PYTHON.items():
            rx, found = re.compile(p), []
            for e in range(1, len(data) + 1):
                starts = [s for s in range(max(0, e - 25), e) if rx.fullmatch(data, s, e) and (
                    i != 2 or not re.match(rb"\w", data[s - 1:s] or b" ") and not re.match(rb"\w", data[e:e + 1] or b" "))]
                found += [(name, i, 0 if i == 3 else starts[0], e)] if starts else []
            want |= set(found[:1] if i == 4 else found)
    for bounds in ({}, {"max_rules": 0}):
        compiled = compile_rules(rules_table(spark, RULES), **bounds)
        rows = scan_files(spark, path, compiled, block_bytes=64).collect()
        assert len(rows) == len(want) > 100
        assert {(os.path.basename(r.path), r.rule_id, r.start, r.end) for r in rows} == want


@pytest.mark.parametrize("refused", [rule("ab*", (), 7), rule("^a", (), 7), rule("é", ["UTF8"], 7), rule("a", (), 7, dialect="java"), rule("0", "COMBINATION", 7)])
def test_rules_that_need_a_whole_text_are_named(spark, files, refused):
    compiled = compile_rules(rules_table(spark, [rule("x", (), 0), refused]))
    with pytest.raises(ValueError, match="7: "):
        scan_files(spark, files[0], compiled)
