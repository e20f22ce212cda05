"""The registered queries of the corpus operators and the SQL of those that SQL can express."""

from __future__ import annotations

import base64

from pyspark.sql import DataFrame, SparkSession, functions as F

from .attention_lm import Vocabulary, log_probabilities
from .common import shared_folder, table
from .exact_dedup import exact_groups
from .html_text import extract
from .mixing import mix
from .pieces import decode, encode, read_model
from .prefix_trie import prefix_trie
from .quality_bayes import quality_scores
from .quality_rules import quality
from .simhash import near_groups
from .suffix_dedup import remove_repeated
from .token_files import count_tokens, read_ranks, write_token_files
from .toxicity import fit, scores
from .vector_codes import ENTRIES, PARTS, ROUNDS, SCALE, compress

# where the vocabularies of public tokenizers lie; they are read from there and never copied
TOKENIZERS = "/opt/tokenizers"
RANKS = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
MULTILINGUAL_RANKS = f"{TOKENIZERS}/byte_bpe_multi_50k.tiktoken"
END_OF_DOCUMENT = 50256
# fixed value: how this vocabulary parts a text before merging
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PIECES = f"{TOKENIZERS}/piece_bpe_32k.model"


def op1_quality_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' sources are the hosts, the languages within a source its paths."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as flat token files, and their documents counted from these files alone."""
    path = shared_folder(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), path, read_ranks(RANKS), PATTERN, END_OF_DOCUMENT)
    return count_tokens(spark, path, END_OF_DOCUMENT)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"), keep="largest")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = remove_repeated(table(spark, sf_dir, "documents"))
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
                          (F.col("n_bytes") - F.col("n_removed")).alias("n_kept"), F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the ids, their number, and the digest of the text that they decode to."""
    model = read_model(PIECES)
    decoded = decode(encode(table(spark, sf_dir, "documents"), model), model, text_col="decoded")
    return decoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scores(docs, fit(docs, table(spark, sf_dir, "labels")))


def byte_pairs(ranks: bytes, pattern: str) -> Vocabulary:
    """A vocabulary of ranked byte pairs; words are encoded with a space before each.

    The pattern attaches a space to what follows it and parts at white space, so all words are encoded in one call, and a word
    begins at each id that begins with a space. Only words that hold other white space are encoded each for itself.
    """
    def pairs() -> dict[bytes, int]:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}

    def load():
        import numpy as np
        import tiktoken
        known = pairs()
        encode = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=known, special_tokens={}).encode_ordinary
        begins = np.zeros(max(known.values()) + 1, dtype=bool)
        begins[[i for b, i in known.items() if b.startswith(b" ")]] = True

        def ids_of(words: list[str]):
            joined = " " + " ".join(words)
            if len(joined.split()) != len(words):
                parts = [encode(" " + w) for w in words]
                return np.array([i for p in parts for i in p], dtype=np.int32), np.array([len(p) for p in parts])
            ids = np.array(encode(joined) if words else [], dtype=np.int32)
            return ids, np.diff(np.append(np.flatnonzero(begins[ids]), len(ids)))

        return ids_of

    ids = {i: b for b, i in pairs().items()}
    end = max(ids) + 1
    return Vocabulary(load, end, [ids.get(i, b"") for i in range(end)])


def op11_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_probabilities(table(spark, sf_dir, "documents"), byte_pairs(read_ranks(MULTILINGUAL_RANKS), PATTERN))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, rebuilt so that many share their beginnings."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_quality_bayes, op2_token_counts, op3_exact_dedup, op4_html_text, op5_suffix_dedup, op6_sentencepiece, op7_simhash, op8_mixing,
    op9_quality_rules, op10_toxicity, op11_language_model, op12_prefix_trie, op13_vector_codes)}


def _vector_codes_sql() -> str:
    """Lloyd rounds entry by entry; |x|^2 - 2 x.c + |c|^2 is exact in doubles, as all numbers are integers below 2^53."""
    def nearest(books: str) -> str:
        return f"""SELECT part, id, any_value(x) AS x, min({{'d': list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c),
            'e': entry}}) AS best FROM p JOIN {books} USING (part) GROUP BY part, id"""

    steps = [f"""v AS (SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label,
            list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * {SCALE})) AS v, len(embedding) // {PARTS} AS size
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"p AS (SELECT id, part, v[part * size + 1 : (part + 1) * size] AS x FROM v, range({PARTS}) r(part))",
             f"c0 AS (SELECT part, id - 1 AS entry, x AS c FROM p WHERE id <= {ENTRIES})"]
    for i in range(ROUNDS):
        steps.append(f"a{i} AS ({nearest(f'c{i}')})")
        steps.append(f"""c{i + 1} AS (SELECT part, entry, coalesce(m, c) AS c FROM c{i} LEFT JOIN (
            SELECT part, e AS entry, list(f ORDER BY pos) AS m FROM (
                SELECT part, e, pos, floor(sum(val) / count(*)) AS f FROM (
                    SELECT part, best.e AS e, unnest(x) AS val, generate_subscripts(x, 1) AS pos FROM a{i}) GROUP BY part, e, pos)
            GROUP BY part, e) USING (part, entry))""")
    return f"""WITH {", ".join(steps)}, final AS ({nearest(f"c{ROUNDS}")}),
        coded AS (SELECT id, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
            FROM final GROUP BY id),
        book AS (SELECT sha256(string_agg(CAST(CAST(val AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256
            FROM (SELECT part, entry, unnest(c) AS val, generate_subscripts(c, 1) AS pos FROM c{ROUNDS}))
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256, label
        FROM coded JOIN v USING (id), book"""


# all beginnings as strings: turns are told apart by their digests, beginnings by the digest of these
PREFIX_TRIE_SQL = """
    WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
            lambda z, k: xor(z >> 1, (z & 1) * 3988292384))) AS t),
    turns AS (SELECT conv_id, length(coalesce(text, '')) AS chars,
            md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d, turn
        FROM conversations WHERE conv_id IS NOT NULL),
    placed AS (SELECT conv_id, d, chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) - 1 AS pos FROM turns),
    convs AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(list_prepend(4294967295, list_transform(
            string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
            lambda z, b: xor(z >> 8, t[(xor(z, b) & 255) + 1])), 4294967295) % 6 AS h
        FROM (SELECT DISTINCT conv_id FROM turns), tab),
    rebuilt AS (
        SELECT c.conv_id, p.pos, d, chars FROM convs c JOIN placed p ON p.conv_id = c.base AND p.pos < c.h
        UNION ALL SELECT c.conv_id, p.pos, d, chars FROM convs c JOIN placed p ON p.conv_id = c.conv_id AND p.pos >= c.h),
    paths AS (
        SELECT conv_id, row_number() OVER w AS depth, chars, md5(string_agg(d, '') OVER w) AS node,
            coalesce(md5(string_agg(d, '') OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), '') AS up
        FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        UNION ALL SELECT conv_id, 0, 0, '', NULL FROM convs),
    longest AS (SELECT conv_id, max(depth) AS n FROM paths GROUP BY conv_id),
    nodes AS (SELECT node, depth, min(p.conv_id) AS conv_id, any_value(up) AS up, count(*) AS n_convs, any_value(chars) AS chars,
            coalesce(string_agg(CASE WHEN depth = n THEN CAST(p.conv_id AS VARCHAR) END, ',' ORDER BY p.conv_id), '') AS ends
        FROM paths p JOIN longest l ON l.conv_id = p.conv_id GROUP BY node, depth),
    kids AS (SELECT up, count(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY up),
    full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids ON kids.up = nodes.node),
    below AS (SELECT a.node, sum((w.n_convs - 1) * w.chars) AS saved, sum(CASE WHEN w.n_children = 0 THEN 1 ELSE 0 END) AS leaves
        FROM full_nodes w JOIN paths a ON a.conv_id = w.conv_id AND a.depth <= w.depth GROUP BY a.node)
    SELECT f.conv_id, f.depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, CAST(leaves AS BIGINT) AS n_leaves,
        CAST(saved AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
    FROM full_nodes f JOIN below USING (node) LEFT JOIN nodes q ON q.node = f.up"""

ORACLE = {
    "op3_exact_dedup": """
        WITH d AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
            FROM documents),
        g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
        FROM d JOIN g USING (norm)""",
    "op12_prefix_trie": PREFIX_TRIE_SQL,
    "op13_vector_codes": _vector_codes_sql(),
}
