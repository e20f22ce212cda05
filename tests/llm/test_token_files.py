import base64
import os
from collections import Counter

import numpy as np
import pytest

from helpers import ODD, empty_docs, odd_docs
from sieveflow.llm.queries import END_OF_DOCUMENT, PATTERN, RANKS
from sieveflow.llm.token_files import count_tokens, read_ranks, write_token_files


def plain(files, eod):
    out = []
    for no, tokens in enumerate(files):
        start, doc = 0, 0
        for i, t in enumerate(tokens):
            if t == eod:
                out.append((no, doc, start, i - start, True))
                start, doc = i + 1, doc + 1
        if start < len(tokens):
            out.append((no, doc, start, len(tokens) - start, False))
    return sorted(out)


@pytest.mark.parametrize("eod, dtype", [(9, "<u2"), (70000, "<u4")])
def test_stitching(spark, tmp_path, eod, dtype):
    rng = np.random.default_rng(eod)
    files = [np.where(rng.random(n) < p, eod, rng.integers(0, 9, n)).tolist() for n, p in ((0, 0), (1, 1), (50, 0), (57, 0.3), (400, 0.02), (64, 1))]
    for no, tokens in enumerate(files):
        np.array(tokens, dtype=dtype).tofile(tmp_path / f"part-{no:05d}-x.txt")
    got = count_tokens(spark, str(tmp_path), eod, block_tokens=8).collect()
    assert sorted(tuple(r) for r in got) == plain(files, eod)


def test_length_must_be_whole(spark, tmp_path):
    (tmp_path / "part-00000-x.txt").write_bytes(b"abc")
    with pytest.raises(Exception, match="whole number of tokens"):
        count_tokens(spark, str(tmp_path), 9).collect()


@pytest.mark.skipif(not os.path.exists(RANKS), reason="no vocabulary here")
def test_texts_to_files_and_back(spark, tmp_path):
    import tiktoken
    ranks = read_ranks(RANKS)
    pairs = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    encoding = tiktoken.Encoding("test", pat_str=PATTERN, mergeable_ranks=pairs, special_tokens={})
    path = str(tmp_path / "tokens")
    write_token_files(odd_docs(spark, clash=True).repartition(3), path, ranks, PATTERN, END_OF_DOCUMENT)
    got = count_tokens(spark, path, END_OF_DOCUMENT, block_tokens=100).collect()
    assert Counter(r.n_tokens for r in got) == Counter(len(encoding.encode_ordinary(r[1] or "")) for r in ODD)
    assert all(r.ended for r in got)
    path = str(tmp_path / "none")
    write_token_files(empty_docs(spark), path, ranks, PATTERN, END_OF_DOCUMENT)
    assert count_tokens(spark, path, END_OF_DOCUMENT).collect() == []
