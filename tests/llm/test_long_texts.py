"""Texts of hundreds of thousands of words beside short ones, through the operators that read texts."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cardstream.llm import language_id as L
from cardstream.llm import mixing as M
from cardstream.llm import order_minhash as O
from cardstream.llm import packing as P
from cardstream.llm import quality_rules as Q
from cardstream.llm import queries as R
from cardstream.llm import simhash as H
from cardstream.llm import suffix_dedup as X
from llm_cases import DOC_DDL
from test_duplicates import brute_fingerprint

N = 200_000
RNG = random.Random(7)
WORDS = ["".join(RNG.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(RNG.randint(2, 9))) for _ in range(5_000)]
LONG = " ".join(RNG.choice(WORDS) for _ in range(N))
OTHER = " ".join(RNG.choice(WORDS) for _ in range(N))
ROWS = [(1, LONG, "en", "a", 0), (5, LONG + " end", "en", "a", 0), (9, OTHER, "en", "b", 0), (13, "a few words only", "en", "b", 0)]


@pytest.fixture(scope="module")
def long(spark):
    return spark.createDataFrame(ROWS, DOC_DDL)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_quality(long):
    got = by_id(Q.quality_rules(long))
    assert [got[i].n_words for i in (1, 5, 9, 13)] == [N, N + 1, N, 4]
    assert got[1].word_chars == len(LONG) - (N - 1) and got[13].base_failed


def test_language(long):
    got = by_id(L.language_id(long))
    assert {r.lang_pred for r in got.values()} == {"en"}


def test_packing(long):
    rows = P.pack_documents(long, R.tokenizer_path()).collect()
    plain = Tokenizer.from_file(R.tokenizer_path())
    for doc_id, text, *_ in ROWS:
        mine = sorted((r.start, r.length) for r in rows if r.doc_id == doc_id)
        want = len(plain.encode(text, add_special_tokens=False).ids) + 1
        assert mine[0][0] == 0 and sum(n for _, n in mine) == want
        assert all(a + n == b for (a, n), (b, _) in zip(mine, mine[1:]))


def test_simhash(long):
    got = by_id(H.simhash_components(long))
    for doc_id, text, *_ in ROWS:
        assert got[doc_id].fingerprint == f"{brute_fingerprint(text):016x}"
    assert got[5].component_id == got[1].component_id == 1 and got[9].component_id == 9


def test_suffixes(long):
    got = by_id(X.repeat_digest(long))
    assert got[1].n_removed == len(LONG) and got[5].n_removed == len(LONG) and got[9].n_removed == got[13].n_removed == 0


def test_order_minhash(long):
    got = by_id(O.edit_fingerprints(long))
    assert [got[i].n_chars for i in (1, 9)] == [len(LONG), len(OTHER)]
    assert got[5].near_next > 0.9 and got[9].near_next < 0.2 and 0.05 < got[9].near_edited < 0.9


def test_mixing(long):
    got = by_id(M.mixture(long))
    assert got[1].tokens == -(-len(LONG) // 4) and all(0 < r.probability <= 1 for r in got.values())


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_of_any_tokenizer(name):
    """The words' way is taken only where the file's own steps allow it."""
    path = public_tokenizers.path(name)
    own, plain = P.WordIds(path), Tokenizer.from_file(path)
    assert own.by_words == name.startswith("word")
    for text in ("Hello  world,\n it's 2024!\tOK", "", "  ", "na\u00efve \u65e5\u672c e\u0301 <|x|>", LONG[:5000]):
        assert own.ids(text.encode()).tolist() == plain.encode(text, add_special_tokens=False).ids
