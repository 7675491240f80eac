"""Token counts against the public tokenizers library's unigram model with the same pieces."""

import random

import public_tokenizers
from tokenizers import Tokenizer, models, pre_tokenizers

from vidpipe.llm import token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")


def test_counts_equal_the_library(spark):
    pieces = token_counts.read_pieces(PATH)
    model = Tokenizer(models.Unigram([("\x00unknown\x00", min(s for _, s in pieces)), *pieces], unk_id=0))
    model.pre_tokenizer = pre_tokenizers.Metaspace(replacement=token_counts.MARK, prepend_scheme="always")
    r = random.Random(3)
    texts = ["", " ", "  a", "a ", "one two", "\n\n x", "☃☃☃ a☃", "x" * 3000, "ab " * 2000]
    texts += ["".join(r.choice("aehinorst  é\n.,☃😀1") for _ in range(r.randrange(1, 120))) for _ in range(400)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "a "), (None, "b"), (900, None)]
    got = token_counts.count_tokens(spark.createDataFrame([(*x, 1.5) for x in rows], "doc_id long, text string, score double"), PATH).collect()
    expected = sorted(((i, len(model.encode(t or "").ids)) for i, t in rows), key=str)
    assert sorted(((x.doc_id, x.n_tokens) for x in got), key=str) == expected
    assert token_counts.count_tokens(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_ties_and_unknowns():
    counter = token_counts._Counter([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("abb", -3.0)])
    assert counter.count("ab") == (1, -2.0)  # the longer piece begins first
    assert counter.count("abb") == (1, -3.0)
    assert counter.count("a??b?") == (4, -2.0 + 3 * -13.0)
