import random

import awkward
import pytest
from tokenizers import Tokenizer

from tillroll.llm import token_counts as tc
from tillroll.llm.queries import vocabulary

PATH = vocabulary("byte_bpe_50k.json")
ODD = ["don't 're  double  spaces \n\n\n x", "a<|endoftext|>b <|endoftext|> c", "tab\t\ttab \r\n \x0b x", "   nb \x1c\x1f x\x85y",
       "   lead", "trail   ", "日本語 テキスト。 한국어", "é ́x", "🙂🙂 🙂"]
EXTRA = [(400 + k, t, "en", "a", len(t)) for k, t in enumerate(ODD)]


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(PATH)


def test_counts_equal_the_library(spark, sf_small, model):
    for df in (awkward.docs(spark, EXTRA), spark.read.parquet(f"{sf_small}/documents.parquet")):
        for chunk in (tc.CHUNK, 600):
            text = {r.doc_id: r.text or "" for r in df.select("doc_id", "text").collect()}
            got = tc.count_tokens(df, PATH, chunk=chunk, overlap=32).collect()
            assert len(got) == df.count()
            for r in got:
                t = text[r.doc_id]
                n = len(model.encode(t, add_special_tokens=False).ids)
                assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 512), r.doc_id


def test_spliced_ids_equal_the_whole_encoding(model):
    rng = random.Random(3)
    alphabet = ["a", "é", " ", "  ", "\n", "'s", "x1", ".", "🙂", " ", "<|endoftext|>", "日"]
    for _ in range(60):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 1500)))
        whole = model.encode(text, add_special_tokens=False).ids
        for chunk, overlap in ((40, 8), (200, 20), (5, 1)):
            assert tc.splice_ids(model, text, chunk, overlap) == whole
    for text in ("a" * 3000, " " * 3000, "ab " * 1000 + "y" * 2000 + " z" * 500):
        assert tc.splice_ids(model, text, 100, 10) == model.encode(text, add_special_tokens=False).ids


def test_empty_table(spark):
    assert tc.count_tokens(awkward.empty(spark), PATH).count() == 0
