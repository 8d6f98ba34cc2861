import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dealflow.llm.bpe import Bpe, decode, encode

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def pair():
    with open(PATH, encoding="utf-8") as f:
        return Bpe(f.read(), cached=500), Tokenizer.from_file(PATH)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=("Cs",)), st.sampled_from("the an ing\n\t  'sll019#%")), max_size=60) | st.lists(st.sampled_from(["<|endoftext|>", " the", "'ll", "\x85", "\x1c ", "  \n", "12345", "ééé", "中文"]), max_size=12).map("".join))
def test_equal_to_the_library(pair, text):
    mine, lib = pair
    ids = lib.encode(text, add_special_tokens=False).ids
    assert mine.encode(text) == ids and mine.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_long_words(pair):
    mine, lib = pair
    for t in ("a" * 20_000, "aA" * 5000, " " * 3000 + "x", "é" * 3000, "thequick" * 1000):
        assert mine.encode(t) == lib.encode(t, add_special_tokens=False).ids


def test_many_words_together_equal_one_by_one(pair, prose):
    mine, _ = pair
    words = [w.encode() for w in prose(1, 300).split()] + [b"", b"a", b"thequickbrownfox", "naïveté".encode(), b"z" * 100]
    assert mine.merge_all(words) == [mine.merge(w) for w in words]


def test_decode_of_odd_ids(pair):
    mine, lib = pair
    assert mine.decode([50256, 10**6, 464]) == "<|endoftext|>The"
    ids = lib.encode("中", add_special_tokens=False).ids
    assert mine.decode(ids[:1]) == lib.decode(ids[:1], skip_special_tokens=False)


def test_edge_cases(docs, clashing, edge_rows, pair):
    out = decode(encode(clashing, PATH), PATH).select("text", F.size("ids").alias("n"), "decoded").collect()
    assert len(out) == len(edge_rows) and all(r.decoded == (r.text or "") and (r.n == 0) == (not r.text) for r in out)
    both = encode(clashing, PATH, decoded="decoded")
    assert both.columns[-2:] == ["ids", "decoded"] and all(r.decoded == (r.text or "") for r in both.collect())
    assert decode(encode(docs([]), PATH), PATH).count() == 0
    one = encode(docs([(1, "x")]), PATH).withColumn("ids", F.lit(None).cast("array<int>"))
    assert decode(one, PATH).collect()[0].decoded is None
