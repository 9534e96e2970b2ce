import random

import public_tokenizers
from llm.helpers import awkward, docs_of
from tokenizers import Tokenizer

from tallyho.llm import token_counts as K

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_counts_equal_the_library():
    counter, rng = K.TokenCounter(PATH), random.Random(5)
    letters = list("aé  \t\n\x0b\x1c\x1f\x85\xa0ªµ²¼¾_'sdll-!­Āİıſ€日") + ["<|endoftext|>", "the", "tion", "'ve"]
    for _ in range(6000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 14)))
        assert counter.count(text) == len(counter.whole.encode(text, add_special_tokens=False).ids), repr(text)


def test_whole_tokens_are_proven():
    counter = K.TokenCounter(PATH)
    rng = random.Random(1)
    for piece in rng.sample(sorted(counter.base), 500):
        if K.PRE_TOKEN.findall(piece) == [piece] and piece not in counter.special:
            assert len(counter.whole.encode(piece, add_special_tokens=False).ids) == 1


def test_operator_on_awkward_rows(spark):
    whole = Tokenizer.from_file(PATH)
    got = K.count_tokens(docs_of(spark, awkward()), "doc_id", "text", PATH).collect()
    want = []
    for r in awkward():
        t = r[1] or ""
        n = len(whole.encode(t, add_special_tokens=False).ids)
        want.append((r[0], len(t.encode()), n, n > 512))
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)
    assert K.count_tokens(docs_of(spark, []), "doc_id", "text", PATH).collect() == []
