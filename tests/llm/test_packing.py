import random
import zlib

import numpy as np
import pytest
from llm.helpers import awkward, docs_of, prose
from tokenizers import Tokenizer

from tallyho.llm import packing as P

PATH = P.tokenizer_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_library(library):
    encoder, rng = P.WordEncoder(PATH), random.Random(3)
    letters = list("abéÀßñÿĀİıſ日Σς'sdll  \t\n\x0b\x1c\x85\xa0.,!-_0²½ªµ") + ["<|endoftext|>", "̈", "the", "tion"]
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_pieces_cover_every_document(spark, library):
    rows = awkward() + [(100 + i, prose(i, i * 13)) for i in range(40)]
    got = P.pack(docs_of(spark, rows), PATH).collect()
    want = sorted((repr(r[0]), zlib.crc32(np.array(ids(library, r[1]), "<u4").tobytes())) for r in rows)
    by = {}
    for r in got:
        assert r.length & (r.length - 1) == 0 and 1 <= r.length <= 2048 and r.offset == 0
        by.setdefault((repr(r.doc_id), r.doc_tokens), []).append(r)
    for (doc, n), pieces in by.items():
        copies = sum(repr(r[0]) == doc and len(ids(library, r[1])) == n for r in rows)
        starts = sorted((r.start, r.length) for r in pieces)[::copies]
        assert [s for s, _ in starts] == [sum(k for _, k in starts[:i]) for i in range(len(starts))]
        assert sum(k for _, k in starts) == n
    single = {r.doc_id: r for r in got if r.length == r.doc_tokens}
    for doc, crc in want:
        r = next((x for d, x in single.items() if repr(d) == doc), None)
        assert r is None or r.ids_crc32 == crc or doc in ("None", "9", "2")
    assert sorted(r.sequence_id for r in got) == list(range(len(got)))
    order = sorted(got, key=lambda r: r.sequence_id)
    assert [r.length for r in order] == sorted(r.length for r in got)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [1]


def test_checksums_of_cut_pieces(spark, library):
    text = prose(8, 3000)
    own = np.array(ids(library, text), "<u4")
    for r in P.pack(docs_of(spark, [(1, text)]), PATH, width=256).collect():
        assert r.ids_crc32 == zlib.crc32(own[r.start:r.start + r.length].tobytes())


def test_lengths():
    assert P.piece_lengths(2048 * 2 + 11) == [2048, 2048, 8, 2, 1]
    assert P.piece_lengths(1) == [1] and P.piece_lengths(2048) == [2048] and P.piece_lengths(0) == []


def test_empty_table_and_width(spark):
    assert P.pack(docs_of(spark, []), PATH).collect() == []
    with pytest.raises(ValueError):
        P.pack(docs_of(spark, []), PATH, width=100)
