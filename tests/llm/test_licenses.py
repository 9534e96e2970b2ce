import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tallyho.llm import licenses as L

from llm.helpers import LONG, awkward, docs_of

ALL = L.PHRASES + L.NOTICES
SCANNER = L.Scanner(ALL)


def brute(text):
    """The contract's base columns, word by word."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, w = [], ""
    for c in low + " ":
        if "0" <= c <= "9" or "a" <= c <= "z" or c > "\x7f":
            w += c
        elif w:
            words.append(w)
            w = ""
    places = [(i, n.label) for n in L.PHRASES for i in range(len(words))
              if words[i:i + len(n.text.split())] == n.text.split()]
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


PARTS = ["Apache", "apache", "LICENSE", "license", "licence", "mit", "cc", "by", "nc", "gnu", "general", "public", "a", "é", "ÀPACHE", "2", "-", "\n", ".", "\x1c", "ǅ"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=25), st.sampled_from([" ", "", "  "]))
def test_base_places_equal_brute_force(parts, gap):
    text = gap.join(parts)
    words = L.words_of(text)
    b = [s for s in SCANNER.spans(words) if s[2] and s[6] == 0]
    got = len(words), len(b), min((s[5] for s in b), default=None), max((s[5] for s in b), default=None), ",".join(sorted({s[0] for s in b}))
    assert got == brute(text)


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**9))
def test_an_edited_notice_is_found_wherever_its_edits_are(seed):
    r = random.Random(seed)
    n = r.choice([x for x in ALL if x.errors])
    t = list(n.text)
    for _ in range(r.randint(0, n.errors)):  # not the first and last character: borders stay
        i = r.randrange(1, len(t) - 1)
        kind = r.choice("idr")
        if kind == "i":
            t.insert(i, "q")
        elif kind == "d" and len(t) > 4:
            del t[i]
        else:
            t[i] = "q"
    near = " ".join(L.words_of("".join(t)))  # a deleted word takes a space with it
    if edits(near, n.text) > n.errors:
        return
    text = " ".join(f"zz{r.randint(0, 9)}" for _ in range(r.randint(0, 5))) + f" {near} tail"
    spans = SCANNER.spans(L.words_of(text))
    assert any(s[1] == n.text and s[6] <= n.errors for s in spans)
    joined = " ".join(L.words_of(text))
    for s in spans:  # every span is what it says
        assert edits(joined[s[3]:s[4]], s[1]) <= s[6] <= next(x.errors for x in ALL if x.text == s[1])
        assert s[5] == joined[:s[3]].count(" ")


def test_pieces_make_up_the_notice():
    for n in ALL:
        assert "".join(p for _, p in n.pieces()) == n.text and len(n.pieces()) == n.errors + 1
        assert all(n.text[a:a + len(p)] == p and p for a, p in n.pieces())


def test_neighbours_are_told_apart():
    label = lambda t: sorted({s[0] for s in SCANNER.spans(L.words_of(t))})
    assert label("under the limit license plan") == []
    assert label("GNU Lesser General Public Licence") == ["lgpl"]
    assert label("the general public, a license") == []
    assert label("Licensed under CC BY-NC 4.0.") == ["cc-by", "cc-by-nc"]
    assert label("MIT\nLicence") == ["mit"]


def test_exact_and_edited_side_by_side():
    spans = SCANNER.spans(L.words_of("apache licens, Apache License; apache licence apache license"))
    assert [(s[5], s[6]) for s in spans] == [(0, 1), (2, 0), (4, 1), (6, 0)]


def test_a_common_piece_is_verified_once_a_stretch():
    words = ["mit", "li"] * 50_000
    assert len(SCANNER.windows(f" {' '.join(words)} ")[3]) < 10
    assert SCANNER.spans(words + ["mit", "license"])[-1][5:] == (100_000, 0)


def test_operator_on_awkward_rows(spark):
    rows = awkward() + [(20, "a MIT License b Apache Licence c mit license", "en", "s"), (20, "cc by", "en", "s"), (21, LONG + " GNU General Public License", "en", "s")]
    out = L.scan(docs_of(spark, rows), "doc_id", "text", ALL).collect()
    want = sorted(((i, brute(t)[0], brute(t)[1]) for i, t, *_ in rows), key=repr)
    assert sorted(((r.doc_id, r.n_words, sum(s.base and s.edits == 0 for s in r.spans)) for r in out), key=repr) == want
    assert L.scan(docs_of(spark, []), "doc_id", "text", ALL).collect() == []
    assert all(r.spans == [] for r in L.scan(docs_of(spark, rows), "doc_id", "text", ()).collect())


def test_query_columns(spark, tmp_path):
    rows = [(1, "see the MIT License, and the Apache Licence", "en", "s"), (2, None, None, None), (3, "all rights reservd", "en", "s")]
    docs_of(spark, rows).select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in L.query(spark, str(tmp_path)).collect()}
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels, got[1].labels, got[1].score) == (8, 1, 2, 2, "mit", "apache,mit", 1.0)
    assert (got[2].n_words, got[2].n_base, got[2].first_word, got[2].base_labels, got[2].labels, got[2].score) == (0, 0, None, "", "", 0.0)
    assert (got[3].n_base, got[3].base_labels, got[3].labels, got[3].score) == (0, "", "proprietary", 0.75)
