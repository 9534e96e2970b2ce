"""JSON elements out of texts that are too large to be parsed at once.

Two scanners, both small state machines whose memory is one element:

* ``elements`` takes a request body piece by piece (inflated on the way) and
  gives the text of each array element; it is strict about the array around them.
* ``Segments`` takes what stands between closing braces, the records that a line
  reader cuts a snapshot file into, from any place of the file on: the state at
  a place is whether it is inside a string and how many braces are open.
"""

from __future__ import annotations

import codecs
import re
import sys as _sys
import zlib
from collections.abc import Iterable, Iterator

from pyspark import cloudpickle as _cloudpickle

# Travels to the Python workers by value, like the other helpers of this folder.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

#: Bytes inflated (or decoded) at a time.
PIECE = 1 << 20
_SPACE = re.compile(r"[ \t\n\r]*")
_MARK = re.compile(r'[{}\[\]"]')
_STRING_END = re.compile(r'(?:[^"\\]|\\.)*"', re.DOTALL)
_STRING = re.compile(r'"(?:[^"\\]|\\.)*"', re.DOTALL)
#: An object with nothing nested in it.
_FLAT = re.compile(r'\{[^{}\[\]"]*(?:"[^"\\]*(?:\\.[^"\\]*)*"[^{}\[\]"]*)*\}', re.DOTALL)
_SCALAR = re.compile(r"[^ \t\n\r,\]\[{}]+")


class Broken(ValueError):
    """Not a JSON array, or not gzip."""


def inflate(body: bytes, piece: int = PIECE) -> Iterator[bytes]:
    """The content of a gzip body, member by member, at most ``piece`` bytes at a time."""
    if not body:
        raise Broken("empty gzip body")
    rest = body
    while rest:
        z = zlib.decompressobj(31)
        while not z.eof:
            try:
                out = z.decompress(rest, piece)
            except zlib.error as e:
                raise Broken(str(e)) from e
            rest = z.unconsumed_tail
            if out:
                yield out
            elif not z.eof and not rest:
                raise Broken("truncated gzip body")
        rest = z.unused_data


def decoded(pieces: Iterable[bytes]) -> Iterator[str]:
    """Text of UTF-8 pieces; bytes that are none become U+FFFD."""
    d = codecs.getincrementaldecoder("utf-8")("replace")
    for p in pieces:
        yield d.decode(p)
    yield d.decode(b"", True)


def pieces_of(body: bytes, piece: int = PIECE) -> Iterator[bytes]:
    for i in range(0, len(body), piece):
        yield body[i:i + piece]


class _Text:
    """A text read piece by piece: what is not needed any more is dropped."""

    def __init__(self, pieces: Iterator[str]):
        self.pieces, self.text, self.at = pieces, "", 0

    def more(self) -> bool:
        """Append a piece, dropping what lies before ``at``; False at the end."""
        for p in self.pieces:
            if p:
                self.text, self.at = self.text[self.at:] + p, 0
                return True
        return False

    def skip(self) -> str:
        """The next character that is not white space ('' at the end)."""
        while True:
            self.at = _SPACE.match(self.text, self.at).end()
            if self.at < len(self.text):
                return self.text[self.at]
            if not self.more():
                return ""

    def string_end(self, i: int) -> int:
        """Where the string ends whose text starts ``i`` after ``at``."""
        while (m := _STRING_END.match(self.text, self.at + i)) is None:
            # go on from here, unless the text breaks off within an escape
            end = len(self.text) - self.at
            i = max(i, end - (len(self.text) - len(self.text.rstrip("\\"))) % 2)
            if not self.more():
                raise Broken("unexpected end")
        return m.end() - self.at

    def take(self, n: int) -> str:
        out = self.text[self.at:self.at + n]
        self.at += n
        return out

    def nested(self) -> str:
        """The object or array that starts here."""
        if m := _FLAT.match(self.text, self.at):
            return self.take(len(m[0]))
        open_marks, i = [], 0  # i: from ``at`` on
        while True:
            m = _MARK.search(self.text, self.at + i)
            if m is None:
                i = len(self.text) - self.at
                if not self.more():
                    raise Broken("unexpected end")
                continue
            c, i = m[0], m.end() - self.at
            if c == '"':
                i = self.string_end(i)
            elif c in "{[":
                open_marks.append(c)
            elif not open_marks or (open_marks.pop() + c) not in ("{}", "[]"):
                raise Broken(f"unexpected {c}")
            elif not open_marks:
                return self.take(i)

    def scalar(self) -> str:
        if self.text[self.at] == '"':
            return self.take(self.string_end(1))
        while True:
            m = _SCALAR.match(self.text, self.at)
            if m is None:
                raise Broken("unexpected character")
            if m.end() < len(self.text) or not self.more():
                return self.take(len(m[0]))


def elements(pieces: Iterator[str]) -> Iterator[str]:
    """Texts of the elements of a JSON array (``null`` is an empty one); what follows the
    array is not read. Raises ``Broken`` as soon as the array's own syntax is."""
    t = _Text(pieces)
    c = t.skip()
    if c == "n":
        if t.scalar() != "null":
            raise Broken("not an array")
        return
    if c != "[":
        raise Broken("not an array")
    t.at += 1
    c = t.skip()
    if c == "]":
        return
    while True:
        if c in ("", ",", "]", "}"):
            raise Broken("missing element")
        yield t.nested() if c in "{[" else t.scalar()
        c = t.skip()
        if c == "]":
            return
        if c != ",":
            raise Broken("missing comma")
        t.at += 1
        c = t.skip()


_BETWEEN = re.compile(r"[\s,\[\]]*(?:null[\s,\[\]]*)*")


def step(segment: str, in_string: bool) -> tuple[int, bool]:
    """(braces opened, inside a string at the end) of the text before a closing brace."""
    if in_string:
        m = _STRING_END.match(segment)
        if m is None:
            return 0, True
        segment = segment[m.end():]
    if '"' not in segment:
        return segment.count("{"), False
    segment = _STRING.sub("", segment)
    out, quote, _ = segment.partition('"')
    return out.count("{"), bool(quote)


class Summary:
    """What a stretch of segments does to the state, for either state it may start in:
    (inside a string at the end, change of open braces, least change on the way)."""

    def __init__(self):
        self.state = [[False, 0, 0], [True, 0, 0]]

    def add(self, segment: str) -> None:
        for s in self.state:
            opened, s[0] = step(segment, s[0])
            s[1] += opened
            if not s[0]:  # the brace behind it closes
                s[1] -= 1
                s[2] = min(s[2], s[1])


class Segments:
    """Objects of a stretch of segments, given the state at its start."""

    def __init__(self, in_string: bool, depth: int):
        self.in_string, self.depth, self.parts = in_string, depth, []
        self.inside = in_string or depth > 0  # the first object began before

    def add(self, segment: str) -> Iterator[tuple[bool, str | None]]:
        """(began before this stretch, its text or the rest of it) of every object that ends
        here; a ``null`` between objects is None."""
        if self.depth == 0 and not self.in_string and not self.parts:
            m = _BETWEEN.match(segment)
            for _ in range(m[0].count("null")):
                yield False, None
            segment = segment[m.end():]
            if not segment.startswith("{"):
                raise Broken(f"not a snapshot: {segment[:40]!r}")
        opened, self.in_string = step(segment, self.in_string)
        self.parts.append(segment)
        self.depth += opened
        if self.in_string:
            return
        self.depth -= 1
        if self.depth == 0:
            text, before = "}".join(self.parts) + "}", self.inside
            self.parts, self.inside = [], False
            yield before, text

    def rest(self) -> tuple[bool, str] | None:
        """(began before this stretch, text) of the object that is still open at the end."""
        return (self.inside, "}".join(self.parts) + "}") if self.parts else None


def trailer(segment: str) -> int:
    """Text after the last closing brace of a file: the ``null`` elements in it; anything else is an error."""
    m = _BETWEEN.match(segment)
    if m.end() < len(segment):
        raise Broken(f"not a snapshot, or cut short: {segment[m.end():][:40]!r}")
    return m[0].count("null")
