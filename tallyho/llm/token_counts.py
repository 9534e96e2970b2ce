"""Token counts of a byte-level BPE vocabulary, by the whole-token shortcut.

Offline (once a worker) every vocabulary string is run through the merges;
those that come out as one token alone are proven whole tokens and cost 1.
A text is cut into pre-tokens with the tokenizer's own pattern; a pre-token
that is a proven whole token is counted at once, and only the rest is merged
(and remembered, in a table of bounded size).

The fast path takes texts whose characters are all below U+0250, where the
pattern's letter and digit classes are written out and don't depend on the
Unicode version, and that hold no added-token string. Other texts go whole
through the library, with its default handling of special strings.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); an empty table
gives an empty result; texts are whole, however long; repeated rows are
counted one by one; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, small_batches, table, worker_state

LIMIT = 512
#: Pre-tokens that a worker remembers, twice at most.
REMEMBERED = 150_000

# The pre-tokenizer's pattern for characters below U+0250: letters, numbers
# and white space written out (fixed values of the tokenizer and Unicode).
_L = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_N = "0-9²³¹¼-¾"
_S = "\\t\\n\\v\\f\\r \u0085\u00a0"
PRE_TOKEN = re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_N}{_L}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
BEYOND = re.compile("[^\x00-ɏ]")


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others
    for the characters from U+0100 on, in order."""
    same = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in same]
    return {b: chr(b) for b in same} | {b: chr(256 + i) for i, b in enumerate(rest)}


class TokenCounter:
    """Counts tokens of texts as the library does for ``path``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.merge = self.whole.model.tokenize
        spec = json.load(open(path, encoding="utf-8"))
        self.special = tuple(t["content"] for t in spec["added_tokens"])
        self.letters = byte_letters()
        back = {c: b for b, c in self.letters.items()}
        self.base: dict[str, int] = {}
        for piece in spec["model"]["vocab"]:
            # proven by running the merges, not assumed
            if len(self.merge(piece)) == 1:
                try:
                    self.base[bytes(back[c] for c in piece).decode("utf-8")] = 1
                except (KeyError, UnicodeDecodeError):
                    pass  # a part of a character: never a whole pre-token
        self.cost = Memo(lambda pre: self.base.get(pre) or self.merged(pre), REMEMBERED)

    def merged(self, pre: str) -> int:
        letters = self.letters
        return len(self.merge("".join([letters[b] for b in pre.encode("utf-8")])))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if any(s in text for s in self.special) or not text.isascii() and BEYOND.search(text):
            return len(self.whole.encode(text, add_special_tokens=False).ids)
        cost = self.cost
        return sum([cost[p] for p in PRE_TOKEN.findall(text)])


def count_tokens(docs: DataFrame, id_col: str, text: str, path: str, limit: int = LIMIT) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row: row-local, no shuffle."""
    small_batches(docs.sparkSession)
    schema = docs.select(id_col).schema.add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_state(f"token counter {path}", lambda: TokenCounter(path))
        for b in batches:
            n = [counter.count(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                [id_col, "n_bytes", "n_tokens", "over_limit"])

    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    return docs.select(id_col, text, size.alias("_bytes")).mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"))
