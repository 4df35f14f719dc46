"""Token ids of whole texts by a byte-level BPE vocabulary file, and their cutting into pieces."""

from __future__ import annotations

import functools
import json
import re
import sys
import zlib
from array import array

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from loanstrata.llm.common import rows

#: Fixed value: the pattern by which vocabulary files of this kind cut texts into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words whose ids a worker remembers, and the longest such word. Bounds memory, not results.
MEMO_WORDS, MEMO_CHARS = 800_000, 48

_AT_SPACES = re.compile(r"(?<=\S) (?=\S)")
#: All white space but the blank and the line break.
_RARE_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]


def _odd_space(text: str) -> bool:
    """May there be a blank that isn't alone between two other characters?"""
    plain = "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " "
    return plain or any(c in text for c in _RARE_SPACE)


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit numbers.

    A single space between two other characters is always a word boundary, so a text is cut there
    and the ids of frequent words come from a memo. A special token that the file names becomes its
    id wherever its string stands in the text, as in the ``tokenizers`` library.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        plain = spec["model"]["type"] == "BPE" and spec["pre_tokenizer"] == {
            "type": "ByteLevel",
            "add_prefix_space": False,
            "trim_offsets": True,
            "use_regex": True,
        }
        if not plain or spec["normalizer"] or any(t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            # Another kind of vocabulary: no shortcuts.
            tokenizer = Tokenizer.from_file(path)
            self._word = None
            self._whole = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
            return
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(byte_of[c] for c in word): i for word, i in spec["model"]["vocab"].items()}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for word in special:
            ranks.pop(word.encode(), None)
        encoding = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self._special = tuple(special)
        self._word = encoding.encode_ordinary
        self._whole = lambda text: encoding.encode(text, allowed_special="all")
        self._memo: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._begins = np.zeros(max(ranks.values()) + 1, bool)
        self._begins[[i for word, i in ranks.items() if word.startswith(b" ")]] = True

    def __call__(self, text: str) -> bytes:
        if self._word is None or any(s in text for s in self._special):
            return _bytes(self._whole(text))
        first, *words = _AT_SPACES.split(text) if _odd_space(text) else text.split(" ")
        out = list(map(self._memo.get, words))
        missing = [i for i, ids in enumerate(out) if ids is None]
        if missing:
            known = self._lookup(dict.fromkeys(words[i] for i in missing))
            for i in missing:
                out[i] = known[words[i]]
        return b"".join([_bytes(self._word(first)), *out])

    def _lookup(self, words: dict[str, None]) -> dict[str, bytes]:
        """Ids of words that the newer half of the memo lacks, each with a blank before it.

        Those that are new are encoded together: a token that begins with a blank begins a word."""
        known = {word: ids for word in words if (ids := self._older.get(word)) is not None}
        for word in words:
            # a blank inside a word that other white space made
            if " " in word and word not in known:
                known[word] = _bytes(self._word(" " + word))
        new = [word for word in words if word not in known]
        if new:
            ids = np.array(self._word(" " + " ".join(new)), "<u4")
            raw, cuts = ids.tobytes(), [*(4 * np.flatnonzero(self._begins[ids])).tolist(), 4 * len(ids)]
            known |= {word: raw[a:b] for word, a, b in zip(new, cuts[:-1], cuts[1:], strict=True)}
        if len(self._memo) >= MEMO_WORDS // 2:
            self._older, self._memo = self._memo, {}
        self._memo.update((word, ids) for word, ids in known.items() if len(word) <= MEMO_CHARS)
        return known


def _bytes(ids: list[int]) -> bytes:
    found = array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder per worker process."""
    return Encoder(path)


def pieces(
    docs: DataFrame,
    path: str,
    most: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = None,
    keep_ids: bool = False,
) -> DataFrame:
    """Token ids of every text, cut into pieces of at most ``most`` ids:
    (uid, doc_id, piece, start, length, ids_crc32, ids).

    ``end_id`` ends every document. A document longer than ``most`` gives full pieces and one shorter
    first piece, so nothing is lost; one without ids gives no piece. ``uid`` tells rows apart, also
    those of equal ids. ``ids`` are little-endian, 16 bits where the vocabulary fits, else 32; null
    unless ``keep_ids``. A null text is an empty one.
    """
    end = b"" if end_id is None else _bytes([end_id])
    wide = _wide(path)

    def cut(batches):
        encode = encoder(path)
        for batch in batches:
            for part in rows([batch], "text"):
                out = [[] for _ in range(7)]
                for uid, doc, text in zip(*(part.column(c).to_pylist() for c in ("uid", "doc_id", "text")), strict=True):
                    ids = encode(text or "") + end
                    n = len(ids) // 4
                    first = n % most or most
                    for piece, at in enumerate(range(first - most, n, most)):
                        raw = ids[4 * max(at, 0) : 4 * (at + most)]
                        kept = None
                        if keep_ids:
                            kept = raw if wide else np.frombuffer(raw, "<u4").astype("<u2").tobytes()
                        row = (uid, doc, piece, max(at, 0), len(raw) // 4, zlib.crc32(raw), kept)
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)

    doc_type = docs.schema[id_col].dataType
    schema = f"uid long, doc_id {doc_type.simpleString()}, piece int, start long, length long, ids_crc32 long, ids binary"
    names = ["uid", "doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    types = [pa.int64(), to_arrow_type(doc_type), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")
    ).mapInArrow(cut, schema)


def _wide(path: str) -> bool:
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    most = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
    return most >= 2**16
