"""Token ids of whole texts with a public byte-level BPE tokenizer, merging each repeated word once.

Texts of Latin-1 characters are cut by the tokenizer's own public pre-token pattern, its letter, digit and mark
classes written out for that alphabet. A text that the pattern does not cover from end to end, like any other
text, goes to the tokenizer as it is. The library merges the words that are not remembered, many in one call.
"""

from __future__ import annotations

import codecs
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers

from modelvigil.llm.common import worker_state

_LETTERS, _MARKS, _BLANKS = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-/:-@\[-`{-~", r" \t\n\r\f\v"
#: Byte-level pattern: a word may carry the blank before it.
_BYTE_PARTS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[{_MARKS}]+|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+"
)
#: Word pattern: digits stand alone and blanks mean nothing.
_WORD_PARTS = re.compile(rf" ?'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[0-9]| ?[{_MARKS}]+|[{_BLANKS}]+")
#: Parts in one call of the library; longer inputs cost it more a part.
GROUP = 250
#: Bytes of a remembered word beside its letters and ids: two object heads and a place in the table.
_ENTRY = 180


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> str:
    """Byte-level alphabet: visible Latin-1 bytes stand for themselves, the others for 256, 257, ... in order.
    Byte zero, which no part holds, separates parts."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in visible)}
    return "".join(chr(hidden.get(b, b)) if b else "\n" for b in range(256))


_ALPHABET = _byte_letters()


class PieceEncoder:
    """Little-endian unsigned 32-bit ids of texts.

    ``memory`` bounds the bytes of the words kept; beyond it the memory starts anew. Words above ``longest``
    characters seldom repeat and are not kept. The tokenizer for whole texts is loaded when
    a text needs it.
    """

    def __init__(self, path: str, memory: int = 72_000_000, longest: int = 14):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.path, self.tokenizer = path, None
        self.merger = Tokenizer.from_file(path)  # the merges alone
        self.added = [token.content.lower() for token in self.merger.get_added_tokens_decoder().values()]
        self.memory, self.longest = memory, longest
        self.known: dict[str, bytes] = {}
        self.held = 0
        self.words = self.merger.normalizer is not None  # lower case, blanks dropped
        self.cut = (_WORD_PARTS if self.words else _BYTE_PARTS).findall
        self.merger.normalizer = None
        self.merger.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.merger.encode_special_tokens = True
        suffix = self.merger.model.end_of_word_suffix or ""
        vocabulary = self.merger.get_vocab()
        self.widths = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, number in vocabulary.items():
            self.widths[number] = len(token.removesuffix(suffix)) if suffix else len(token)

    def whole(self, texts: list[str]) -> list[bytes]:
        if self.tokenizer is None:
            self.tokenizer = Tokenizer.from_file(self.path)
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def merged(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of parts that are one pre-token each."""
        out = {}
        for i in range(0, len(parts), GROUP):
            some = parts[i : i + GROUP]
            joined = "\0".join([part.lstrip() for part in some] if self.words else some)
            letters = _letters(joined)
            ids = np.array(self.merger.encode_batch_fast([letters], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = np.cumsum(np.fromiter(map(len, letters.split("\n")), dtype=np.int64))
            through = np.cumsum(self.widths[ids])
            if through[-1] != ends[-1]:
                raise ValueError("the vocabulary does not cover the bytes of a word")
            cuts = (4 * np.searchsorted(through, ends) + 4).tolist()
            code = ids.tobytes()
            out.update(zip(some, [code[a:b] for a, b in zip([0, *cuts], cuts)]))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        if self.held > self.memory:
            self.known, self.held = {}, 0
        known, cut = self.known.get, {}
        fresh: set[str] = set()
        for i, text in enumerate(texts):
            if text:
                lower = text.lower()
                if any(token in lower for token in self.added):  # the library knows them as one token
                    out[i] = self.whole([text])[0]
                    continue
                parts = self.cut(lower if self.words else text)
                if len("".join(parts)) == len(text) and _latin(text):
                    codes = list(map(known, parts))
                    if None in codes:  # the words to merge, and their places
                        places = [k for k, code in enumerate(codes) if code is None]
                        missing = [parts[k] for k in places]
                        fresh.update(missing)
                        cut[i] = (codes, places, missing)
                    else:
                        out[i] = b"".join(codes)
                else:
                    out[i] = self.whole([text])[0]
        blank = [part for part in fresh if not part.strip()] if self.words else []
        merged = dict.fromkeys(blank, b"")
        merged.update(self.merged(list(fresh.difference(blank)) if blank else list(fresh)))
        for i, (codes, places, missing) in cut.items():
            for k, part in zip(places, missing):
                codes[k] = merged[part]
            out[i] = b"".join(codes)
        for part, code in merged.items():
            if len(part) <= self.longest:  # a word, its ids, and a place in the table
                self.known[part] = code
                self.held += _ENTRY + len(part) + len(code)
        return out

    def stream(self, texts: Iterable[str], chars: int = 2_000_000) -> Iterator[bytes]:
        """Ids of each text in order, a few megabytes of text at a time."""
        some, size = [], 0
        for text in texts:
            some.append(text)
            size += len(text)
            if size >= chars:
                yield from self.encode(some)
                some, size = [], 0
        yield from self.encode(some)


def _latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _letters(text: str) -> str:
    """The byte-level letters of a text's UTF-8 form."""
    return codecs.charmap_decode(text.encode("utf-8"), "strict", _ALPHABET)[0]


def encoder(path: str) -> PieceEncoder:
    """The encoder of a worker process, its words still warm for the next task of the same query."""
    return worker_state(path, PieceEncoder)
