"""Exact token ids of the public tokenizer files, without the library's offsets and token objects.

The byte-level file has one merge per token, in id order, so byte-pair merging by
rank over the same vocabulary gives the same ids; whole texts go through it at once.
The file with word ends lower-cases and drops white space, so no token spans white
space and a batch of texts needs each of its words once. The end of a word is written
as one control character, which turns a token with a word end into a plain byte
string, so that the same merging applies.

Nothing is kept from batch to batch. Strings of special tokens are cut out first, as
the library does.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import cached_property, lru_cache

import numpy as np

from leafmill.llm.chunks import words_of

#: A place after a sentence, or after the last visible character of a line.
_BREAK = re.compile(r"(?<=[.!?])(?=\s|\Z)|(?<=\S)(?=[^\S\n]*\n)")
#: Some take these for white space, the library does not; the last one marks word ends here.
_SEPARATORS = re.compile(r"[\x1c-\x1f]")
WORD_END = "\x1f"
#: What texts are joined by while their breaks are sought: white space and a visible byte.
_JOINT = b" a"


def _byte_alphabet() -> dict[int, str]:
    """The usual byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest follow from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, free = {}, 256
    for byte in range(256):
        if byte in kept:
            table[byte] = chr(byte)
        else:
            table[byte] = chr(free)
            free += 1
    return table


def _white(raw: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 text belong to white space."""
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    for lead, followers in ((0xC2, (b"\x85", b"\xa0")), (0xE1, (b"\x9a\x80",)), (0xE2, (*(bytes([0x80, x]) for x in (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)), b"\x81\x9f")), (0xE3, (b"\x80\x80",))):
        at = np.flatnonzero(raw == lead)
        if len(at):
            size = len(followers[0])
            at = at[at + size < len(raw)]
            for rest in followers:
                own = at[np.logical_and.reduce([raw[at + 1 + k] == rest[k] for k in range(size)])]
                for k in range(size + 1):
                    space[own + k] = True
    return space


def break_places(raw: np.ndarray) -> np.ndarray:
    """Byte places after a visible character that ends a sentence or is the last one of its line, before white space."""
    space = _white(raw)
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    starts = np.append(np.flatnonzero(space[:-1] & ~space[1:]) + 1, len(raw))
    until = starts[np.searchsorted(starts, ends)]
    last = raw[ends - 1]
    stop = (last == 46) | (last == 33) | (last == 63)
    lines = np.append(np.flatnonzero(raw == 10), len(raw))
    stop |= lines[np.searchsorted(lines, ends)] < until
    return ends[stop]


class JsonTokenizer:
    """Ids of one tokenizer file; ``lowers`` is set for the one that lower-cases and drops white space."""

    def __init__(self, path: str):
        import regex
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        self.lowers = spec["normalizer"] is not None
        self.vocabulary = len(spec["model"]["vocab"].keys() | {t["content"] for t in spec["added_tokens"]})
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None
        byte_of, suffix = {c: b for b, c in _byte_alphabet().items()}, spec["model"]["end_of_word_suffix"] or ""
        ranks = {}
        for token, rank in spec["model"]["vocab"].items():
            if token not in self.specials:
                ends = bool(suffix) and token.endswith(suffix)
                body = token[: -len(suffix)] if ends else token
                ranks[bytes(map(byte_of.__getitem__, body)) + (WORD_END.encode() if ends else b"")] = rank
        if self.lowers:
            pattern = rf"\n|[^\n{WORD_END}]+{WORD_END}"
            self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
            self.newline = ranks[b"\n"]
        else:
            # The pattern of byte-level pre-tokenization, a fixed value.
            pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.merger = tiktoken.Encoding("words" if self.lowers else "bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(self.vocabulary, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)
        for token, rank in self.specials.items():
            self.sizes[rank] = len(token.encode())

    @cached_property
    def library(self):
        """Loaded for the few texts that only the library may encode."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _merge(self, text: str) -> np.ndarray:
        return self.merger.encode_to_numpy(text, disallowed_special=())

    def _library_ids(self, text: str) -> np.ndarray:
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def _cut(self, text: str) -> list[tuple[str, int | None]]:
        """The text before each special token with that token's id, then the rest."""
        out, at = [], 0
        for found in self.special.finditer(text) if self.special and "<" in text else ():
            out.append((text[at : found.start()], self.specials[found.group()]))
            at = found.end()
        return [*out, (text[at:], None)]

    def _plain(self, text: str) -> np.ndarray:
        parts = self._cut(text)
        if len(parts) == 1:
            return self._merge(text)
        out = []
        for part, special in parts:
            out.append(self._merge(part))
            if special is not None:
                out.append(np.array([special], np.uint32))
        return np.concatenate(out)

    def _encode_words(self, joined: str) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, which line ends set apart, and the number of ids of each."""
        odd = {}
        # What the libraries' tables of different age may class differently has no class in the oldest one.
        strange = "" if joined.isascii() else "".join(c for c in set(joined) if unicodedata.category(c) == "Cn")
        if strange:
            unlike = re.compile(f"[{re.escape(strange)}]")
            words = joined.split("\n")
            odd = {i: self._library_ids(w) for i, w in enumerate(words) if unlike.search(w)}
            joined = "\n".join("" if i in odd else w for i, w in enumerate(words))
        if not joined.isascii():
            joined = unicodedata.normalize("NFC", joined).replace("Σ", "σ")  # letter by letter, as the library does
        ids = self._merge(self.words.sub(rf"\g<0>{WORD_END}", joined.lower()))
        ends = np.append(np.flatnonzero(ids == self.newline), len(ids))
        sizes = np.diff(ends, prepend=-1) - 1
        ids = ids[ids != self.newline]
        if odd:
            rows = np.split(ids, np.cumsum(sizes)[:-1])
            for i, own in odd.items():
                rows[i] = own
            ids, sizes = np.concatenate(rows), np.fromiter(map(len, rows), np.int64, len(rows))
        return ids, sizes

    def _by_words(self, texts: list[str]) -> list[np.ndarray]:
        whole = {i: self._library_ids(t) for i, t in enumerate(texts) if _SEPARATORS.search(t) or "<" in t and self.special and self.special.search(t)}
        words = words_of(["" if i in whole else t for i, t in enumerate(texts)])
        flat, ends = words.gather(*self._encode_words(words.joined("\n")))
        return [whole[i] if i in whole else flat[a:b] for i, (a, b) in enumerate(zip(ends[:-1], ends[1:]))]

    def chunks(self, text: str) -> list[str] | None:
        """The words of a text that are encoded apart from each other, or None if it is encoded whole."""
        return text.split() if self.lowers and not _SEPARATORS.search(text) and len(self._cut(text)) == 1 else None

    def _offset_breaks(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The library's ids of a text and, by its offsets, the breaks at which none of its tokens is cut."""
        found = self.library.encode(text, add_special_tokens=False)
        ids = np.asarray(found.ids, np.uint32)
        if not len(ids):
            return ids, np.zeros(0, np.int64)
        offsets = np.asarray(found.offsets, np.int64)
        places = np.fromiter((m.start() for m in _BREAK.finditer(text)), np.int64)
        before = np.searchsorted(np.maximum.accumulate(offsets[:, 0]), places)  # tokens that begin before the place
        reach = np.concatenate([[0], np.maximum.accumulate(offsets[:, 1])])
        return ids, np.unique(before[(before > 0) & (reach[before] <= places)])

    def _plain_breaks(self, texts: list[str], rows: list[np.ndarray]) -> list[np.ndarray]:
        """The breaks of byte-level rows: their tokens' bytes are the text's, so running sizes are byte places."""
        data = [t.encode("utf-8", "replace") for t in texts]
        raw = np.frombuffer(_JOINT.join([*data, b""]), np.uint8)
        mark = np.zeros(len(raw) + 1, bool)
        mark[break_places(raw)] = True
        counts = np.fromiter(map(len, rows), np.int64, len(rows))
        at = np.repeat(np.arange(len(rows)) * len(_JOINT), counts) + np.cumsum(self.sizes[np.concatenate(rows)])
        hits = np.flatnonzero(mark[at]) + 1
        until = np.cumsum(counts)
        edges = np.searchsorted(hits, [0, *until.tolist()], "right")
        return [hits[a:b] - first for a, b, first in zip(edges[:-1].tolist(), edges[1:].tolist(), (until - counts).tolist())]

    def encode(self, texts: list[str], breaks: bool = False) -> list[tuple[np.ndarray, np.ndarray | None]]:
        """For each text its ids and, with ``breaks``, the id positions after which a sentence or line ends."""
        if not texts:
            return []
        if not self.lowers:
            rows = [self._plain(t) for t in texts]
            return list(zip(rows, self._plain_breaks(texts, rows) if breaks else [None] * len(rows)))
        if breaks:
            return [self._offset_breaks(t) for t in texts]
        return [(ids, None) for ids in self._by_words(texts)]


@lru_cache(maxsize=4)
def json_tokenizer(path: str) -> JsonTokenizer:
    """One per worker and file."""
    return JsonTokenizer(path)
