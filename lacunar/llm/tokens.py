"""Token ids of whole text columns by the tokenizers library, each distinct piece of text encoded once per worker."""

from __future__ import annotations

import json
from codecs import charmap_decode
from collections.abc import Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import regex

from lacunar.llm.textops import pieces, raw, whole

MAX_PIECES, MAX_PARTS = 600_000, 50_000  # held by a worker; when full, the cache starts again
MARKS = frozenset(".,;:!?")


class Encoder:
    """add_special_tokens is off. Texts are cut into pieces only for tokenizers of the two shapes that are known here, whose
    tokens span no such cut; for any other, whole texts pass the library. Latin-1 pieces pass the normalizer and pre-tokenizer here and only the library's
    model there, which is the dearest part of it saved; all others pass the library as they are."""

    _made: dict[str, Encoder] = {}

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        pre, norm = spec["pre_tokenizer"], spec["normalizer"]
        self.plain = False
        if spec["post_processor"] is None and pre == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} and norm is None:
            # fixed values: the pattern of this pre-tokenizer
            self.plain, self.lower = True, False
            self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        elif spec["post_processor"] is None and pre["type"] == "Sequence" and norm and [n["type"] for n in norm["normalizers"]] == ["NFC", "Replace", "Lowercase"] and [p["type"] for p in pre["pretokenizers"]] == ["Split", "ByteLevel"] and pre["pretokenizers"][0]["invert"]:
            self.plain, self.lower = True, True
            self.pattern = regex.compile(pre["pretokenizers"][0]["pattern"]["Regex"])
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.signs = "".join(self.table[b] for b in range(256))
        self.clear()

    def clear(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.parts: dict[str, tuple[int, ...]] = {}
        self.ends: dict[int, int] = {}  # the slot of an end id
        self.pool, self.edge = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64)  # ids of all slots; where each begins, in bytes
        self.used = 0

    def _part(self, part: str) -> tuple[int, ...]:
        if (ids := self.parts.get(part)) is None:
            ids = tuple([t.id for t in self.model.tokenize(charmap_decode(part.encode("utf-8"), "strict", self.signs)[0])])
            if len(self.parts) >= MAX_PARTS:
                self.parts.clear()
            self.parts[part] = ids
        return ids

    def _ids(self, piece: bytes) -> Sequence[int]:
        text = piece.decode("utf-8")
        if not self.plain or not (piece.isascii() or max(text) <= "\xff") or (60 in piece and any(s in text for s in self.special)):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        if self.lower:
            text = text.lower()
        # a space and letters, perhaps one mark behind: what the pattern would find, without it
        body, mark = (text[:-1], text[-1]) if text[-1:] in MARKS else (text, "")
        if body[:1] == " " and body[1:].isalpha() and "'" not in text:
            ids = self._part(body[1:] if self.lower else body)
            return ids + self._part(mark) if mark else ids
        out: list[int] = []
        for part in self.pattern.findall(text):
            out += self._part(part)
        return out

    def _all(self, distinct: list[bytes]) -> list[Sequence[int]]:
        """The ids of each piece. Most are a space and letters, perhaps one mark behind, whose letters pass the model once a call
        and are mapped to its signs together; all others pass `_ids`."""
        if not self.plain:
            return [self._ids(piece) for piece in distinct]
        marks = {m: self._part(m) for m in MARKS}
        words: dict[str, int] = {}
        out, at = [], []
        for piece in distinct:
            word, mark = piece.decode("utf-8"), ()
            if not word[1:].isalpha() and (mark := marks.get(word[-1:], ())):
                word = word[:-1]
            if word[:1] != " " or not word[1:].isalpha() or not (word.isascii() or max(word) <= "\xff"):
                out.append(self._ids(piece))
                at.append(-1)
            else:
                out.append(mark)
                at.append(words.setdefault(word[1:].lower() if self.lower else word, len(words)))
        tokenize, gap = self.model.tokenize, "\n"  # no word holds one
        signs = charmap_decode(gap.join(words).encode("utf-8"), "strict", self.signs)[0].split(self.table[ord(gap)])
        ids = [tuple([t.id for t in tokenize(word)]) for word in signs] if words else []
        return [tail if i < 0 else ids[i] + tail for i, tail in zip(at, out, strict=True)]

    def _put(self, ids: np.ndarray, sizes: np.ndarray) -> int:
        """The first of the new slots, of which each holds as many of these ids as `sizes` says."""
        first, n = self.used, int(self.edge[self.used]) // 4
        while n + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while first + len(sizes) >= len(self.edge):
            self.edge = np.concatenate([self.edge, np.zeros_like(self.edge)])
        self.pool[n : n + len(ids)] = ids
        self.edge[first + 1 : first + len(sizes) + 1] = 4 * (n + np.cumsum(sizes))
        self.used += len(sizes)
        return first

    def _slots(self, distinct: list[bytes]) -> np.ndarray:
        if len(self.slot) > MAX_PIECES:
            self.clear()
        get, slot = self.slot.get, self.slot
        out = np.fromiter([get(piece, -1) for piece in distinct], np.int64, len(distinct))
        new = np.flatnonzero(out < 0)
        if not len(new):
            return out
        ids = self._all([distinct[i] for i in new.tolist()])
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        k = self._put(np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes)
        slot.update(zip([distinct[i] for i in new.tolist()], range(k, k + len(new)), strict=True))
        out[new] = np.arange(k, k + len(new))
        return out

    def encode(self, col: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows one after another, offsets of the rows). With `end`, each row gets that id at its end."""
        index, distinct, first = pieces(col) if self.plain else whole(col)
        slots = self._slots(distinct.to_pylist())[index] if len(index) else np.zeros(0, np.int64)
        if end is not None:  # one more piece of each row
            if end not in self.ends:
                self.ends[end] = self._put(np.array([end], np.uint32), np.ones(1, np.int64))
            slots = np.insert(slots, first[1:], self.ends[end])
            first = first + np.arange(len(first))
        if not len(slots):
            return np.zeros(0, np.uint32), np.zeros(len(first), np.int64)
        held = pa.Array.from_buffers(pa.large_binary(), self.used, [None, pa.py_buffer(self.edge), pa.py_buffer(self.pool)])
        ids, at = raw(held.take(pa.array(slots)))
        return ids.view(np.uint32), at[first] // 4
