"""A SentencePiece model file: its pieces, its settings, its compiled character map.

Only the fields that encoding and decoding need are read. The file is a
protocol-buffer message; the map is a double array of units followed by the
replacement strings.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np

# The white space mark, and the piece types of the model format.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        number, kind = tag >> 3, tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size, at = (8, at) if kind == 1 else (4, at) if kind == 5 else _varint(data, at)
            value, at = data[at : at + size], at + size
        yield number, value


class CharacterMap:
    """Longest-prefix replacement of character sequences."""

    def __init__(self, compiled: bytes) -> None:
        size = struct.unpack_from("<I", compiled)[0] if compiled else 0
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if size else []
        self.strings = compiled[4 + size :]

    def __bool__(self) -> bool:
        return bool(self.units)

    @staticmethod
    def _jump(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key that begins at ``at``."""
        units, node, found = self.units, self._jump(self.units[0]), None
        for end in range(at, len(text)):
            node ^= text[end]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != text[end]:
                break
            node ^= self._jump(unit)
            if unit & 256:
                found = end + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        length, place = found
        return length, self.strings[place : self.strings.index(b"\0", place)]


@dataclass
class Model:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    types: list[int] = field(default_factory=list)
    kind: int = 1
    byte_fallback: bool = False
    unknown_surface: str = " ⁇ "
    space_at_end: bool = False
    dummy_space: bool = True
    strip_spaces: bool = True
    escape_spaces: bool = True
    map: CharacterMap = field(default_factory=lambda: CharacterMap(b""))

    @classmethod
    def parse(cls, data: bytes) -> Model:
        model = cls()
        for number, value in _fields(data):
            if number == 1:
                model._add_piece(value)
            elif number == 2:
                model._set_trainer(value)
            elif number == 3:
                model._set_normaliser(value)
        return model

    def _add_piece(self, data: bytes) -> None:
        found = dict(_fields(data))
        self.pieces.append(found.get(1, b"").decode())
        self.scores.append(struct.unpack("<f", found[2])[0] if 2 in found else 0.0)
        self.types.append(found.get(3, NORMAL))

    def _set_trainer(self, data: bytes) -> None:
        found = dict(_fields(data))
        self.kind = found.get(3, 1)
        self.space_at_end = bool(found.get(24, 0))
        self.byte_fallback = bool(found.get(35, 0))
        if 44 in found:
            self.unknown_surface = found[44].decode()

    def _set_normaliser(self, data: bytes) -> None:
        found = dict(_fields(data))
        self.map = CharacterMap(found.get(2, b""))
        self.dummy_space = bool(found.get(3, 1))
        self.strip_spaces = bool(found.get(4, 1))
        self.escape_spaces = bool(found.get(5, 1))

    @property
    def space(self) -> str:
        return MARK if self.escape_spaces else " "

    # Normalisation

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and per character the byte of ``text`` at which it begins.

        One more entry stands for the end of the text.
        """
        if not self.map and not self.strip_spaces and self.escape_spaces and not self.space_at_end:
            return self._spaces_only(text)
        return self._mapped(text)

    def _spaces_only(self, text: str) -> tuple[str, np.ndarray]:
        if not text:
            return "", np.zeros(1, np.int64)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        sizes = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        begins = np.zeros(len(points) + 1 + self.dummy_space, np.int64)
        np.cumsum(sizes, out=begins[1 + self.dummy_space :])
        return (MARK if self.dummy_space else "") + text.replace(" ", MARK), begins

    def _prefix(self, raw: bytes, at: int) -> tuple[str, int]:
        match = self._own_symbol(raw, at)
        if match:
            return match, len(match.encode())
        hit = self.map.longest(raw, at) if self.map else None
        if hit:
            return hit[1].decode(), hit[0]
        lead = raw[at]
        size = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
        return raw[at : at + size].decode(), size

    def _own_symbol(self, raw: bytes, at: int) -> str:
        if not self.user_symbols:
            return ""
        hit = self.user_symbols.match(raw, at)
        return hit.group().decode() if hit else ""

    def _mapped(self, text: str) -> tuple[str, np.ndarray]:
        raw, at = text.encode(), 0
        if self.strip_spaces:
            while at < len(raw):
                new, used = self._prefix(raw, at)
                if new != " ":
                    break
                at += used
        if at == len(raw):
            return "", np.zeros(1, np.int64)
        made: list[str] = []
        begins: list[int] = []
        if self.dummy_space and not self.space_at_end:
            made.append(self.space)
            begins.append(at)
        after_space = self.strip_spaces
        while at < len(raw):
            new, used = self._prefix(raw, at)
            if after_space:
                new = new.lstrip(" ")
            if new:
                made += new.replace(" ", self.space)
                begins += [at] * len(new)
                after_space = self.strip_spaces and new.endswith(" ")
            at += used
            after_space &= self.strip_spaces
        end = at
        if self.strip_spaces:
            while made and made[-1] == self.space:
                made.pop()
                end = begins.pop()
        if self.dummy_space and self.space_at_end:
            made.append(self.space)
            begins.append(end)
        return "".join(made), np.array([*begins, end], np.int64)

    # What encoding looks up

    def index(self) -> Model:
        """Prepares the look-up tables."""
        kinds = list(zip(self.pieces, self.types, strict=True))
        self.unknown = self.types.index(UNKNOWN)
        self.merges = {
            p: -s
            for (p, t), s in zip(kinds, self.scores, strict=True)
            if t in (NORMAL, USER_DEFINED, UNUSED)
        }
        self.ids = {p: i for i, (p, t) in enumerate(kinds) if t in (NORMAL, USER_DEFINED, UNUSED)}
        self.controls = {i for i, (_, t) in enumerate(kinds) if t == CONTROL}
        self.unused = {p for p, t in kinds if t == UNUSED}
        self.byte_ids = [0] * 256
        self.surfaces = []
        for i, (p, t) in enumerate(kinds):
            if t == BYTE:
                self.byte_ids[int(p[3:5], 16)] = i
                self.surfaces.append(bytes([int(p[3:5], 16)]))
            elif t == CONTROL:
                self.surfaces.append(b"")
            elif t == UNKNOWN:
                self.surfaces.append(self.unknown_surface.encode())
            else:
                self.surfaces.append(p.replace(MARK, " ").encode())
        own = sorted((p for p, t in kinds if t == USER_DEFINED), key=len, reverse=True)
        self.user_symbols = re.compile(b"|".join(re.escape(p.encode()) for p in own)) if own else None
        self.user_words = re.compile("(" + "|".join(map(re.escape, own)) + ")") if own else None
        self.chunks = self._chunk_pattern()
        return self

    def _chunk_pattern(self) -> re.Pattern:
        """Finds stretches that no piece crosses, so that each can be encoded on its own."""
        joined = [p for p in self.merges if len(p) > 1]
        inside = set("".join(joined))
        alone = [c for c in map(chr, range(32)) if c not in inside]
        stops = "[" + "".join(map(re.escape, alone)) + "]" if alone else None
        if any(MARK in p.lstrip(MARK) for p in joined):
            return re.compile("(?s).+" if not stops else f"{stops}|[^{stops[1:-1]}]+")
        barred = MARK + (stops[1:-1] if stops else "")
        return re.compile(f"{MARK}*[^{barred}]+|{MARK}+" + (f"|{stops}" if stops else ""))


@lru_cache(maxsize=4)
def load(path: str) -> Model:
    """The model of a file, once per process."""
    with open(path, "rb") as file:
        model = Model.parse(file.read()).index()
    if model.kind != 2:
        raise ValueError(f"{path} is not a BPE model")
    return model
