"""SentencePiece model files: a reader for the protobuf, and what follows from the pieces about stable boundaries."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

# Fixed values of the file format: piece types, model types, and the mark that stands for a space.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
MARK = "▁"


@dataclass(frozen=True)
class SpModel:
    pieces: tuple[tuple[str, float, int], ...]  # text, score, type; the place is the id
    kind: int
    byte_fallback: bool
    charsmap: bytes
    dummy_prefix: bool
    squeeze: bool  # remove_extra_whitespaces
    escape: bool  # escape_whitespaces
    suffix: bool  # the mark ends words instead of beginning them

    @property
    def unknown(self) -> int:
        return next(i for i, (_, _, t) in enumerate(self.pieces) if t == UNKNOWN)

    @property
    def plain(self) -> bool:
        """The normaliser does nothing but write spaces as marks and put one in front."""
        return not self.charsmap and not self.squeeze and self.escape and not self.suffix


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message: varints as int, all others as bytes."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        wire = tag & 7
        if wire == 0:
            value, at = _varint(data, at)
        else:
            if wire == 2:
                size, at = _varint(data, at)
            elif wire in (1, 5):
                size = 8 if wire == 1 else 4
            else:
                raise ValueError(f"wire type {wire} is not part of this format")
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


def parse(data: bytes) -> SpModel:
    pieces, trainer, normaliser = [], {}, {}
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normaliser = dict(_fields(value))
    return SpModel(
        tuple(pieces),
        trainer.get(3, UNIGRAM),
        bool(trainer.get(35, 0)),
        normaliser.get(2, b""),
        bool(normaliser.get(3, 1)),
        bool(normaliser.get(4, 1)),
        bool(normaliser.get(5, 1)),
        bool(trainer.get(24, 0)),
    )


class Boundaries:
    """Places that no piece can reach over, whatever surrounds them.

    A merge makes a piece of two neighbouring ones. If no piece holds the characters left and right of a place next to
    each other, no merge can ever join over it: the tokens of both sides are those that each side has alone.
    """

    def __init__(self, model: SpModel):
        self.usable = model.kind == BPE and model.plain
        texts = [t for t, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED)]
        self.joined = {t[i : i + 2] for t in texts for i in range(len(t) - 1)}
        if not self.usable or any(j[0] != MARK and j[1] == MARK for j in self.joined):
            self.segment = re.compile(r"(?s).+")
        elif any("\n" in j for j in self.joined):
            self.segment = re.compile(r" *[^ ]+| +")
        else:
            self.segment = re.compile(r"\n+| *[^ \n]+| +")

    def hard(self, left: str, right: str) -> bool:
        pair = (MARK if left == " " else left) + (MARK if right == " " else right)
        return self.usable and pair not in self.joined

    def segments(self, text: str) -> list[str]:
        """Cuts text at hard places: before runs of spaces, and around line breaks. The parts joined are the text.

        The mark itself is to the model the same as a space, so it is taken for one here.
        """
        return self.segment.findall(text.replace(MARK, " "))
