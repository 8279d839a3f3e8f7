"""SentencePiece encoding and decoding on the tokenizers library, rebuilt from the model file.

The protobuf gives the normaliser, the mark for spaces, the pieces with their scores and the byte pieces. Unigram models
become a Unigram model of the library; BPE models become merges in the order of their scores. Parity with the
sentencepiece library is checked for every distinct part of a text that is encoded.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from driftloom.llm.common import kernel
from driftloom.llm.sp_model import BPE, BYTE, MARK, NORMAL, UNIGRAM, USER_DEFINED, Boundaries, SpModel, parse

# Bytes of encoded parts that a process remembers, twice: when the newer half is full it becomes the older one, and parts that are
# met again move over, so frequent ones stay. ENTRY is what Python needs for a part beside its characters and ids.
MEMORY, ENTRY = 12 << 20, 240
# Characters of the texts, and parts, that are encoded at once.
TEXTS, PARTS = 1 << 18, 8000


def _merges(model: SpModel) -> list[tuple[str, str]]:
    """Every pair of pieces that makes a piece, best score first."""
    score = {t: s for t, s, kind in model.pieces if kind in (NORMAL, USER_DEFINED)}
    out = []
    for i, (text, s, kind) in enumerate(model.pieces):
        if kind in (NORMAL, USER_DEFINED):
            out += [(-s, i, k, text[:k], text[k:]) for k in range(1, len(text)) if text[:k] in score and text[k:] in score]
    return [(a, b) for _, _, _, a, b in sorted(out)]


def backend(model: SpModel, part: bool = False):
    """A tokenizers.Tokenizer with the model's ids. part: for pieces of a text, which get no mark in front."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    vocabulary = {t: i for i, (t, _, _) in enumerate(model.pieces)}
    unknown = model.pieces[model.unknown][0]
    if model.kind == UNIGRAM:
        core = models.Unigram([(t, s) for t, s, _ in model.pieces], model.unknown, model.byte_fallback)
    elif model.kind == BPE:
        core = models.BPE(vocabulary, _merges(model), unk_token=unknown, fuse_unk=True, byte_fallback=model.byte_fallback)
    else:
        raise ValueError("only unigram and BPE models")
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix and not part:
        steps.append(normalizers.Prepend(" "))
    if model.escape:
        steps.append(normalizers.Replace(" ", MARK))
    made = Tokenizer(core)
    made.normalizer = normalizers.Sequence(steps)
    fuse = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    made.decoder = decoders.Sequence(fuse + [decoders.Strip(" ", 1, 0)] * model.dummy_prefix)
    return made


class Codec:
    """Encodes whole texts part by part, and decodes ids with byte tables."""

    def __init__(self, data: bytes, verify: bool = True):
        self.model = parse(data)
        self.cuts = Boundaries(self.model)
        self.by_parts = self.cuts.usable
        self.tokenizer = backend(self.model, part=self.by_parts)
        self.core = self.tokenizer.model
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0
        self.wrong: set[str] = set()
        self.reference = None
        if verify:
            import sentencepiece

            self.reference = sentencepiece.SentencePieceProcessor(model_proto=data)
            self.mark, self.lead = self.reference.piece_to_id(MARK), len(self.reference.encode("\n"))
        raw = [self._bytes(t, kind) for t, _, kind in self.model.pieces]
        self.blob = np.frombuffer(b"".join(raw), np.uint8)
        self.size = np.array([len(r) for r in raw])
        self.start = np.cumsum(self.size) - self.size

    @staticmethod
    def _bytes(text: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(text[3:5], 16)])
        return text.replace(MARK, " ").encode() if kind in (NORMAL, USER_DEFINED) else b""

    def _ids(self, part: str) -> list[int]:
        """Ids by the tokenizers library, on the caller's thread: Spark's tasks are what runs side by side."""
        if self.by_parts:  # all that the normaliser does to a part is to write its spaces as marks
            return [t.id for t in self.core.tokenize(part.replace(" ", MARK))]
        return self.tokenizer.encode(part, add_special_tokens=False).ids

    def _reference_ids(self, parts: list[str]) -> Iterator[list[int]]:
        """Ids by the sentencepiece library, which puts a mark in front of what it gets.

        A part that begins with a space gets its mark that way. Others follow a line break, whose two tokens are taken off again.
        """
        if not (self.by_parts and self.model.dummy_prefix):
            yield from self.reference.encode(parts, num_threads=1)
            return
        theirs = self.reference.encode([p[1:] if p[0] == " " else "\n" + p for p in parts], num_threads=1)
        for part, ids in zip(parts, theirs, strict=True):
            # the library gives nothing for an empty text
            yield ids[self.lead :] if part[0] != " " else ids if part != " " else [self.mark]

    def _learn(self, parts: list[str]) -> None:
        # ids as bytes: lists of many parts at a time would keep Python's garbage collection busy
        packed = [array("i", self._ids(p)).tobytes() for p in parts]
        self.known.update(zip(parts, packed, strict=True))
        self.held += sum(map(len, parts)) + sum(map(len, packed)) + ENTRY * len(parts)
        if self.reference is not None:
            theirs = self._reference_ids(parts)
            self.wrong.update(p for p, ids, t in zip(parts, packed, theirs, strict=True) if ids != array("i", t).tobytes())

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[bool]]:
        """Ids of each text, and whether all its parts agree with the sentencepiece library."""
        front = " " if self.by_parts and self.model.dummy_prefix else ""
        cut = [self.cuts.segments(front + t) if self.by_parts else [t] for t in (x or "" for x in texts)]
        cut = [c if t else [] for c, t in zip(cut, texts, strict=True)]
        if self.held > MEMORY:
            self.older, self.known, self.held = self.known, {}, 0
            self.wrong.intersection_update(self.older)
        new = set(chain.from_iterable(cut)).difference(self.known)
        again = new.intersection(self.older)
        self.known.update((p, self.older[p]) for p in again)
        self.held += sum(len(p) + len(self.older[p]) + ENTRY for p in again)
        new = list(new - again)
        for at in range(0, len(new), PARTS):
            self._learn(new[at : at + PARTS])
        look = self.known.__getitem__
        ids = [np.frombuffer(b"".join(map(look, c)), "<i4") for c in cut]
        return ids, [not self.wrong or self.wrong.isdisjoint(c) for c in cut]

    def decode(self, ids: np.ndarray) -> str:
        size = self.size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        place = np.arange(total) + np.repeat(self.start[ids] - (ends - size), size)
        text = self.blob[place].tobytes().decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


_codecs: dict[tuple[bytes, bool], Codec] = {}


def codec_of(data: bytes, verify: bool | None) -> Codec:
    """The codec of a model, one in each process, whatever tasks it runs. verify=None: the one that is there."""
    model = hashlib.sha256(data).digest()
    for name in [n for n in _codecs if n[0] != model]:
        del _codecs[name]
    if verify is None:
        verify = (model, True) in _codecs
    if (model, verify) not in _codecs:
        _codecs[model, verify] = Codec(data, verify)
    return _codecs[model, verify]


def _some(texts: list) -> Iterator[list]:
    """Runs of texts of about TEXTS characters."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t or "")
        if size > TEXTS:
            yield run
            run, size = [], 0
    if run:
        yield run


def encode(text: Column, data: bytes, verify: bool = True, with_ids: bool = True) -> Column:
    """struct(ids, n_tokens, ids_sha256, parity, round_trip) of each whole text; null is empty and has no tokens.

    data: bytes of the model file, read by the caller. ids_sha256: of the ids as little-endian 32-bit numbers. parity: all
    parts have the ids that the sentencepiece library gives. round_trip: the decoded ids are the text; false for texts
    that hold the mark itself, which decodes to a space.
    """
    def run(column: pa.Array) -> pa.Array:
        codec, parts = codec_of(data, verify), [[], [], [], [], []]
        for texts in _some(column.to_pylist()):
            ids, agree = codec.encode(texts)
            parts[0] += ids if with_ids else [None] * len(ids)
            parts[1] += [len(i) for i in ids]
            parts[2] += [hashlib.sha256(i.tobytes()).hexdigest() for i in ids]
            parts[3] += agree
            parts[4] += [codec.decode(i) == (t or "") for i, t in zip(ids, texts, strict=True)]
        kinds = [pa.list_(pa.int32()), pa.int64(), pa.string(), pa.bool_(), pa.bool_()]
        names = ["ids", "n_tokens", "ids_sha256", "parity", "round_trip"]
        return pa.StructArray.from_arrays([pa.array(p, k) for p, k in zip(parts, kinds, strict=True)], names)

    return kernel(run, "ids array<int>, n_tokens long, ids_sha256 string, parity boolean, round_trip boolean")(text)


def decode(ids: Column, data: bytes) -> Column:
    """Text of each list of ids; null and empty lists give the empty text."""
    def run(column: pa.Array) -> pa.Array:
        codec = codec_of(data, None)
        return pa.array([codec.decode(np.array(i or [], np.int32)) for i in column.to_pylist()], pa.string())

    return kernel(run, "string")(ids)
