"""Wavelet matrix over token ids, vectorised with numpy.

One bit-plane per bit of the largest id, top bit first; after each plane the sequence is
stably parted into zeros and ones.  Rank support is a running count every 512 bits, select
is a binary search over it.  A serialised shard holds the planes, the rank directory and
the document index, and answers queries without being expanded.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

MAGIC = b"PLWM"
VERSION = 1
_BLOCK = 512
_STRETCH = 1 << 15
_HEAD = struct.Struct("<4sHHQQ")  # magic, version, levels, tokens, documents


def _directory(plane: np.ndarray) -> np.ndarray:
    """Ones before each block of 512 bits, and in all."""
    ones = np.bitwise_count(np.pad(plane, (0, -len(plane) % (_BLOCK // 8)))).reshape(-1, _BLOCK // 8).sum(1, dtype=np.uint64)
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(ones, dtype=np.uint64)))


def _parted(a: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """The values without the bit, then those with it; by positions, stretch by stretch, which costs less than masks."""
    out, zero, one = np.empty_like(a), 0, len(a) - int(np.count_nonzero(bit))
    for at in range(0, len(a), _STRETCH):
        part, on = a[at : at + _STRETCH], bit[at : at + _STRETCH]
        no, yes = np.flatnonzero(~on), np.flatnonzero(on)
        out[zero : zero + len(no)], out[one : one + len(yes)] = part[no], part[yes]
        zero, one = zero + len(no), one + len(yes)
    return out


def _merged(a: np.ndarray, bit: np.ndarray, one: int) -> np.ndarray:
    """What _parted parted: `one` is where the values with the bit begin."""
    out, zero = np.empty_like(a), 0
    for at in range(0, len(a), _STRETCH):
        part, on = out[at : at + _STRETCH], bit[at : at + _STRETCH]
        no, yes = np.flatnonzero(~on), np.flatnonzero(on)
        part[no], part[yes] = a[zero : zero + len(no)], a[one : one + len(yes)]
        zero, one = zero + len(no), one + len(yes)
    return out


@dataclass
class WaveletMatrix:
    n: int
    planes: list[np.ndarray]  # packed bits, little-endian within bytes
    directories: list[np.ndarray]

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        top = int(ids.max()) if len(ids) else 0
        levels = max(1, top.bit_length())
        a = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        planes, directories = [], []
        for level in range(levels - 1, -1, -1):
            bit = (a & a.dtype.type(1 << level)) != 0
            planes.append(np.packbits(bit, bitorder="little"))
            directories.append(_directory(planes[-1]))
            a = _parted(a, bit)
        return cls(len(ids), planes, directories)

    @property
    def levels(self) -> int:
        return len(self.planes)

    def _zeros(self, k: int) -> int:
        return self.n - int(self.directories[k][-1])

    def _rank1(self, k: int, i: np.ndarray) -> np.ndarray:
        """Ones of plane k before positions i."""
        plane, block = self.planes[k], i // _BLOCK
        out = self.directories[k][block].astype(np.int64)
        at = block * (_BLOCK // 8)
        whole = i // 8 - at
        for step in range(int(whole.max(initial=0))):
            on = whole > step
            out[on] += np.bitwise_count(plane[at[on] + step])
        part = i % 8
        on = part > 0
        out[on] += np.bitwise_count(plane[i[on] // 8] & ((1 << part[on]) - 1).astype(np.uint8))
        return out

    def access(self, i) -> np.ndarray:
        """Ids at the positions i."""
        i = np.atleast_1d(np.asarray(i, np.int64)).copy()
        out = np.zeros(len(i), np.int64)
        for k in range(self.levels):
            bit = (self.planes[k][i // 8] >> (i % 8).astype(np.uint8)) & 1
            ones = self._rank1(k, i)
            i = np.where(bit == 1, self._zeros(k) + ones, i - ones)
            out = out * 2 + bit
        return out

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        """Where the occurrences of a token within [low, high) stand after the last plane."""
        if token < 0 or token.bit_length() > self.levels:
            return 0, 0
        ends = np.array([max(0, low), min(self.n, high)], np.int64)
        for k in range(self.levels):
            ones = self._rank1(k, ends)
            ends = self._zeros(k) + ones if token >> (self.levels - 1 - k) & 1 else ends - ones
        return int(ends[0]), max(int(ends[0]), int(ends[1]))

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """Occurrences of a token within [low, high)."""
        a, b = self._range(token, low, self.n if high is None else high)
        return b - a

    def _select(self, k: int, bit: int, order: np.ndarray) -> np.ndarray:
        """Positions in plane k of the ones (or zeros) of the given zero-based orders."""
        directory = self.directories[k].astype(np.int64)
        before = directory if bit else np.arange(len(directory)) * _BLOCK - directory
        before[-1] = directory[-1] if bit else self.n - directory[-1]
        block = np.searchsorted(before, order, "right") - 1
        base = block * (_BLOCK // 8)
        rows = np.pad(self.planes[k], (0, _BLOCK // 8))[base[:, None] + np.arange(_BLOCK // 8)]
        bits = np.unpackbits(rows, axis=1, bitorder="little") == bit
        want = order - before[block] + 1
        return block * _BLOCK + np.argmax(np.cumsum(bits, axis=1) == want[:, None], axis=1)

    def occurrences(self, token: int, low: int = 0, high: int | None = None) -> np.ndarray:
        """All positions of a token within [low, high), ascending."""
        a, b = self._range(token, low, self.n if high is None else high)
        out = []
        for start in range(a, b, 4096):
            at = np.arange(start, min(b, start + 4096), dtype=np.int64)
            for k in range(self.levels - 1, -1, -1):
                if token >> (self.levels - 1 - k) & 1:
                    at = self._select(k, 1, at - self._zeros(k))
                else:
                    at = self._select(k, 0, at)
            out.append(at)
        return np.sort(np.concatenate(out)) if out else np.empty(0, np.int64)

    def decode(self) -> np.ndarray:
        """The whole sequence, plane by plane from the last."""
        kind = np.uint16 if self.levels <= 16 else np.uint32
        a = np.zeros(self.n, kind)
        for level, plane in enumerate(reversed(self.planes)):
            bit = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            ones = int(np.count_nonzero(bit))
            a = _merged(a, bit, self.n - ones)
            a |= bit.astype(kind) << kind(level)
        return a


@dataclass
class Shard:
    """Documents' ids in order, with the matrix over all their tokens."""

    doc_ids: np.ndarray  # int64
    known: np.ndarray  # bool, false where doc_id is null
    starts: np.ndarray  # int64, one more than documents
    matrix: WaveletMatrix

    @classmethod
    def build(cls, doc_ids: list[int | None], tokens: list[np.ndarray]) -> Shard:
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        return cls(
            np.array([0 if d is None else d for d in doc_ids], np.int64),
            np.array([d is not None for d in doc_ids], bool),
            np.concatenate(([0], np.cumsum(lengths))).astype(np.int64),
            WaveletMatrix.build(np.concatenate(tokens) if tokens else np.empty(0, np.uint32)),
        )

    def to_bytes(self) -> bytes:
        m = self.matrix
        parts = [
            _HEAD.pack(MAGIC, VERSION, m.levels, m.n, len(self.doc_ids)),
            self.doc_ids.astype("<i8").tobytes(),
            self.known.astype(np.uint8).tobytes(),
            self.starts.astype("<i8").tobytes(),
        ]
        for plane, directory in zip(m.planes, m.directories, strict=True):
            parts += [plane.tobytes(), directory.astype("<u8").tobytes()]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> Shard:
        magic, version, levels, n, documents = _HEAD.unpack_from(data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a wavelet shard of this version")
        at = _HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        doc_ids, known, starts = take("<i8", documents), take("u1", documents).astype(bool), take("<i8", documents + 1)
        planes, directories = [], []
        for _ in range(levels):
            planes.append(take("u1", -(-n // 8)))
            directories.append(take("<u8", -(-n // _BLOCK) + 1))
        return cls(doc_ids, known, starts, WaveletMatrix(n, planes, directories))

    def ids(self) -> list[int | None]:
        return [int(d) if k else None for d, k in zip(self.doc_ids, self.known, strict=True)]

    def documents_at(self, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the document and offset within it, for token positions."""
        doc = np.searchsorted(self.starts, positions, "right") - 1
        return doc, positions - self.starts[doc]
