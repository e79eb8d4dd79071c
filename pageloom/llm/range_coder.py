"""Static range asymmetric numeral system over interleaved lanes, in numpy.

A block of symbols is dealt to lanes, symbol ``i`` to lane ``i % lanes``. Every lane is a coder of its own with a
63-bit state and 32-bit words; all lanes step together, so one numpy call codes one symbol of each lane. Words of all
lanes share one stream. Every ``CHECKPOINT`` steps the encoder notes the states and the place in the stream, so that the
stretches between checkpoints can be decoded independently of each other.
"""

from __future__ import annotations

import zlib

import numpy as np

SCALE_BITS = 20
LOW = np.uint64(1 << 31)
CHECKPOINT = 128
LANES = 1024
_HEADER = np.dtype([("symbols", "<u4"), ("lanes", "<u4"), ("words", "<u4"), ("marks", "<u4"), ("raw_crc", "<u4"), ("data_crc", "<u4")])


class FrequencyTable:
    """Frequencies of all symbols scaled to a sum of 2**SCALE_BITS; every symbol keeps at least 1."""

    def __init__(self, counts: np.ndarray) -> None:
        size = 1 << SCALE_BITS
        if not 0 < len(counts) <= size // 2:
            raise ValueError(f"between 1 and {size // 2} symbols can be coded, not {len(counts)}")
        counts = np.asarray(counts, np.float64)
        total = counts.sum()
        room = size - len(counts)
        freq = 1 + np.floor(counts * (room / total) if total else np.zeros(len(counts))).astype(np.int64)
        freq[int(np.argmax(freq))] += size - int(freq.sum())
        self._hold(freq)

    @classmethod
    def of(cls, freq: np.ndarray) -> FrequencyTable:
        """The table that has these scaled frequencies."""
        table = cls.__new__(cls)
        table._hold(np.asarray(freq, np.int64))
        return table

    def _hold(self, freq: np.ndarray) -> None:
        self.freq = freq.astype(np.uint32)
        self.start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint32)
        self._symbol: np.ndarray | None = None

    @property
    def symbol(self) -> np.ndarray:
        """Symbol of every slot."""
        if self._symbol is None:
            self._symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint16 if len(self.freq) <= 1 << 16 else np.uint32), self.freq)
        return self._symbol

    def crc(self) -> int:
        return zlib.crc32(self.freq.astype("<u4").tobytes())


def encode(symbols: np.ndarray, table: FrequencyTable, lanes: int = LANES) -> bytes:
    """One independent block: header, checkpoints, words. Symbols are coded last to first, as the method asks."""
    symbols = np.asarray(symbols, np.uint32)
    n = len(symbols)
    lanes = max(1, min(lanes, n))
    steps = -(-n // lanes)
    freq = table.freq[symbols].astype(np.uint64)
    start = table.start[symbols].astype(np.uint64)
    bits, word = np.uint64(SCALE_BITS), np.uint64(32)
    limit = freq << np.uint64(63 - SCALE_BITS)
    state = np.full(lanes, LOW, np.uint64)
    out: list[np.ndarray] = []
    marks: list[tuple[int, np.ndarray]] = []
    written = 0
    for step in range(steps - 1, -1, -1):
        f, c = freq[step * lanes : (step + 1) * lanes], start[step * lanes : (step + 1) * lanes]
        s = state[: len(f)]
        full = np.flatnonzero(s >= limit[step * lanes : (step + 1) * lanes])
        if len(full):
            over = s[full]
            out.append(over.astype("<u4")[::-1])  # the low 32 bits
            written += len(full)
            s[full] = over >> word
        q = s // f
        state[: len(f)] = (q << bits) + (s - q * f) + c
        if step % CHECKPOINT == 0:
            marks.append((written, state.copy()))
    words = np.concatenate(out)[::-1] if out else np.empty(0, "<u4")
    marks.reverse()
    places = np.array([written - at for at, _ in marks], "<u4")
    states = np.array([s for _, s in marks], "<u8").astype("<u8").reshape(len(marks), lanes)
    body = places.tobytes() + states.astype("<u8").tobytes() + np.ascontiguousarray(words).tobytes()
    header = np.zeros(1, _HEADER)
    header[0] = (n, lanes, len(words), len(marks), zlib.crc32(symbols.astype("<u4").tobytes()), zlib.crc32(body))
    return header.tobytes() + body


def _parsed(block: bytes) -> tuple[np.void, np.ndarray, np.ndarray, np.ndarray]:
    head = np.frombuffer(block, _HEADER, 1)[0]
    body = block[_HEADER.itemsize :]
    if zlib.crc32(body) != head["data_crc"]:
        raise ValueError("the block's data don't match its checksum")
    marks, lanes = int(head["marks"]), int(head["lanes"])
    places = np.frombuffer(body, "<u4", marks)
    states = np.frombuffer(body, "<u8", marks * lanes, 4 * marks).reshape(marks, lanes)
    return head, places, states, np.frombuffer(body, "<u4", int(head["words"]), 4 * marks + 8 * marks * lanes)


def decode_from(block: bytes, table: FrequencyTable, mark: int, steps: int = CHECKPOINT) -> np.ndarray:
    """Symbols of the ``steps`` steps after checkpoint ``mark``, decoded from there alone."""
    head, places, states, words = _parsed(block)
    return _stretch(int(head["symbols"]), words, int(places[mark]), states[mark], mark * CHECKPOINT, steps, table)


def _stretch(n: int, words: np.ndarray, at: int, state: np.ndarray, first: int, steps: int, table: FrequencyTable) -> np.ndarray:
    lanes = len(state)
    state = state.astype(np.uint64)
    out = np.empty(max(0, min(n, (first + steps) * lanes) - first * lanes), np.uint32)
    mask, bits, word = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS), np.uint64(32)
    symbol, freq, start = table.symbol, table.freq, table.start
    done = 0
    while done < len(out):
        live = min(lanes, len(out) - done)
        s = state[:live]
        slot = s & mask
        found = symbol[slot]
        out[done : done + live] = found
        s = freq[found] * (s >> bits) + slot - start[found]
        short = np.flatnonzero(s < LOW)
        if len(short):
            s[short] = (s[short] << word) | words[at : at + len(short)].astype(np.uint64)
            at += len(short)
        state[:live] = s
        done += live
    return out


def decode(block: bytes, table: FrequencyTable) -> np.ndarray:
    """All symbols of a block, each stretch from its own checkpoint, checked against both checksums."""
    head, places, states, words = _parsed(block)
    n = int(head["symbols"])
    if not n:
        return np.empty(0, np.uint32)
    out = np.concatenate([_stretch(n, words, int(at), state, mark * CHECKPOINT, CHECKPOINT, table) for mark, (at, state) in enumerate(zip(places, states))])
    if zlib.crc32(out.astype("<u4").tobytes()) != head["raw_crc"]:
        raise ValueError("the decoded symbols don't match their checksum")
    return out
