"""CRC-32 of any part of a byte string from the running CRCs of two prefixes."""

from __future__ import annotations

import numpy as np

#: Bytes of a lane; all lanes of a block advance together.
LANE = 2048
#: Fixed value: the reflected polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
ONES = np.uint32(0xFFFFFFFF)


def byte_table() -> np.ndarray:
    """What one byte does to a register."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), out >> np.uint32(1)).astype(np.uint32)
    return out


TABLE = byte_table()


def applied(tables: np.ndarray, state: np.ndarray) -> np.ndarray:
    """A linear map of registers, given by what it makes of the 256 values of each of their four bytes."""
    return tables[0][state & 255] ^ tables[1][(state >> 8) & 255] ^ tables[2][(state >> 16) & 255] ^ tables[3][state >> 24]


def zero_byte() -> np.ndarray:
    """The map that appends one zero byte."""
    values = np.arange(256, dtype=np.uint32)
    return np.stack([TABLE[s & 255] ^ (s >> np.uint32(8)) for s in (values << np.uint32(8 * j) for j in range(4))])


class Shift:
    """Appends any number of zero bytes to registers: products with x^8n modulo the polynomial, by hexadecimal digits of n."""

    def __init__(self):
        self.levels: list[np.ndarray] = []  # by digit: maps of digit * 16^level zero bytes

    def level(self, k: int) -> np.ndarray:
        while len(self.levels) <= k:
            one = zero_byte() if not self.levels else applied(self.levels[-1][1], self.levels[-1][15])
            identity = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * j) for j in range(4)])
            maps = [identity]
            for _ in range(15):
                maps.append(applied(one, maps[-1]))
            self.levels.append(np.stack(maps))
        return self.levels[k]

    def __call__(self, state: np.ndarray, zeros: np.ndarray) -> np.ndarray:
        state = state.copy()
        most, k = int(zeros.max(initial=0)), 0
        while most >> 4 * k:
            digit = (zeros >> 4 * k) & 15
            at = np.flatnonzero(digit)
            if len(at):
                maps, digit, s = self.level(k), digit[at], state[at]
                state[at] = maps[digit, 0, s & 255] ^ maps[digit, 1, (s >> 8) & 255] ^ maps[digit, 2, (s >> 16) & 255] ^ maps[digit, 3, s >> 24]
            k += 1
        return state


SHIFT = Shift()
#: What a whole lane of zero bytes makes of each byte of a register.
LANE_MAPS = SHIFT(np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * j) for j in range(4)]).ravel(), np.full(1024, LANE)).reshape(4, 256).tolist()


class RunningCrc:
    """The register after every prefix of ``data``, from one scan; lanes are scanned side by side and linked afterwards."""

    def __init__(self, data: np.ndarray):
        lanes = len(data) // LANE + 1
        padded = np.zeros((lanes, LANE), np.uint8)
        padded.reshape(-1)[: len(data)] = data
        steps = np.ascontiguousarray(padded.T)
        self.inside = np.zeros((LANE, lanes), np.uint32)  # before each byte, from a lane's begin
        state = np.zeros(lanes, np.uint32)
        for i in range(LANE):
            self.inside[i] = state
            state = TABLE[(state ^ steps[i]) & 255] ^ (state >> np.uint32(8))
        self.first = np.zeros(lanes, np.uint32)  # at each lane's begin
        maps = LANE_MAPS
        register, firsts = 0, [0]
        for own in state[:-1].tolist():
            register = maps[0][register & 255] ^ maps[1][(register >> 8) & 255] ^ maps[2][(register >> 16) & 255] ^ maps[3][register >> 24] ^ own
            firsts.append(register)
        self.first[:] = firsts

    def at(self, places: np.ndarray) -> np.ndarray:
        lane, step = places // LANE, places % LANE
        return self.inside[step, lane] ^ SHIFT(self.first[lane], step)

    def between(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """CRC-32 of ``data[begin:end]``: what stands before is shifted by the length and cancelled."""
        return self.at(end) ^ SHIFT(self.at(begin) ^ ONES, end - begin) ^ ONES
