"""CRC-32 of any substring of a byte array from running checksums (numpy).

The register R of CRC-32 is linear over GF(2): reading n bytes maps a register
to ``shift(R, n)`` xor what the bytes alone give.  So with the running register
P[i] after i bytes, the bytes a .. b - 1 have the register ``P[b] ^ shift(P[a], b - a)``:
the part before a cancels.  One scan serves all substrings.
"""

from __future__ import annotations

ROW = 1024  # bytes of a row of the scan; shifts below it take one look-up per byte of the register
_STATE: dict = {}
FULL = 0xFFFFFFFF


def _tables():
    """(register after one byte, shifts by 0 .. ROW zero bytes as four tables of 256 each, shifts by ROW * 2^k)."""
    import numpy as np

    if not _STATE:
        step = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            step = np.where(step & 1, (step >> np.uint32(1)) ^ np.uint32(0xEDB88320), step >> np.uint32(1))
        near = np.empty((ROW + 1, 4, 256), np.uint32)
        near[0] = np.arange(256, dtype=np.uint32) << (np.uint32(8) * np.arange(4, dtype=np.uint32))[:, None]
        for n in range(ROW):
            near[n + 1] = step[near[n] & 255] ^ (near[n] >> np.uint32(8))
        _STATE.update(step=step, near=near.reshape(-1), far=[near[ROW].copy()])
    return _STATE["step"], _STATE["near"], _STATE["far"]


def _apply(table, value):
    return table[0][value & 255] ^ table[1][(value >> 8) & 255] ^ table[2][(value >> 16) & 255] ^ table[3][value >> 24]


def _far(k: int):
    """Tables of the shift by ROW * 2^k zero bytes."""
    _, _, far = _tables()
    while len(far) <= k:
        far.append(_apply(far[-1], far[-1]))
    return far[k]


def shift(registers, n):
    """Each register after ``n`` (an array) zero bytes."""
    import numpy as np

    _, near, _ = _tables()
    at = (n % ROW) * 1024
    out = near[at + (registers & 255)]
    for byte in range(1, 4):
        out ^= near[at + 256 * byte + ((registers >> np.uint32(8 * byte)) & 255)]
    rows = n // ROW
    for k in range(int(rows.max(initial=0)).bit_length()):
        on = np.flatnonzero((rows >> k) & 1)
        if len(on):
            out[on] = _apply(_far(k), out[on])
    return out


class RunningCrc:
    """The running registers of ``data`` (uint8), read once; rows are scanned side by side."""

    def __init__(self, data):
        import numpy as np

        step, _, far = _tables()
        rows = max(1, -(-len(data) // ROW))
        padded = np.zeros(rows * ROW, np.uint8)
        padded[: len(data)] = data
        columns = np.ascontiguousarray(padded.reshape(rows, ROW).T)
        # after[j, r]: the register of row r alone after its first j bytes
        self.after = np.zeros((ROW + 1, rows), np.uint32)
        register = np.zeros(rows, np.uint32)
        for j in range(ROW):
            register = step[(register ^ columns[j]) & 255] ^ (register >> np.uint32(8))
            self.after[j + 1] = register
        whole, (t0, t1, t2, t3) = register.tolist(), (t.tolist() for t in far[0])
        starts, r = [0], 0
        for own in whole[:-1]:
            r = t0[r & 255] ^ t1[(r >> 8) & 255] ^ t2[(r >> 16) & 255] ^ t3[r >> 24] ^ own
            starts.append(r)
        self.starts = np.array(starts, np.uint32)

    def at(self, position):
        """The register after ``position`` (an array) bytes of the data."""
        import numpy as np

        row = np.minimum(position // ROW, len(self.starts) - 1)
        column = position - row * ROW
        return self.after[column, row] ^ shift(self.starts[row], column)

    @staticmethod
    def between(at_start, at_end, length):
        """CRC-32 of the bytes between two positions with these registers, ``length`` bytes apart."""
        import numpy as np

        return at_end ^ shift(at_start ^ np.uint32(FULL), length) ^ np.uint32(FULL)
