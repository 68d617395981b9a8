"""A stand-in for a sync model: the first track of a window is in sync, others are not."""

import numpy as np


def factory():
    def distances(clips):
        out = []
        for c in clips:
            matrix = np.full((int(c["duration"] * 25), 21), 10.0)
            if c["track_id"].endswith("_track_0001"):
                matrix[:, 10] = 2.0
            out.append(matrix)
        return out

    return distances


def broken():
    raise OSError("no weights")
