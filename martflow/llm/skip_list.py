"""An indexable skip list over the units of a text."""

from __future__ import annotations

import numpy as np

from martflow.llm.words import mixed

#: One unit in four of a lane is on the lane above it.
BITS = 2


class SkipList:
    """Units in order, reached by rank.

    The lowest lane has a hop over each unit; a unit's height follows from a
    hash of its place. A hop carries how many units and how many code points it
    crosses, and a lane ends where its last hop lands, so a seek walks each lane
    while the hops fit into what is left of the rank, and then goes down.
    """

    def __init__(self, widths: np.ndarray):
        """``widths``: code points of each unit."""
        n = len(widths)
        chars = np.concatenate([[0], np.cumsum(widths, dtype=np.int64)])
        places = np.arange(n + 1)
        draws = mixed(places.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
        #: From the lowest lane up: hops' unit widths, code-point widths, and each stop's place in the lane below.
        self.lanes: list[tuple[list[int], list[int], list[int]]] = []
        stops, below = places, places
        level = 0
        while True:
            self.lanes.append((np.diff(stops).tolist(), np.diff(chars[stops]).tolist(), np.searchsorted(below, stops).tolist()))
            level += 1
            risen = (draws[stops] >> np.uint64(64 - BITS * level) == 0) | (stops == 0)
            below, stops = stops, stops[risen]
            if len(stops) == 1 or BITS * (level + 1) > 64:
                return

    def seek(self, rank: int) -> int:
        """Code points before the unit of this rank, by accumulated widths; 0 <= rank <= number of units."""
        left, crossed, stop = rank, 0, 0
        for units, chars, down in reversed(self.lanes):
            while stop < len(units) and units[stop] <= left:
                left -= units[stop]
                crossed += chars[stop]
                stop += 1
            stop = down[stop]
        if left:
            raise IndexError(f"rank {rank} is past the end")
        return crossed
