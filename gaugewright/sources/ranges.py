"""Sets of epochs as ranges per run: as short to store as a log has runs, however many epochs it counts."""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import functions as F


class Epochs:
    """An immutable set of (run, epoch) pairs, kept as sorted ranges [from, to] of each run."""

    def __init__(self, ranges=()):
        self.ranges = dict(ranges)

    @classmethod
    def of(cls, pairs):
        numbers = {}
        for run, epoch in pairs:
            numbers.setdefault(run, []).append([epoch, epoch])
        return cls({run: _merged(found) for run, found in numbers.items()})

    @classmethod
    def from_json(cls, content):
        return cls({run: _merged(found) for run, found in content.items()})

    def to_json(self):
        return {run: [list(r) for r in found] for run, found in sorted(self.ranges.items())}

    def __contains__(self, pair):
        run, epoch = pair
        found = self.ranges.get(run, [])
        at = bisect_right(found, epoch, key=lambda r: r[0]) - 1
        return at >= 0 and epoch <= found[at][1]

    def __bool__(self):
        return any(self.ranges.values())

    def __len__(self):
        return sum(last - first + 1 for found in self.ranges.values() for first, last in found)

    def __eq__(self, other):
        return isinstance(other, Epochs) and self.to_json() == other.to_json()

    def __hash__(self):
        return hash(tuple((run, tuple(found)) for run, found in sorted(self.ranges.items())))

    def __or__(self, other):
        runs = {*self.ranges, *other.ranges}
        return Epochs({r: _merged([*self.ranges.get(r, []), *other.ranges.get(r, [])]) for r in runs})

    def __sub__(self, other):
        out = {}
        for run, found in self.ranges.items():
            left = []
            for first, last in found:
                for start, end in other.ranges.get(run, []):
                    if start <= last and end >= first:
                        if first < start:
                            left.append((first, start - 1))
                        first = end + 1
                if first <= last:
                    left.append((first, last))
            if left:
                out[run] = left
        return Epochs(out)

    def meets(self, other):
        return len(self - other) < len(self)

    def last(self, run):
        """The run's last epoch, or -1."""
        found = self.ranges.get(run)
        return found[-1][1] if found else -1

    def condition(self, run, epoch):
        """Whether two columns name one of the epochs."""
        out = F.lit(False)
        for name, found in sorted(self.ranges.items()):
            inside = F.lit(False)
            for first, last in found:
                inside = inside | epoch.between(first, last)
            out = out | ((run == name) & inside)
        return out


def _merged(ranges):
    out = []
    for first, last in sorted(map(tuple, ranges)):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out
