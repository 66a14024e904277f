"""A minimal acyclic transducer from byte strings to sequences of numbers, in one flat file that is memory-mapped.

Words come sorted; states that can no longer change are looked up by their arcs and shared, so common endings are
stored once. Outputs move toward the start as far as all words behind an arc agree, which is what lets ends be shared.
The file is 32-bit numbers: five counts, then first arc of each state, output of each final state, label, target and
output of each arc, where each output starts, and the outputs.
"""

from __future__ import annotations

import mmap
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Sequence

MAGIC = 0x4C455831


class _State:
    __slots__ = ("arcs", "final")

    def __init__(self) -> None:
        self.arcs: list[list] = []  # label, state, output
        self.final: tuple[int, ...] | None = None


def _shared(a: Sequence[int], b: Sequence[int]) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def compile_words(entries: Iterable[tuple[bytes, tuple[int, ...]]]) -> bytes:
    """The file for entries whose words are sorted, distinct and not empty."""
    known: dict[tuple, _State] = {}
    path = [_State()]
    last = b""

    def settle(depth: int) -> None:
        """Replace the states of the last word below ``depth`` by known equal ones."""
        while len(path) > depth:
            state = path.pop()
            key = (state.final, tuple((label, id(to), out) for label, to, out in state.arcs))
            path[-1].arcs[-1][1] = known.setdefault(key, state)

    for word, output in entries:
        if word <= last:
            raise ValueError("words must be sorted, distinct and not empty")
        same = _shared(word, last)
        settle(same + 1)
        for i in range(same):
            arc = path[i].arcs[-1]
            n = _shared(arc[2], output)
            rest, arc[2], output = arc[2][n:], arc[2][:n], output[n:]
            if rest:
                for below in path[i + 1].arcs:
                    below[2] = rest + below[2]
                if path[i + 1].final is not None:
                    path[i + 1].final = rest + path[i + 1].final
        for i in range(same, len(word)):
            state = _State()
            path[i].arcs.append([word[i], state, output if i == same else ()])
            path.append(state)
        path[-1].final = output if same == len(word) else ()
        last = word
    settle(1)
    return _flat(path[0])


def _flat(root: _State) -> bytes:
    number, order = {id(root): 0}, [root]
    for state in order:
        for _, to, _ in state.arcs:
            if id(to) not in number:
                number[id(to)] = len(order)
                order.append(to)
    place: dict[tuple[int, ...], int] = {(): 0}
    ref = lambda out: place.setdefault(out, len(place))
    first, final, label, target, output = [0], [], [], [], []
    for state in order:
        final.append(0 if state.final is None else 1 + ref(state.final))
        for byte, to, out in sorted(state.arcs, key=lambda arc: arc[0]):
            label.append(byte)
            target.append(number[id(to)])
            output.append(ref(out))
        first.append(len(label))
    starts, ids = [0], []
    for out in place:
        ids.extend(out)
        starts.append(len(ids))
    return array("I", [MAGIC, len(order), len(label), len(place), len(ids), *first, *final, *label, *target, *output, *starts, *ids]).tobytes()


class Lexicon:
    """A memory-mapped transducer file."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            view = memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)).cast("I")
        magic, states, arcs, outputs, ids = view[:5]
        if magic != MAGIC:
            raise ValueError(f"{path} is no lexicon")
        self.states, self.arcs, at = states, arcs, 5
        parts = []
        for n in (states + 1, states, arcs, arcs, arcs, outputs + 1, ids):
            parts.append(view[at : at + n])
            at += n
        self._first, self._final, self._label, self._target, self._output, self._starts, self._ids = parts

    def get(self, word: bytes) -> list[int] | None:
        """The numbers of a word; None if it isn't in the lexicon."""
        first, label, starts, ids = self._first, self._label, self._starts, self._ids
        state, found = 0, []
        for byte in word:
            end = first[state + 1]
            arc = bisect_left(label, byte, first[state], end)
            if arc == end or label[arc] != byte:
                return None
            out = self._output[arc]
            if out:
                found.extend(ids[starts[out] : starts[out + 1]])
            state = self._target[arc]
        final = self._final[state]
        if not final:
            return None
        found.extend(ids[starts[final - 1] : starts[final]])
        return found
