"""A minimal acyclic transducer from words to numbers, built once, memory-mapped by every task.

``build`` adds sorted words one by one (the incremental construction of minimal acyclic automata):
a state that can no longer change is replaced by an equal one seen before, so common endings are
shared. Every arc carries an output, the number of words that sort before those behind the arc;
the outputs along a path add up to the word's number, which indexes the words' token ids.

File: a header of eight 64-bit numbers, then arrays in this order, each padded to eight bytes:
  states    int32, first arc of each state, one more at the end
  labels    uint8, per arc, ascending within a state
  targets   int32, per arc
  outputs   int32, per arc
  final     uint8, per state
  first_id  int32, per word, one more at the end
  ids       uint16, token ids
"""

from __future__ import annotations

MAGIC = 0x31584C434552  # "RECLX1", little-endian
KINDS = ("<i4", "u1", "<i4", "<i4", "u1", "<i4", "<u2")


def build(words: list[bytes], ids: list[list[int]]) -> bytes:
    """The file of ``words`` (sorted, distinct, not empty) and their token ids."""
    import numpy as np

    register: dict[tuple, int] = {}
    frozen: list[tuple[bool, tuple]] = []  # state -> (final, ((label, target), ...))

    def freeze(node) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(frozen)
            frozen.append(key)
        return register[key]

    path = [[False, []]]  # the states of the last word, not yet frozen; arcs to frozen states only
    last = b""
    for word in words:
        common = 0
        for a, b in zip(last, word):
            if a != b:
                break
            common += 1
        for depth in range(len(last), common, -1):
            node = path.pop()
            path[-1][1].append((last[depth - 1], freeze(node)))
        path += [[False, []] for _ in word[common:]]
        path[-1][0] = True
        last = word
    for depth in range(len(last), 0, -1):
        node = path.pop()
        path[-1][1].append((last[depth - 1], freeze(node)))
    root = freeze(path[0])

    behind = [0] * len(frozen)  # words accepted from a state; targets are frozen before sources
    states, labels, targets, outputs, final = [0], [], [], [], []
    for s, (is_final, arcs) in enumerate(frozen):
        total = int(is_final)
        for label, target in arcs:
            labels.append(label)
            targets.append(target)
            outputs.append(total)
            total += behind[target]
        behind[s] = total
        states.append(len(labels))
        final.append(is_final)
    first_id = np.cumsum([0] + [len(x) for x in ids])
    flat = [i for x in ids for i in x]
    arrays = [np.asarray(a, k) for a, k in zip((states, labels, targets, outputs, final, first_id, flat), KINDS)]
    header = np.array([MAGIC, root, *[len(a) for a in (arrays[0], arrays[1], arrays[5], arrays[6])], 0, 0], "<i8")
    out = [header.tobytes()]
    for a in arrays:
        raw = a.tobytes()
        out.append(raw + b"\0" * (-len(raw) % 8))
    return b"".join(out)


class Lexicon:
    """A file of ``build``, mapped. ``numbers`` looks up many words at a time."""

    def __init__(self, data):
        """``data``: bytes, or a read-only numpy.memmap of bytes."""
        import numpy as np

        header = np.frombuffer(data, "<i8", 8)
        if header[0] != MAGIC:
            raise ValueError("not a lexicon file")
        n_states, n_arcs, n_words, n_ids = (int(x) for x in header[2:6])
        self.root, at, arrays = int(header[1]), 64, []
        for kind, n in zip(KINDS, (n_states, n_arcs, n_arcs, n_arcs, n_states - 1, n_words, n_ids)):
            size = n * np.dtype(kind).itemsize
            arrays.append(np.frombuffer(data, kind, n, at))
            at += size + (-size % 8)
        self.states, self.labels, self.targets, self.outputs, self.final, self.first_id, self.ids = arrays

    def __len__(self) -> int:
        return len(self.first_id) - 1

    def numbers(self, flat, starts, sizes):
        """The numbers of the words ``flat[starts[i] : starts[i] + sizes[i]]`` (uint8), -1 if absent.
        All words take a step at a time; those without an arc drop out."""
        import numpy as np

        out = np.full(len(starts), -1, np.int64)
        if len(self) == 0:
            return out
        if not hasattr(self, "_keys"):
            owner = np.repeat(np.arange(len(self.states) - 1), np.diff(self.states))
            self._keys = owner.astype(np.int64) << 8 | self.labels
        live = np.arange(len(starts))
        state, total = np.full(len(starts), self.root, np.int64), np.zeros(len(starts), np.int64)
        step = 0
        while len(live):
            ended = sizes[live] == step
            if ended.any():
                done = live[ended]
                ok = self.final[state[ended]] == 1
                out[done[ok]] = total[ended][ok]
                live, state, total = live[~ended], state[~ended], total[~ended]
                if not len(live):
                    break
            key = state << 8 | flat[starts[live] + step]
            arc = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            there = self._keys[arc] == key
            live, arc = live[there], arc[there]
            total = total[there] + self.outputs[arc]
            state = self.targets[arc].astype(np.int64)
            step += 1
        return out
