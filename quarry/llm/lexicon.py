"""Minimal acyclic transducer: a set of byte strings with shared prefixes and suffixes, whose
transitions carry outputs that add up to a word's number, and each number's token ids."""

from __future__ import annotations

import os
import tempfile

import numpy as np


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """The automaton of ``entries`` (word -> token ids) as one block of bytes.

    States are frozen from the end of each word on, in sorted order, so equal suffixes become one
    state (the automaton is minimal). A transition's output is the number of words before it.
    """
    words = sorted(entries)
    register: dict[tuple, int] = {}
    below: list[int] = []  # words accepted from each state
    path: list[list] = [[False, []]]
    previous = b""

    def freeze() -> None:
        state = tuple(map(tuple, path.pop()[1])), final
        number = register.get(state)
        if number is None:
            number = register[state] = len(below)
            below.append(final + sum(below[t] for _, t in state[0]))
        if path:
            path[-1][1].append((previous[len(path) - 1], number))
        else:
            roots.append(number)

    roots: list[int] = []
    for word in words:
        shared = len(os.path.commonprefix([previous, word]))
        while len(path) - 1 > shared:
            final = path[-1][0]
            freeze()
        path.extend([False, []] for _ in word[shared:])
        path[-1][0] = True
        previous = word
    while path:
        final = path[-1][0]
        freeze()

    keys, targets, outs = [], [], []
    finals = np.zeros(len(below), np.int32)
    for (edges, final), number in register.items():
        finals[number] = final
        passed = int(final)
        for label, target in edges:
            keys.append(number * 256 + label)
            targets.append(target)
            outs.append(passed)
            passed += below[target]
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    sizes = [len(entries[w]) for w in words]
    parts = [np.array(keys, np.int64)[order], np.array(targets, np.int32)[order], np.array(outs, np.int32)[order],
             finals, np.concatenate(([0], np.cumsum(sizes))).astype(np.int32),
             np.array([i for w in words for i in entries[w]], np.int32)]
    longest = max(map(len, words), default=0)
    head = np.array([len(p) for p in parts] + [roots[0], longest], np.int64)
    return b"".join(p.tobytes() for p in [head, *parts])


class Lexicon:
    """A compiled automaton, memory-mapped from a file of the process' own temporary folder."""

    def __init__(self, block: bytes) -> None:
        with tempfile.NamedTemporaryFile(prefix="lexicon-") as f:  # unlinked once mapped
            f.write(block)
            f.flush()
            data = np.memmap(f.name, dtype=np.uint8, mode="r").view(np.ndarray)
        head = data[:64].view(np.int64)
        at = 64
        parts = []
        for size, kind in zip(head, (np.int64, np.int32, np.int32, np.int32, np.int32, np.int32)):
            width = int(size) * np.dtype(kind).itemsize
            parts.append(data[at:at + width].view(kind))
            at += width
        self.keys, self.targets, self.outs, self.finals, self.offsets, self.ids = parts
        self.root, self.longest = int(head[6]), int(head[7])

    def lookup(self, words: list[bytes]) -> np.ndarray:
        """Each word's number, -1 if the automaton doesn't accept it: all words walk in step."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        out = np.zeros(len(words), np.int64)
        if not len(words):
            return out
        text = np.frombuffer(b"".join(words), np.uint8)
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        states = np.full(len(words), self.root, np.int64)
        states[sizes > self.longest] = -1
        if len(self.keys):
            for depth in range(min(self.longest, int(sizes.max()))):
                live = np.flatnonzero((sizes > depth) & (states >= 0))
                if not len(live):
                    break
                key = states[live] * 256 + text[starts[live] + depth]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = self.keys[at] == key
                states[live] = np.where(hit, self.targets[at], -1)
                out[live] += np.where(hit, self.outs[at], 0)
        else:
            states[sizes > 0] = -1
        accepted = (states >= 0) & (self.finals[np.maximum(states, 0)] > 0)
        return np.where(accepted, out, -1)

    def token_bytes(self, number: int) -> bytes:
        """A word's int32 ids, as bytes."""
        return self.ids[self.offsets[number]:self.offsets[number + 1]].tobytes()
