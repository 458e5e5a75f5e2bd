"""Byte-pair merging of many sequences at once, in flat arrays.

All sequences lie end to end in one array of symbols. A round looks up the rank of every neighbouring pair, takes each
sequence's lowest and applies it everywhere in that sequence at once; of pairs that overlap (as in "aaa") every
second one counts, from the left. Sequences without a known pair leave the array, and what survives are the tokens.
A pair's rank is lower than that of any pair its result can be part of, so this takes the same merges in the same
order as one at a time.
"""

from __future__ import annotations

import numpy as np

#: The rank of no pair.
NONE = np.int32(np.iinfo(np.int32).max)


def byte_names() -> list[str]:
    """The character that stands for each byte: itself where it can be printed, else the next one from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Merges:
    """Merge ranks as sorted pair keys, and the symbols of bytes; the last byte of a sequence may have symbols of its own."""

    def __init__(self, model: dict):
        ids, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        left, right, made = (np.array([ids[x] for x in part], np.int64) for part in ([p[0] for p in pairs], [p[1] for p in pairs], ["".join(p) for p in pairs]))
        self.size = max(ids.values()) + 1
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order].astype(np.uint32 if self.size < 1 << 16 else np.int64), order.astype(np.int32), made.astype(np.int32)
        self.symbol, self.final = (np.array([ids[c + end] for c in byte_names()], np.int32) for end in ("", suffix))
        # of two bytes, the second within the sequence or its last
        self.first, self.closing = (self.ranks(np.repeat(self.symbol, 256), np.tile(second, 256)) for second in (self.symbol, self.final))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair; a negative right symbol is none."""
        kind = self.keys.dtype.type
        key = left.astype(kind) * kind(self.size) + right.astype(kind)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (right >= 0), self.rank[at], NONE)

    def merged(self, data: np.ndarray, sizes: np.ndarray, whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of sequences of bytes that lie end to end, none empty: one after the other, and the number of each.

        Without ``whole`` only the numbers are right.
        """
        count, name = sizes.astype(np.int64), np.arange(len(sizes))
        last = np.cumsum(sizes) - 1
        symbols = self.symbol[data]
        symbols[last] = self.final[data[last]]
        pair = data[:-1].astype(np.int32) << 8 | data[1:]
        rank = np.append(self.first[pair], NONE)
        inner = last[sizes > 1]
        rank[inner - 1] = self.closing[pair[inner - 1]]
        rank[last] = NONE  # no pair crosses a sequence's end
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(name):
            low = np.minimum.reduceat(rank, last - sizes + 1)
            live = low < NONE
            if not live.all():  # sequences that are done leave
                stay = np.repeat(live, sizes)
                if whole:
                    done.append((name[~live], symbols[~stay]))
                count[name[~live]] = sizes[~live]
                symbols, rank = symbols[stay], rank[stay]
                name, sizes, low = name[live], sizes[live], low[live]
                last = np.cumsum(sizes) - 1
                if not len(name):
                    break
            hit = np.flatnonzero(rank == np.repeat(low, sizes))
            # in a run of neighbours that overlap, the first, third, ... are merged
            fresh = np.ones(len(hit), bool)
            fresh[1:] = hit[1:] != hit[:-1] + 1
            begin = np.flatnonzero(fresh)
            place = np.arange(len(hit)) - np.repeat(begin, np.diff(np.append(begin, len(hit))))
            hit = hit[place % 2 == 0]
            symbols[hit] = self.made[rank[hit]]
            stay = np.ones(len(symbols), bool)
            stay[hit + 1] = False
            owner = np.searchsorted(last, hit)
            symbols, rank = symbols[stay], rank[stay]
            sizes = sizes - np.bincount(owner, minlength=len(sizes))
            last = np.cumsum(sizes) - 1
            # only pairs that hold a merged symbol are looked up again
            at = hit - np.arange(len(hit))
            again = np.zeros(len(symbols), bool)
            again[at] = True
            again[at[at > 0] - 1] = True
            at = np.flatnonzero(again)
            other = np.where(at + 1 < len(symbols), symbols[np.minimum(at + 1, len(symbols) - 1)], -1)
            ends = np.zeros(len(symbols), bool)
            ends[last] = True
            other[ends[at]] = -1
            rank[at] = self.ranks(symbols[at], other)
        if not whole or not done:
            return np.zeros(0, np.int32), count
        names, flat = (np.concatenate(p) for p in zip(*done, strict=True))
        order = np.argsort(names, kind="stable")
        begin = (np.cumsum(count[names]) - count[names])[order]
        return gather(flat, begin, count), count


def gather(flat: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs of ``flat`` one after the other, by where they begin and their sizes."""
    return flat[np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
