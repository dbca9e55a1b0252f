"""Burrows-Wheeler transforms of collections of byte strings, and merging them without re-sorting suffixes.

A shard is the transform of some strings, each closed by an end mark 0 (bytes are 1 to 256); suffixes are ordered
by at most DEPTH symbols, then by place.  Two shards are merged by refining their interleave, at first by the few
symbols that one number holds: at depth k both sides' rows carry the number of the block of equal k-prefixes that
they are in; following the transform k symbols further (pointer doubling of its LF mapping's inverse) and reading the
block number there gives depth 2k.  Each side's rows are in order already, so a round merges two sorted runs and sorts
nothing.  Blocks that hold rows of one side only are settled and leave the work.  The blocks left at the end are the
intervals of common prefixes of full depth.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Shard:
    bwt: np.ndarray  # symbol before each suffix, in suffix order
    sa: np.ndarray  # where each suffix begins in the caller's text
    block: np.ndarray  # number of the block of suffixes equal to full depth; ascending


def _symbols(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all strings, each with its end mark, and for each place the symbols up to the end mark."""
    sizes = np.array([len(s) + 1 for s in strings], dtype=np.int64)
    raw = np.frombuffer(b"\0".join(strings) + b"\0", dtype=np.uint8)
    sym = raw.astype(np.int64) + 1
    ends = np.cumsum(sizes) - 1
    sym[ends] = 0
    return sym, np.repeat(ends, sizes) - np.arange(len(sym))


def _packed(sym: np.ndarray, left: np.ndarray, depth: int) -> tuple[np.ndarray, int, int]:
    """The first symbols of each suffix in one number (zeros after the end mark), how many, and its bits."""
    used = np.zeros(257, dtype=bool)
    used[sym] = True
    used[0] = True
    small = np.cumsum(used) - 1  # keeps order
    sym = small[sym]
    each = max(1, int(small[-1]).bit_length())
    k = min(depth, max(1, (63 - len(sym).bit_length()) // each))
    key = np.zeros(len(sym), dtype=np.int64)
    for j in range(k):
        key <<= each
        n = max(0, len(sym) - j)
        key[:n] |= np.where(left[:n] > j, sym[j:], 0)
    return key, k, k * each


def _sorted(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of non-negative keys of so many bits, and the keys in it; places ride in the low bits where they fit, which sorts fastest."""
    low = len(key).bit_length()
    if bits + low > 63:
        order = np.argsort(key, kind="stable")
        return order, key[order]
    packed = key << low
    packed |= np.arange(len(key))
    packed.sort()
    order = (packed & ((1 << low) - 1)).astype(np.int32)
    packed >>= low
    return order, packed


def _new(sorted_keys: np.ndarray) -> np.ndarray:
    """Whether each sorted key is the first of its block."""
    new = np.empty(len(sorted_keys), dtype=bool)
    new[:1] = True
    np.not_equal(sorted_keys[1:], sorted_keys[:-1], out=new[1:])
    return new


def _heads(new: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For each row the place of its block's first row."""
    first = np.flatnonzero(new)
    return np.repeat(places[first], np.diff(first, append=len(new)))


def _places(n: int) -> np.ndarray:
    return np.arange(n, dtype=np.int32 if n < 1 << 31 else np.int64)


def build(strings: list[bytes], depth: int, first: int = 0) -> Shard:
    """The shard of some strings; ``first`` is where they begin in the caller's text."""
    sym, left = _symbols(strings)
    n = len(sym)
    key, k, bits = _packed(sym, left, depth)
    sa, key = _sorted(key, bits)
    same = _places(n)  # places of blocks of several suffixes, and their blocks: others are done
    new = _new(key)
    inside = head = _heads(new, same)
    rank = np.empty_like(head)
    rank[sa] = head
    room = n.bit_length()
    while k < depth:
        step = min(k, depth - k)
        several = ~new
        several[:-1] |= several[1:]
        same, inside = same[several], inside[several]
        at = sa[same]
        on = left[at] >= k  # a suffix that has ended by now stays with its equals, which have ended too
        if not on.all():
            same, inside, at = same[on], inside[on], at[on]
        if not len(at):
            break
        key = inside.astype(np.int64) << room
        key |= rank[at + step]
        order, key = _sorted(key, 2 * room)
        at = at[order]
        sa[same] = at
        new = _new(key)
        inside = _heads(new, same)
        head[same] = inside
        rank[at] = inside
        k += step
    before = np.where(sa > 0, sym[sa - 1], 0)
    return Shard(before, sa.astype(np.int64) + first, head)


def _following(bwt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the row of the suffix one symbol later, and the row's own first symbol."""
    order = np.argsort(bwt.astype(np.uint16), kind="stable")
    return order, bwt[order]


def _mixed(side: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each row whether its block has rows of both sides; starts are the blocks' first rows."""
    until = np.concatenate([[0], np.cumsum(side)])
    ends = np.append(starts[1:], len(side))
    of_b = until[ends] - until[starts]
    return np.repeat((of_b > 0) & (of_b < ends - starts), ends - starts)


def merge(a: Shard, b: Shard, depth: int) -> Shard:
    """The shard of both collections; ``a``'s suffixes come before equal ones of ``b``."""
    na, nb = len(a.bwt), len(b.bwt)
    n = na + nb
    everywhere = _places(n)
    (fa, sa), (fb, sb) = _following(a.bwt), _following(b.bwt)
    to = np.concatenate([fa, fb + na]).astype(everywhere.dtype)
    first = np.concatenate([sa, sb])
    over = first == 0
    used = np.zeros(257, dtype=bool)
    used[first] = True
    used[0] = True
    each = max(1, int(used.sum() - 1).bit_length())
    key, k = (np.cumsum(used) - 1)[first], 1  # the first k symbols of each row, zeros after the end mark
    jumps = {1: (to, over)}
    while 2 * k <= depth and 2 * k * each <= 63:
        key = key << k * each | np.where(over, 0, key[to])
        to, over = to[to], over | over[to]
        k *= 2
        jumps[k] = to, over
    order = np.argsort(key, kind="stable").astype(everywhere.dtype)  # the interleave at depth k: two ascending runs
    at, rows, new = everywhere, order, _new(key[order])  # what isn't settled: places in the interleave, rows and first rows of blocks
    places = _heads(new, at)
    head = np.empty_like(places)  # block of each row
    head[order] = places
    while k < depth:
        step = min(k, depth - k)
        mixed = _mixed(rows >= na, np.flatnonzero(new))
        at, rows = at[mixed], rows[mixed]
        if not len(at):
            break
        if step in jumps:
            to, over = jumps[step]
        elif 2 * (step // 2) == step and step // 2 in jumps:
            to, over = jumps[step // 2]
            to, over = jumps[step] = to[to], over | over[to]
        else:
            to, over = _composed(jumps, step)
        of_b = rows >= na
        own = np.concatenate([rows[~of_b], rows[of_b]])  # each side in its order
        key = head[own].astype(np.int64) * (n + 1) + np.where(over[own], 0, head[to[own]] + 1)
        again = np.argsort(key, kind="stable")  # two ascending runs: a merge
        rows, key = own[again], key[again]
        order[at] = rows
        new = _new(key)
        places = _heads(new, at)
        head[rows] = places
        k += step
    # blocks of one side are as that side knows them; mixed ones are equal to full depth
    merged_block = head[order]
    new = _new(merged_block)
    mixed = _mixed(order >= na, np.flatnonzero(new))
    fine = np.concatenate([a.block, b.block + na])[order]
    new[1:] |= ~mixed[1:] & (fine[1:] != fine[:-1])
    return Shard(np.concatenate([a.bwt, b.bwt])[order], np.concatenate([a.sa, b.sa])[order], _heads(new, everywhere))


def _composed(jumps: dict, step: int) -> tuple[np.ndarray, np.ndarray]:
    """The jump over ``step`` symbols from jumps over powers of two."""
    out = None
    for bit in range(step.bit_length()):
        if step >> bit & 1:
            to, over = jumps[1 << bit]
            out = (to, over) if out is None else (to[out[0]], out[1] | over[out[0]])
    return out


def repeated_starts(strings: list[bytes], weights: np.ndarray, depth: int, shard_bytes: int) -> list[np.ndarray]:
    """For each string whether the ``depth`` bytes from each place (len - depth + 1 of them) occur with a total weight of 2 or more."""
    shards, own, size, first = [], [], 0, 0
    for i, s in enumerate(strings):
        own.append(s)
        size += len(s) + 1
        if size >= shard_bytes or i == len(strings) - 1:
            shards.append(build(own, depth, first))
            first += size
            own, size = [], 0
    while len(shards) > 1:
        shards = [merge(*shards[i : i + 2], depth) if i + 1 < len(shards) else shards[i] for i in range(0, len(shards), 2)]
    whole = shards[0]
    sizes = np.array([len(s) + 1 for s in strings], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    of = np.repeat(np.arange(len(strings)), sizes)
    left = np.repeat(starts + sizes - 1, sizes) - np.arange(first)
    full = left[whole.sa] >= depth
    at, block = whole.sa[full], whole.block[full]
    total = np.bincount(block, weights=weights[of[at]], minlength=1) if len(at) else np.zeros(1)
    hit = np.zeros(first, dtype=bool)
    hit[at[total[block] >= 2]] = True
    return [hit[a : a + max(0, n - depth)] for a, n in zip(starts, sizes)]
