"""Language-model scoring: logistic mixing of hashed-context bit predictors, beside a unigram base.

A byte is coded as a path of bits in a Huffman-shaped tree of the byte before. For each bit, predictors look up how
often it was 1 in their context (the bytes before, or the word so far), and one looks for the same
six bytes earlier in the document; their log-odds are added with weights that a gate selects, and
the weights are refined along each document.
"""

import heapq
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropmosaic.llm.common import fold, stored

#: Preceding bytes that are the context of a predictor ("word": the word so far), and the bits of the
#: predictor's table index. The tables, and so the model, have a fixed size.
CONTEXTS = (3, 5, "word")
TABLE_BITS = (20, 22, 23)
RANGE_BITS = 16
#: Bytes that must agree with an earlier place of the document to guess the next one from it, and the
#: log-odds of the guess by how often in a row it came true: never, up to 3, up to 15 times, more.
MATCH, MATCH_ODDS = 6, np.array([0.5, 1.5, 3.0, 5.0], np.float32)
#: Training documents at most whose slopes are worked out together when the weights are set; all of them are read, whole.
TUNING_DOCUMENTS = 4096
#: The weight that all inputs start with, and what is added to the curvature so that a gate with few bits stays near it.
START, RIDGE = 0.3, 20.0
#: Tokens with at least 1 / FREQUENT of all occurrences, of which there are at most FREQUENT, are broadcast with
#: their counts; all others are joined by a shuffle.
FREQUENT = 1 << 20
#: Bytes worked on together (arrays of that size stay in the cache), bytes between corrections of a
#: document's weights, bytes in front of a piece that are context only, and bytes whose words are held at once.
PIECE_BYTES, BLOCK_BYTES, LEFT, WORDS_BYTES = 1 << 17, 512, 64, 1 << 21
#: Tokens counted together before they are handed on.
TOKENS = 1 << 19
#: Bytes scored together.
GROUP_BYTES = 1 << 19
#: Bytes counted together.
COUNTED_BYTES = 1 << 20
#: Kinds of bytes (equal in contexts and byte) that a task holds at a time: a kind is worked out once while it is
#: held. It is found by the first bits of its hash, so a kind may be driven out by another and come back.
KINDS_HELD, PLACE_BITS = 1 << 20, 20
#: Kinds whose arrays are worked out together.
KINDS_CACHED = 1 << 14
#: Bytes whose arrays are worked out together.
CACHED_BYTES = 1 << 16
#: Log-odds are kept in steps of 1 / SCALE in a byte, so that a table stays in a core's cache.
SCALE = 12.0
PRIOR, RATE, END = 0.15, 0.03, 255
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_POWER = 0x5851F42D4C957F2D
N_INPUTS = len(CONTEXTS) + 2
DEPTHS, KINDS = 4, 7
#: The last inputs (word and earlier place) have weights that each document refines for itself.
REFINED = 2


@dataclass
class Tree:
    """Codes of all pairs (byte before, byte): their steps end to end.

    mark (twice the node's number, plus the bit), prior log-odds (of the step's bit) and gate of each step; of a pair
    256 * before + byte, at and size are where its steps begin and how many they are, code its bits, first bit highest.
    """

    mark: np.ndarray
    prior: np.ndarray
    gate: np.ndarray
    at: np.ndarray
    size: np.ndarray
    code: np.ndarray


def _paths(weight: np.ndarray) -> list[list[tuple[int, int, float]]]:
    """(node, bit, log-odds of 1) for each step to each byte, in the Huffman tree of the weights."""
    heap = [(int(w), i, i) for i, w in enumerate(weight)]
    heapq.heapify(heap)
    children: dict[int, tuple[int, int, float]] = {}
    fresh = 256
    while len(heap) > 1:
        (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
        children[fresh] = (x, y, math.log(b / a))
        heapq.heappush(heap, (a + b, fresh, fresh))
        fresh += 1
    paths: list[list[tuple[int, int, float]]] = [[] for _ in range(256)]
    open_: list[tuple[int, list[tuple[int, int, float]]]] = [(heap[0][2], [])]
    while open_:
        n, path = open_.pop()
        if n < 256:
            paths[n] = path
            continue
        x, y, odds = children[n]
        open_ += [(x, [*path, (n - 256, 0, odds)]), (y, [*path, (n - 256, 1, odds)])]
    return paths


def build_tree(pairs: np.ndarray) -> Tree:
    """One Huffman-shaped tree for each byte before, from counts of byte pairs (256 x 256).

    All bytes get a path in all trees; where a byte before was seldom seen, the counts of all
    bytes fill in. Weights are halved until no path has more than 32 steps.
    """
    common = pairs.sum(axis=0) * 256.0 / max(1, pairs.sum())
    steps: list[tuple[int, int, int, float]] = []
    size, code = np.zeros(65536, np.int64), np.zeros(65536, np.uint32)
    for before in range(256):
        weight = 1 + 32 * pairs[before].astype(np.int64) + common.astype(np.int64)
        paths = _paths(weight)
        while max(map(len, paths)) > 32:
            weight = weight // 2 + 1
            paths = _paths(weight)
        for byte, path in enumerate(paths):
            size[256 * before + byte] = len(path)
            code[256 * before + byte] = sum(bit << (31 - i) for i, (_, bit, _) in enumerate(path))
            # nodes near the root get the smallest numbers: a context's slots for them stand side by side
            steps += [(before, 254 - node, bit, odds) for node, bit, odds in path]
    before, node, bit, prior = (np.array(v) for v in zip(*steps))
    mixed = (before.astype(np.uint32) * np.uint32(0x9E3779B1) >> np.uint32(20)).astype(np.int64)
    mark = (mixed << 8 | node) << 1 | bit
    at = np.cumsum(size) - size
    depth = np.minimum(np.arange(len(mark)) - np.repeat(at, size), DEPTHS - 1)
    gate = (_KIND[before] * DEPTHS + depth).astype(np.uint8)
    return Tree(mark, (prior * (2 * bit - 1)).astype(np.float32), gate, at, size, code)


def pair_counts(texts: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(b"\0" + t + bytes([END]) for t in texts), np.uint8).astype(np.int64)
    return np.bincount(256 * data[:-1] + data[1:], minlength=65536).reshape(256, 256)


def _kinds() -> np.ndarray:
    kind = np.full(256, 4, np.int64)
    kind[97:123], kind[65:91], kind[48:58], kind[128:] = 0, 1, 2, 3
    kind[[32]], kind[[0, 9, 10, 11, 12, 13]] = 5, 6
    return kind


_KIND = _kinds()
_GAP = np.zeros(256, bool)
_GAP[[0, 9, 10, 11, 12, 13, 32]] = True
_INVERSE = pow(_POWER, -1, 1 << 64)


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _upto(data: np.ndarray) -> np.ndarray:
    """Every byte and the seven in front of it as a number, the byte itself highest."""
    wide = np.zeros(len(data) + 7, np.uint8)
    wide[7:] = data
    return np.ndarray(len(data), "<u8", wide, 0, (1,)).astype(np.uint64)


def _words(data: np.ndarray) -> np.ndarray:
    """A 64-bit number of the word in front of every position (LEFT bytes in front are context only)."""
    n = len(data)
    whole = 1 << n.bit_length()
    start = np.arange(1, n + 1)
    start *= _GAP.take(data)
    np.maximum.accumulate(start, out=start)  # the word that goes on after each byte
    sums = np.zeros(n + 1, np.uint64)
    added = data.astype(np.uint64)
    added += np.uint64(1)
    added *= _powers(_POWER, whole)[:n]
    np.cumsum(added, out=sums[1:])
    begin = np.concatenate((np.zeros(1, np.int64), start[:-1]))
    word = sums[:-1] - sums.take(begin)
    word *= _powers(_INVERSE, whole).take(begin)
    return word


def _spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... for each, as many (at least one) as size says."""
    if not len(size):
        return np.zeros(0, np.int64)
    first = np.cumsum(size, dtype=np.int64)
    out = np.ones(first[-1], np.int64)
    first -= size
    out[first[1:]] = begin[1:] - begin[:-1] - size[:-1] + 1
    out[0] = begin[0]
    return np.cumsum(out, out=out)


def _steps(tree: Tree, data: np.ndarray) -> np.ndarray:
    """Indexes into the tree's steps for the bits of the pairs in data."""
    return _spread(tree.at.take(data), tree.size.take(data))


def slot(k: int, upto: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The table index of predictor k for bytes with those bytes in front of them (_upto) and that word."""
    number = word + np.uint64(k + 1)
    if CONTEXTS[k] != "word":
        np.left_shift(upto, np.uint64(8), out=number)
        number >>= np.uint64(64 - 8 * CONTEXTS[k])
        number += np.uint64(k + 1)
    number *= _MIX
    number ^= number >> np.uint64(29)
    number *= _MIX
    number >>= np.uint64(64 - TABLE_BITS[k])
    return number.view(np.int64)


def _pair(upto: np.ndarray) -> np.ndarray:
    """256 * byte before + byte."""
    return upto << np.uint64(8) >> np.uint64(56) << np.uint64(8) | upto >> np.uint64(56)


def _starts(key: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers begin."""
    fresh = np.ones(len(key), bool)
    np.not_equal(key[1:], key[:-1], out=fresh[1:])
    return np.flatnonzero(fresh)


def _slices(text: bytes) -> Iterator[tuple[np.ndarray, int]]:
    """The text with its end mark in slices of PIECE_BYTES, each with up to LEFT bytes of context in front, and their number."""
    whole = bytes(LEFT) + text + bytes([END])
    for lo in range(LEFT, len(whole), PIECE_BYTES):
        yield np.frombuffer(whole[lo - LEFT : lo + PIECE_BYTES], np.uint8), LEFT


class Kinds:
    """The kinds of bytes met so far: bytes equal in the six bytes up to them, in the word in front and, with matches, in the guess.

    Of each: the bytes up to it, word, pair, how sure the guess is (-1: none), how many bits it has right, how often it
    was met. Kinds are told apart by 64-bit hashes, of which a table of fixed size holds the last for each place.
    """

    def __init__(self, tree: Tree, matches: bool):
        self.tree, self.matches = tree, matches
        self.upto, self.word = np.empty(KINDS_HELD, np.uint64), np.empty(KINDS_HELD, np.uint64)
        self.hash, self.often = np.empty(KINDS_HELD, np.uint64), np.zeros(KINDS_HELD, np.int64)
        self.coded, self.sure, self.agree = np.empty(KINDS_HELD, np.int32), np.empty(KINDS_HELD, np.int8), np.empty(KINDS_HELD, np.int8)
        self.owner = np.zeros(1 << PLACE_BITS, np.int32)
        self.clear()

    def clear(self) -> None:
        self.size, self.met = 0, []
        self.often[:] = 0
        # what cannot stand at a place: a hash whose first bits are others
        self.known = ~(np.arange(1 << PLACE_BITS, dtype=np.uint64) << np.uint64(64 - PLACE_BITS))

    def full(self, n: int) -> bool:
        """Whether n more bytes may find no room."""
        return self.size + n > KINDS_HELD

    def add(self, full: np.ndarray, columns: dict[str, np.ndarray], at: np.ndarray) -> np.ndarray:
        """The kind of each byte, by the hashes of kinds; columns, of which at are the bytes' places, describe them."""
        place = (full >> np.uint64(64 - PLACE_BITS)).view(np.int64)
        found = self.owner.take(place)
        new = np.flatnonzero(self.known.take(place) != full)
        if len(new):
            bits = np.uint64(len(new).bit_length())
            own = full.take(new)
            key = own >> bits
            key <<= bits
            key |= np.arange(len(new), dtype=np.uint64)
            key.sort()
            key &= (np.uint64(1) << bits) - np.uint64(1)
            order = key.view(np.int64)
            own = own.take(order)
            fresh = np.ones(len(new), bool)
            np.not_equal(own[1:], own[:-1], out=fresh[1:])
            number = np.cumsum(fresh, dtype=np.int32)
            number += np.int32(self.size - 1)
            start = np.flatnonzero(fresh)
            found[new.take(order)] = number
            first = new.take(order.take(start))
            to = slice(self.size, self.size + len(start))
            self.hash[to] = own.take(start)
            where = at.take(first)
            for name, column in columns.items():
                getattr(self, name)[to] = column.take(where)
            place = place.take(first)
            self.owner[place] = np.arange(to.start, to.stop, dtype=np.int32)
            self.known[place] = self.hash.take(self.owner.take(place))
            self.size = to.stop
        return found

    def count(self, found: np.ndarray) -> None:
        """Bytes of those kinds were met; added up from time to time."""
        self.met.append(found)
        if sum(map(len, self.met)) >= KINDS_HELD:
            self.settle()

    def settle(self) -> None:
        if self.met:
            self.often += np.bincount(np.concatenate(self.met), minlength=KINDS_HELD)
            self.met = []

    def inputs(self, lo: int, tables: list[np.ndarray], signed: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """The inputs for all bits of the kinds from lo on, some kinds at a time: which kinds, the bits of each, gate and
        log-odds of the bit that came (inputs x bits) of their bits, end to end.

        Kinds come in order of the bytes before, so that those next to each other look up much the same table entries.
        tables hold the log-odds of the bit that came (slots x 2) or, signed, of a 1 (slots).
        """
        tree = self.tree
        key = self.upto[lo : self.size] << np.uint64(8)
        key &= ~np.uint64((1 << 24) - 1)
        key |= np.arange(len(key), dtype=np.uint64)
        key.sort()
        key &= np.uint64((1 << 24) - 1)
        order = key.view(np.int64)
        order += lo
        for cut in range(0, len(order), KINDS_CACHED):
            which = order[cut : cut + KINDS_CACHED]
            coded, upto, word = self.coded.take(which), self.upto.take(which), self.word.take(which)
            size, at = tree.size.take(coded), tree.at.take(coded)
            steps = _spread(at, size)
            mark = tree.mark.take(steps)
            x = np.empty((N_INPUTS, len(steps)), np.float32)
            tree.prior.take(steps, out=x[0], mode="clip")
            scale = np.float32(1 / SCALE)
            if signed:
                scale = (mark & 1).astype(np.float32)
                scale *= np.float32(2 / SCALE)
                scale -= np.float32(1 / SCALE)
                mark >>= 1
            for k, table in enumerate(tables):
                index = slot(k, upto, word)
                if not signed:
                    index <<= 1
                index = np.repeat(index, size)
                index ^= mark
                np.multiply(table.take(index), scale, out=x[k + 1])
            x[-1] = 0
            if self.matches:
                some = np.flatnonzero(self.sure.take(which) >= 0)
                few = which.take(some)
                _guessed(x[-1], (np.cumsum(size) - size).take(some), size.take(some), self.sure.take(few), self.agree.take(few))
            yield which, size, tree.gate.take(steps), x


def _guessed(out: np.ndarray, begin: np.ndarray, size: np.ndarray, sure: np.ndarray, agree: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Set the log-odds that a guess gives the bits of bytes, which begin at begin; the places that were set, how many of each byte."""
    told = np.minimum(agree + np.int64(1), size)  # from the first bit that differs, the guess says nothing more
    where = _spread(begin, told)
    out[where] = np.repeat(MATCH_ODDS.take(sure), told)
    wrong = agree < size
    out[(begin + agree)[wrong]] *= -1
    return where, told


def _blocks(parts: list[np.ndarray], size: int = CACHED_BYTES) -> Iterator[list[np.ndarray]]:
    """Parts that follow each other, in lists of about `size` bytes."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part)
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def seen(kinds: Kinds, parts: list[np.ndarray], guesses: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Kind and pair of the bytes of parts (each with LEFT bytes of context in front), part after part, and with guesses how
    sure the guess from an earlier place is (-1: none) and how many bits it has right."""
    tree, data, lengths = kinds.tree, np.concatenate(parts), np.array([len(p) for p in parts])
    real = _spread(np.cumsum(lengths) - lengths + LEFT, lengths - LEFT)
    upto, word = _upto(data), _words(data)
    coded = np.empty(len(data), np.int32)
    coded[0] = data[0]
    np.left_shift(data[:-1], 8, out=coded[1:], dtype=np.int32)
    coded[1:] |= data[1:]
    full = upto >> np.uint64(16)
    full *= _MIX
    full ^= full >> np.uint64(32)
    full += word
    columns = {"upto": upto, "word": word, "coded": coded}
    sure = agree = np.zeros(0, np.int8)
    if guesses:
        guess, sure = _guesses(data, upto, lengths)
        agree = np.zeros(len(data), np.int8)
        some = np.flatnonzero(sure >= 0)
        few = coded.take(some)
        agree[some] = _same_bits(tree.code.take(few), tree.code.take((few & 0xFF00) | guess.take(some)))
        if kinds.matches:
            columns |= {"sure": sure, "agree": agree}
            full[some] += ((sure.take(some) + 1).astype(np.uint64) << np.uint64(40)) + (agree.take(some).astype(np.uint64) << np.uint64(48))
        sure, agree = sure.take(real), agree.take(real)
    full *= _MIX
    full ^= full >> np.uint64(31)
    full *= _MIX
    full ^= full >> np.uint64(32)
    return kinds.add(full.take(real), columns, real), coded.take(real), sure, agree


class Counts:
    """How often each slot saw a 0 and a 1."""

    def __init__(self, tree: Tree):
        self.tree = tree
        self.seen = [np.zeros(2 << bits, np.int32) for bits in TABLE_BITS]
        self.texts: list[np.ndarray] = []
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = self.waiting = 0

    def add(self, text: bytes) -> None:
        for data, _ in _slices(text):
            self.texts.append(data)
            self.waiting += len(data)
            if self.waiting >= CACHED_BYTES:
                self._look()
                if self.size >= COUNTED_BYTES:
                    self._count()

    def flush(self) -> None:
        if self.texts:
            self._look()
        if self.held:
            self._count()

    def _look(self) -> None:
        data, lengths = np.concatenate(self.texts), np.array([len(d) for d in self.texts])
        real = _spread(np.cumsum(lengths) - lengths + LEFT, lengths - LEFT)
        upto, word = _upto(data), _words(data)
        number = slot(CONTEXTS.index("word"), upto, word)
        number <<= 16
        number |= _pair(upto).view(np.int64)
        # the three bytes before, the byte, the two in front of those: equal contexts of either length stand together
        key = upto << np.uint64(8) >> np.uint64(40) << np.uint64(24)
        key |= upto >> np.uint64(56) << np.uint64(16)
        key |= upto >> np.uint64(16) & np.uint64(0xFFFF)
        self.held.append((key.take(real), number.take(real)))
        self.size += len(real)
        self.texts, self.waiting = [], 0

    def _count(self) -> None:
        key, number = (np.concatenate(v) for v in zip(*self.held))
        self.held, self.size = [], 0
        key.sort()  # in order, equal ones stand together and a table is walked through once instead of at random
        first = _starts(key)
        often, key = np.diff(first, append=len(key)), key.take(first)
        byte = key >> np.uint64(16) & np.uint64(0xFF)
        upto = byte << np.uint64(56) | key >> np.uint64(24) << np.uint64(32) | (key & np.uint64(0xFFFF)) << np.uint64(16)
        for k, context in enumerate(CONTEXTS):
            if context == "word":
                number.sort()
                first = _starts(number)
                self._add(k, number.take(first) >> 16, number.take(first) & 0xFFFF, np.diff(first, append=len(number)))
            else:
                start = _starts(key >> np.uint64(16)) if context == 3 else np.arange(len(key))
                few = upto.take(start)
                self._add(k, slot(k, few, few), _pair(few).view(np.int64), np.add.reduceat(often, start))

    def _add(self, k: int, index: np.ndarray, pair: np.ndarray, often: np.ndarray) -> None:
        size = self.tree.size.take(pair)
        where = np.repeat(index << 1, size)
        where ^= self.tree.mark.take(_steps(self.tree, pair))
        np.add.at(self.seen[k], where, np.repeat(often.astype(np.int32), size))

    def parts(self) -> Iterator[tuple[int, int, bytes]]:
        """predictor, range, packed (slot, zeros, ones) of what was seen."""
        self.flush()
        for k, seen in enumerate(self.seen):
            pairs = seen.reshape(-1, 1 << RANGE_BITS, 2)
            for r, part in enumerate(pairs):
                at = np.flatnonzero(part.any(axis=1))
                if len(at):
                    yield k, r, packed(at, part[at, 0], part[at, 1])


def packed(at: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> bytes:
    """Slots (ascending) and counts as compressed 32-bit numbers, the high bytes, mostly zero, together."""
    rows = np.stack((np.diff(at, prepend=0), zeros, ones)).astype("<u4")
    return zlib.compress(np.ascontiguousarray(rows.view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    steps, zeros, ones = np.ascontiguousarray(planes.T).view("<u4").reshape(3, -1).astype(np.int64)
    return np.cumsum(steps), zeros, ones


def _tokens(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the different tokens of bodies; for every token, body after body, which of them it is; tokens of each body."""
    lower = pc.ascii_lower(pa.array(bodies, pa.binary()).view(pa.string()))
    split = pc.ascii_split_whitespace(lower)
    each = np.diff(split.offsets.to_numpy())
    words = split.values.dictionary_encode()
    names, number = words.dictionary.view(pa.binary()).to_pylist(), words.indices.to_numpy()
    if b"" in names:  # what stands before a gap at the start, and behind one at the end
        empty = number == names.index(b"")
        each = each - np.bincount(np.repeat(np.arange(len(bodies)), each)[empty], minlength=len(bodies))
        number = number[~empty]
    return np.array([_hash(t) for t in names], np.int64), number, each


def _hash(token: bytes) -> int:
    return xxhash.xxh64_intdigest(token, 7) - (1 << 63)


def _pieces(bodies: pd.Series, size: int) -> Iterator[np.ndarray]:
    """Places of bodies that follow each other, in parts of about `size` bytes."""
    cut = (bodies.map(len).cumsum() // size).to_numpy()
    return (part for part in np.split(np.arange(len(bodies)), np.flatnonzero(np.diff(cut)) + 1) if len(part))


def count_tokens(docs: DataFrame) -> DataFrame:
    """One pass over docs (body, train): token counts by hash (kind -1), and a task's counts of byte pairs (kind -2) of training documents.

    The token count is handed on whenever it has grown large.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs = np.zeros((256, 256), np.int64)
        held: list[np.ndarray] = [np.zeros((3, 0), np.int64)]

        def summed() -> np.ndarray:
            rows = np.concatenate(held, axis=1)
            rows = rows[:, rows[0].argsort()]
            first = np.flatnonzero(np.concatenate((np.ones(min(1, rows.shape[1]), bool), rows[0, 1:] != rows[0, :-1])))
            return np.stack((rows[0, first], *np.add.reduceat(rows[1:], first, axis=1))) if len(first) else rows

        def tokens() -> pd.DataFrame:
            found = summed()
            return pd.DataFrame({"kind": -1, "hash": found[0], "trained": found[1], "everywhere": found[2], "data": None})

        for batch in batches:
            for part in _pieces(batch["body"], WORDS_BYTES):
                piece = batch.iloc[part]
                bodies, train = list(piece["body"]), piece["train"].to_numpy(bool)
                hashed, number, each = _tokens(bodies)
                rows = np.stack((hashed, np.bincount(number[np.repeat(train, each)], minlength=len(hashed)), np.bincount(number, minlength=len(hashed))))
                held.append(rows[:, rows[2] > 0])
                learned = [body for body, t in zip(bodies, train) if t]
                if learned:
                    pairs += pair_counts(learned)
                if sum(h.shape[1] for h in held) > 2 * TOKENS:
                    held = [summed()]
                    if held[0].shape[1] > TOKENS:
                        yield tokens()
                        held = [np.zeros((3, 0), np.int64)]
        yield tokens()
        if pairs.any():
            at = np.flatnonzero(pairs)
            data = np.stack((at, pairs.ravel()[at])).tobytes()
            yield pd.DataFrame({"kind": [-2], "hash": [0], "trained": [0], "everywhere": [0], "data": [data]})

    return docs.mapInPandas(run, "kind int, hash long, trained long, everywhere long, data binary")


def total_pairs(counted: DataFrame) -> np.ndarray:
    """The byte pairs of all tasks of count_tokens: 65,536 sums at most."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs = np.zeros(65536, np.int64)
        for batch in batches:
            for data in batch["data"]:
                at, often = np.frombuffer(data, np.int64).reshape(2, -1)
                pairs[at] += often
        at = np.flatnonzero(pairs)
        yield pd.DataFrame({"at": at, "often": pairs[at]})

    each = counted.filter("kind = -2").select("data").mapInPandas(run, "at int, often long")
    found = each.groupBy("at").agg(F.sum("often").alias("often")).toPandas()
    pairs = np.zeros(65536, np.int64)
    pairs[found["at"].to_numpy(np.int64)] = found["often"].to_numpy(np.int64)
    return pairs.reshape(256, 256)


def count(docs: DataFrame, tree: Tree) -> DataFrame:
    """One pass over training documents (body): rows (kind, part, data) of context counts; a task adds up what it reads in tables of fixed size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = None
        for batch in batches:
            for body in batch["body"]:
                seen = seen or Counts(tree)
                seen.add(body)
        found = list(seen.parts()) if seen else []
        for lo in range(0, len(found), 16):
            k, r, data = zip(*found[lo : lo + 16])
            yield pd.DataFrame({"kind": k, "part": r, "data": data})

    return docs.select("body").mapInPandas(run, "kind int, part int, data binary")


def quantized(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(SCALE * np.log((ones + PRIOR) / (zeros + PRIOR))), -127, 127).astype(np.int8)


def without_itself(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log-odds of the bit that came, 0 or 1, at each slot (slots x 2), from all counts but that one occurrence."""
    zero = quantized(ones, np.maximum(zeros - 1, 0))
    return np.stack((zero, quantized(zeros, np.maximum(ones - 1, 0))), axis=1)


def merge(counted: DataFrame) -> DataFrame:
    """(kind, part, odds, apart): log-odds of every slot in a byte each, and those without the occurrence looked at.

    A task holds the dense ranges it is dealt, streams the rest.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for k, r, data in zip(batch["kind"], batch["part"], batch["data"]):
                at, zeros, ones = unpacked(data)
                own = total.setdefault((k, r), np.zeros((2, 1 << RANGE_BITS), np.int64))
                own[0][at] += zeros
                own[1][at] += ones
        for (k, r), own in total.items():
            odds, apart = quantized(own[0], own[1]), without_itself(own[0], own[1])
            yield pd.DataFrame({"kind": [k], "part": [r], "odds": [odds.tobytes()], "apart": [apart.tobytes()]})

    dealt = counted.filter("kind >= 0").select("kind", "part", "data").repartition("kind", "part")
    return dealt.mapInPandas(run, "kind int, part int, odds binary, apart binary")


@dataclass
class Model:
    tree: Tree
    odds: list[np.ndarray]
    weights: np.ndarray
    apart: list[np.ndarray] | None = None

    @cached_property
    def kinds(self) -> "_Kinds":
        return _Kinds(self)


def _same_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading bits two codes have in common."""
    x = a ^ b
    for shift in (1, 2, 4, 8, 16):
        x |= x >> np.uint32(shift)
    return 32 - np.bitwise_count(x).astype(np.int64)


def _guesses(data: np.ndarray, upto: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the byte that followed the last time the MATCH bytes before it stood in its part, and how sure (-1: none)."""
    place = np.arange(len(data))
    part = np.repeat(np.arange(len(lengths), dtype=np.uint64), lengths)
    part <<= np.uint64(8 * MATCH)
    number = upto << np.uint64(8)
    number >>= np.uint64(64 - 8 * MATCH)
    number |= part
    # sorted by a hash of part and bytes, with the place in the low bits; the numbers themselves are compared after that
    bits = np.uint64(len(data).bit_length())
    key = number * _MIX
    key ^= key >> np.uint64(31)
    key *= _MIX
    key >>= bits
    key <<= bits
    key |= place.view(np.uint64)
    key.sort()
    key &= (np.uint64(1) << bits) - np.uint64(1)
    order = key.view(np.int64)
    number = number.take(order)
    old = order[:-1].copy()
    old[number[1:] != number[:-1]] = -1
    before = np.empty(len(data), np.int64)
    before[order[1:]] = old
    before[order[0]] = -1
    before[before < np.repeat(np.cumsum(lengths) - lengths + LEFT, lengths)] = -1
    guess = data.take(np.maximum(before, 0))
    none = before < 0
    place[~(none | (guess != data))] = 0
    failed = np.maximum.accumulate(place)
    run = np.zeros(len(data), np.int64)
    np.subtract(np.arange(len(data) - 1), failed[:-1], out=run[1:])
    sure = (run >= 1).astype(np.int8) + (run >= 4) + (run >= 16)
    sure[none] = -1
    return guess, sure


class Slopes:
    """gates x inputs x (1 + inputs): slope of texts' log-probability by the weights at START, and its curvature.

    Each bit's table entries leave that one occurrence out of the counts.
    """

    def __init__(self, model: Model):
        self.model, self.kinds = model, Kinds(model.tree, True)
        self.total = np.zeros((DEPTHS * KINDS, N_INPUTS, 1 + N_INPUTS))

    def add(self, texts: list[bytes]) -> None:
        for parts in _blocks([data for t in texts for data, _ in _slices(t)]):
            if self.kinds.full(sum(map(len, parts))):
                self.flush()
            self.kinds.count(seen(self.kinds, parts, True)[0])

    def flush(self) -> np.ndarray:
        """The sums so far, with what is held."""
        kinds = self.kinds
        kinds.settle()
        weights = np.full(N_INPUTS, START, np.float32)
        for which, size, gate, x in kinds.inputs(0, self.model.apart, False):
            order = gate.argsort(kind="stable")
            edges = np.searchsorted(gate.take(order), np.arange(DEPTHS * KINDS + 1))
            miss = 1 / (1 + np.exp(np.clip(weights @ x, -12, 12)))
            often = np.repeat(kinds.often.take(which).astype(np.float32), size)
            curve = miss * (1 - miss)
            miss *= often
            curve *= often
            miss, curve, x = miss.take(order), curve.take(order), x.take(order, axis=1)
            curved = x * curve
            for g in np.flatnonzero(np.diff(edges)):
                own = slice(edges[g], edges[g + 1])
                self.total[g, :, 0] += x[:, own] @ miss[own]
                self.total[g, :, 1:] += curved[:, own] @ x[:, own].T
        kinds.clear()
        return self.total


def slopes(model: Model, texts: list[bytes]) -> np.ndarray:
    """The slopes and curvatures of these texts."""
    both = Slopes(model)
    both.add(texts)
    return both.flush()


def tune(docs: DataFrame, model: Model) -> None:
    """Set the gated weights by one Newton step over the slopes and curvatures of all training documents (body), whole."""
    shared = docs.sparkSession.sparkContext.broadcast((vars(model.tree), model.apart))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, apart = shared.value
        model = Model(Tree(**tree), [], np.empty(0), apart)
        both = Slopes(model)
        for batch in batches:
            bodies = batch["body"]
            for lo in range(0, len(bodies), TUNING_DOCUMENTS):
                both.add(list(bodies.iloc[lo : lo + TUNING_DOCUMENTS]))
        total = both.flush()
        yield pd.DataFrame({"at": np.arange(total.size), "value": total.ravel()})

    each = docs.select("body").mapInPandas(run, "at int, value double")
    found = each.groupBy("at").agg(F.sum("value").alias("value")).toPandas()
    shared.unpersist()
    total = np.zeros(DEPTHS * KINDS * N_INPUTS * (1 + N_INPUTS))
    total[found["at"].to_numpy(np.int64)] = found["value"]
    model.weights = fitted(total.reshape(DEPTHS * KINDS, N_INPUTS, 1 + N_INPUTS))


def fitted(total: np.ndarray) -> np.ndarray:
    slope, curve = total[:, :, :1], total[:, :, 1:] + RIDGE * np.eye(N_INPUTS)
    return START + np.linalg.solve(curve, slope)[:, :, 0]


class _Kinds:
    """Weighted inputs of the kinds of bytes met so far, bit by bit, but for the earlier place, and where each kind's bits begin."""

    def __init__(self, model: Model):
        self.model, self.kinds = model, Kinds(model.tree, False)
        self.weights = model.weights.astype(np.float32)
        self.first = np.empty(KINDS_HELD, np.int64)
        self.bits = np.empty((4 * KINDS_HELD, REFINED), np.float32)
        self.used = 0

    def look(self, parts: list[np.ndarray]) -> "_Lookup":
        kinds = self.kinds
        if kinds.full(sum(map(len, parts))) or self.used > 3 * KINDS_HELD:
            kinds.clear()
            self.used = 0
        old = kinds.size
        found = [seen(kinds, block, True) for block in _blocks(parts)]
        more = int(kinds.tree.size.take(kinds.coded[old : kinds.size]).sum())
        if self.used + more > len(self.bits):
            self.bits = np.concatenate((self.bits, np.empty((self.used + more - len(self.bits), REFINED), np.float32)))
        for which, size, gate, x in kinds.inputs(old, self.model.odds, True):
            fixed = self.weights[:, 0].take(gate)
            fixed *= x[0]
            for k in range(1, N_INPUTS - 1):
                fixed += self.weights[:, k].take(gate) * x[k]
            to = slice(self.used, self.used + len(gate))
            self.bits[to, 0], self.bits[to, 1] = fixed, x[-2]
            self.first[which] = np.cumsum(size) - size + self.used
            self.used = to.stop
        return _Lookup(self, *map(np.concatenate, zip(*found)))


@dataclass
class _Lookup:
    """The bytes of parts, part after part: kind, pair, how sure the guess from an earlier place is (-1: none), how many bits it has right."""

    kinds: _Kinds
    number: np.ndarray
    coded: np.ndarray
    sure: np.ndarray
    agree: np.ndarray

    def inputs(self, places: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """For the bits of the bytes at those places: weighted log-odds of the bit that came, the refined inputs, bits of each byte."""
        kinds, coded, sure = self.kinds, self.coded.take(places), self.sure.take(places)
        size = kinds.model.tree.size.take(coded)
        found = kinds.bits.take(_spread(kinds.first.take(self.number.take(places)), size), axis=0)
        fixed, word = found[:, 0].copy(), found[:, 1].copy()
        match = np.zeros(len(fixed), np.float32)
        some = np.flatnonzero(sure >= 0)
        begin, few = (np.cumsum(size) - size).take(some), coded.take(some)
        where, told = _guessed(match, begin, size.take(some), sure.take(some), self.agree.take(places.take(some)))
        gate = kinds.model.tree.gate.take(_spread(kinds.model.tree.at.take(few), told))
        fixed[where] += match[where] * kinds.weights[:, -1].take(gate)
        return fixed, [word, match], size


def score_texts(model: Model, texts: list[bytes], rate: float = RATE) -> np.ndarray:
    """log2 probability of each text with its end mark.

    All texts of a batch advance together in blocks of BLOCK_BYTES. Each has corrections of its
    own to the weights, which follow the error of the blocks before.
    """
    result = np.zeros(len(texts))
    group: list[tuple[int, np.ndarray]] = []
    held = 0
    for i, text in sorted(enumerate(texts), key=lambda t: len(t[1])):  # texts of like length together need the fewest steps
        if len(text) >= PIECE_BYTES:  # by itself, slice after slice
            shift = np.zeros((1, N_INPUTS))
            for data, _ in _slices(text):
                got, shift = _score(model, [data], shift, rate)
                result[i] += got[0]
            continue
        group.append((i, np.frombuffer(bytes(LEFT) + text + bytes([END]), np.uint8)))
        held += len(text) + LEFT
        if held >= GROUP_BYTES:
            _score_group(model, group, result, rate)
            group, held = [], 0
    _score_group(model, group, result, rate)
    return result


def _score_group(model: Model, group: list[tuple[int, np.ndarray]], result: np.ndarray, rate: float) -> None:
    if group:
        group = sorted(group, key=lambda g: -len(g[1]))
        got, _ = _score(model, [d for _, d in group], np.zeros((len(group), N_INPUTS)), rate)
        result[[i for i, _ in group]] = got


def _score(model: Model, parts: list[np.ndarray], shift: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """log2 probability of each part (longest first) and the corrections after it."""
    length = np.array([len(p) - LEFT for p in parts])
    blocks = -(-length // BLOCK_BYTES)
    live = np.searchsorted(-blocks, -np.arange(1, blocks[0] + 1), side="right")
    look = model.kinds.look(parts)
    first = np.cumsum(length) - length
    # bytes in the order they are coded: block after block, and in each block part after part
    part = np.concatenate([np.arange(n) for n in live])
    block = np.repeat(np.arange(len(live)), live)
    size = np.minimum(BLOCK_BYTES, length[part] - block * BLOCK_BYTES)
    begin = np.append(0, np.cumsum(size))
    real = _spread(first[part] + block * BLOCK_BYTES, size)
    total = np.zeros(len(parts))
    shift = shift.copy()
    after = np.cumsum(live)
    done = 0
    while done < len(live):  # as many blocks as fit the cache
        at = after[done] - live[done]
        end = max(done + 1, int(np.searchsorted(begin[after], begin[at] + PIECE_BYTES, side="right")))
        fixed, refined, bits = look.inputs(real[begin[at] : begin[after[end - 1]]])
        bit_at = np.append(0, np.cumsum(bits))[begin[at : after[end - 1] + 1] - begin[at]]
        base = at
        for n in live[done:end]:
            start = bit_at[at - base : at - base + n + 1]
            lo, hi = start[0], start[-1]
            cut, each = start[:-1] - lo, np.diff(start)
            z = fixed[lo:hi]
            for k, x in enumerate(refined, N_INPUTS - REFINED):
                z += np.repeat(shift[:n, k].astype(np.float32), each) * x[lo:hi]
            np.clip(z, -12, 12, out=z)
            np.negative(z, out=z)
            wrong = np.exp(z, out=z)
            both = 1 + wrong
            total[:n] -= np.add.reduceat(np.log(both), cut, dtype=np.float64)
            wrong /= both  # the probability that the other bit got
            for k, x in enumerate(refined, N_INPUTS - REFINED):
                shift[:n, k] += rate * np.add.reduceat(wrong * x[lo:hi], cut) / np.sqrt(each)
            at += n
        done = end
    return total / np.log(2), shift


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", held_out: tuple[int, int] = (7, 2)) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Learns from documents whose crc32(id) mod held_out[0] is not held_out[1] and scores all,
    whole; code trees and mixing weights come from all of the former, too. NULL texts are empty: their only token, and only byte, is the end. score is log10 of
    the mixed model's probability, base_score that of single tokens with one added to each count.
    Tokens are told apart by 64-bit hashes. Without training documents the model is the prior:
    even odds in all contexts. Repeated rows are scored, and counted, one by one.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    out = F.coalesce(fold(F.col(key), held_out[0]) == held_out[1], F.lit(False))
    rows = docs.select(F.col(key).alias("doc_id"), body.alias("body"), out.alias("held_out"))
    n_docs = rows.agg(F.count_if(~F.col("held_out"))).first()[0]
    training = rows.filter(~F.col("held_out")).select("body")
    counted = stored(count_tokens(rows.select("body", (~F.col("held_out")).alias("train"))))
    tree = build_tree(total_pairs(counted))
    model = _collect_model(count(training, tree), tree)
    tune(training, model)
    known = counted.filter("kind = -1").groupBy("hash").agg(F.sum("trained").alias("trained"), F.sum("everywhere").alias("everywhere"))
    known = stored(known)
    sums = known.agg(F.sum("trained"), F.count_if(F.col("trained") > 0), F.sum("everywhere")).first()
    tokens, kinds = (sums[0] or 0) + n_docs, (sums[1] or 0) + (n_docs > 0)
    floor = (sums[2] or 0) / FREQUENT
    common = known.filter(F.col("everywhere") >= floor).select("hash", "trained").toPandas().sort_values("hash")
    scored = _score_rows(spark, rows, model, common, tokens, kinds, n_docs)
    return _add_rare(scored, known.filter(F.col("everywhere") < floor).select("hash", "trained"), tokens, kinds)


def _collect_model(counted: DataFrame, tree: Tree) -> Model:
    """The tables, of fixed size, by way of the driver to all workers."""
    odds = [np.zeros(1 << bits, np.int8) for bits in TABLE_BITS]
    apart = [np.zeros(2 << bits, np.int8) for bits in TABLE_BITS]
    for r in merge(counted).collect():
        lo, hi = r["part"] << RANGE_BITS, (r["part"] + 1) << RANGE_BITS
        odds[r["kind"]][lo:hi] = np.frombuffer(r["odds"], np.int8)
        apart[r["kind"]][2 * lo : 2 * hi] = np.frombuffer(r["apart"], np.int8)
    return Model(tree, odds, np.full((DEPTHS * KINDS, N_INPUTS), START), apart)


SCORED = (
    "row long, doc_id {kind}, held_out boolean, n_tokens long, known long, base double, bits double, bytes long, rare array<long>"
)


def _score_rows(spark: SparkSession, rows: DataFrame, model: Model, common: pd.DataFrame, tokens: int, kinds: int, n_docs: int) -> DataFrame:
    arrays = (vars(model.tree), model.odds, model.weights)
    shared = spark.sparkContext.broadcast((arrays, common["hash"].to_numpy(np.int64), common["trained"].to_numpy(np.int64)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (tree, odds, weights), hashes, trained = shared.value
        model = Model(Tree(**tree), odds, weights)
        value = np.log10((np.append(trained, 0) + 1.0) / (tokens + kinds + 1))
        end = np.log10((n_docs + 1.0) / (tokens + kinds + 1))

        def counted(batch: pd.DataFrame, bits: np.ndarray) -> pd.DataFrame:
            bodies = list(batch["body"])
            names, number, each = _tokens(bodies)
            doc = np.repeat(np.arange(len(bodies)), each)
            at = np.minimum(np.searchsorted(hashes, names), max(len(hashes) - 1, 0))
            known = hashes[at] == names if len(hashes) else np.zeros(len(names), bool)
            frequent = known[number]
            rare = names[number[~frequent]]
            at, owner = at[number[frequent]], doc[frequent]
            base = np.bincount(owner, weights=value[at], minlength=len(bodies)) + end
            hit = np.bincount(owner, weights=trained[at] > 0, minlength=len(bodies)).astype(np.int64) + (n_docs > 0)
            rest = np.split(rare, np.cumsum(np.bincount(doc[~frequent], minlength=len(bodies)))[:-1])
            return pd.DataFrame(
                {
                    "row": batch["row"].to_numpy(),
                    "doc_id": batch["doc_id"].array,
                    "held_out": batch["held_out"].to_numpy(),
                    "n_tokens": each + 1,
                    "known": hit,
                    "base": base,
                    "bits": bits,
                    "bytes": [len(b) for b in bodies],
                    "rare": rest,
                }
            )

        for batch in batches:
            for group in _pieces(batch["body"], GROUP_BYTES):
                rows = batch.iloc[group]
                bits = score_texts(model, list(rows["body"]))
                for part in _pieces(rows["body"], WORDS_BYTES):  # words take far more memory than text
                    yield counted(rows.iloc[part], bits[part])

    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    return stored(numbered.mapInPandas(run, SCORED.format(kind=rows.schema["doc_id"].dataType.simpleString())))


def _add_rare(scored: DataFrame, known: DataFrame, tokens: int, kinds: int) -> DataFrame:
    """Add the tokens that are not frequent: none of their groups is large, so a plain shuffle join serves."""
    rare = scored.select("row", F.explode("rare").alias("hash")).join(known, "hash")
    value = F.log10((F.col("trained") + 1) / F.lit(float(tokens + kinds + 1)))
    rare = rare.groupBy("row").agg(F.sum(value).alias("more"), F.count_if(F.col("trained") > 0).alias("hits"))
    rare = rare.withColumnRenamed("row", "_row")
    both = scored.drop("rare").join(rare, F.col("row") == F.col("_row"), "left")
    return both.select(
        "doc_id",
        "held_out",
        F.col("n_tokens").cast("long").alias("n_tokens"),
        (F.col("known") + F.coalesce("hits", F.lit(0))).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("bits") * F.lit(float(np.log10(2)))).alias("score"),
        (-F.col("bits") / (F.col("bytes") + 1)).alias("bits_per_byte"),
    )
