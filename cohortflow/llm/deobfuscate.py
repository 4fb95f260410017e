"""Noisy-channel restoration of disguised words (numpy and plain Python, inside a task).

A word is a lattice: each character may stand for itself or, at a price, for the letters it
imitates; a run of one letter may be shortened; a sign or space between letters may be dropped.
Viterbi search finds the cheapest path under the channel's prices and a character 4-gram model
of the corpus.
"""

from __future__ import annotations

import math
import re
import sys
import unicodedata
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Letters 1..26; 0 is everything else and ends a word.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
SIZE = len(LETTERS) + 1
ORDER = 4

# Characters and the letters they imitate.
IMITATES = {
    "0": "o", "1": "il", "2": "zr", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "{": "c", "*": "aeiou", "€": "e", "£": "l",
}
#: Prices in nats: an imitated letter, a run of three or more cut to one or two, a double cut to
#: one, a dropped separator, a letter-like character kept as a break.
IMITATED, REPEATED, DOUBLED, DROPPED, BREAK = 1.0, 1.0, 3.0, 0.8, 6.0
SEPARATORS = " .-_*·~'/\\,:;"
#: Longer spans are read but not remembered.
REMEMBERED = 64


def _fold(char: str) -> int:
    base = unicodedata.normalize("NFKD", char.lower())[0]
    return LETTERS.find(base) + 1


#: Latin-1 byte -> letter code.
CODES = bytes(_fold(bytes([b]).decode("latin-1")) for b in range(256))


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("latin-1", "replace").translate(CODES), np.uint8)


def count_grams(text: str, into: np.ndarray) -> None:
    """Add the 4-grams of a text's words: the context of a word's first letters is empty."""
    c = np.concatenate([np.zeros(3, np.uint8), codes(text), np.zeros(1, np.uint8)])
    grams = []
    for k in range(0, len(c) - 3, 1 << 16):  # what the processor's cache holds
        part = c[k:k + (1 << 16) + 3].astype(np.int32)
        one, two, three, here = part[2:-1], part[1:-2].copy(), part[:-3].copy(), part[3:]
        two[one == 0] = 0
        three[two == 0] = 0
        grams.append((((three * SIZE + two) * SIZE + one) * SIZE + here)[(here != 0) | (one != 0)])
    into += np.bincount(np.concatenate(grams), minlength=SIZE ** ORDER)


def language_model(counts: np.ndarray, weight: float = 5.0) -> np.ndarray:
    """Prices -log P(letter | three before) with each order backed by the next shorter one."""
    n = counts.reshape((SIZE,) * ORDER).astype(float)
    p = np.full(SIZE, 1 / SIZE)
    for axes in ((0, 1, 2), (0, 1), (0,), ()):
        seen = n.sum(axis=axes)
        p = (seen + weight * p) / (seen.sum(axis=-1, keepdims=True) + weight)
    return -np.log(p).astype(np.float32).ravel()


def _runs(word: str) -> list[tuple[str, int]]:
    return [(m[1], len(m[0])) for m in re.finditer(r"(.)\1*", word, re.S)]


def _cut(length: int, k: int) -> float:
    return 0.0 if k == length else REPEATED if length > 2 else DOUBLED


def _choices(char: str, length: int, inside: bool) -> list[tuple[str, float]]:
    """What a run of a character may say: letters (or "" or a break " ") and the channel's price."""
    own = _fold(char)
    if own:
        letter = LETTERS[own - 1]
        return [(letter * k, _cut(length, k)) for k in (1, 2) if k <= length]
    out = [(" ", BREAK if char.isalnum() or char in IMITATES else 0.0)]
    if inside and (char in SEPARATORS or not char.isalnum()):
        out.append(("", DROPPED))
    for letter in IMITATES.get(char, ""):
        out += [(letter * k, IMITATED + _cut(length, k)) for k in (1, 2) if k <= length]
    return out


PLANE = SIZE ** (ORDER - 1)
#: Choices of a character at most; spans searched at once, and rows that this may hold; what a letter code says (the last, -1: nothing).
_WIDEST, _SPANS, _MOST = 12, 1 << 13, 1 << 21
_SAYS = np.frombuffer((" " + LETTERS + "\0").encode(), np.uint8)


@lru_cache(1 << 14)
def _coded(char: str, length: int, inside: bool) -> tuple[tuple[str, tuple[int, ...], float], ...]:
    """The choices with their letter codes; a run of three or more is like one of three."""
    return tuple((said, tuple(LETTERS.find(x) + 1 for x in said), channel) for said, channel in _choices(char, length, inside))


def _walk(text: str, prices, best: dict[int, tuple], first: bool = True, last: bool = True) -> dict[int, tuple]:
    """The cheapest paths through a text's lattice, by the last three letter codes: price, (letters, those before).

    Exact: 27^3 states at most, and none is left out. Paths are back-pointers, so that those with
    one past share it. ``prices`` is indexed only; a list is fastest.
    """
    runs = _runs(text)
    for i, (char, length) in enumerate(runs):
        step: dict[int, tuple] = {}
        choices = _coded(char, min(length, 3), not (first and i == 0 or last and i == len(runs) - 1))
        for state, (price, said) in best.items():
            for letters, coded, channel in choices:
                s, p = state, price + channel
                for code in coded:
                    at = s * SIZE + code
                    if code:
                        p += prices[at]
                        s = at % PLANE
                    else:
                        if s % SIZE:  # a break after a break costs nothing
                            p += prices[at]
                        s = 0
                known = step.get(s)
                if known is None or p < known[0]:
                    step[s] = (p, (letters, said) if letters else said)
        best = step
    return best


def _said(link: tuple | None) -> str:
    out = []
    while link:
        out.append(link[0])
        link = link[1]
    return "".join(reversed(out))


def _cheapest(best: dict[int, tuple], prices) -> tuple[float, str]:
    price, link = min(((p + (float(prices[s * SIZE]) if s % SIZE else 0.0), said) for s, (p, said) in best.items()), key=lambda x: x[0])
    return price, _said(link)


def search(word: str, prices) -> tuple[float, str]:
    """The cheapest reading of a disguised span of any length, words separated by spaces, and its price."""
    return _cheapest(_walk(word, prices, {0: (0.0, None)}), prices)


def viterbi(word: str, prices) -> str:
    return search(word, prices)[1]


class Lattices:
    """Searches many spans at once, one character of each at a time; the results are those of ``search``.

    A path is a row (span, state, price) and a step is a few array operations over all of them; of the
    paths of one span in one state the cheapest stays. Where the rows become too many, the spans are halved.
    """

    def __init__(self, prices: np.ndarray):
        self.flat = prices.astype(np.float64).ravel()
        self.flat[0] = 0.0  # a break after a break costs nothing
        self.ids = np.zeros(sys.maxunicode + 1, np.int32)  # of the characters seen, from 1
        self.seen = 1
        # of each character, as a run of one to three, at an edge or inside: choices and their codes (-1: none)
        self.n, self.price = np.zeros(6, np.int64), np.zeros((6, _WIDEST))
        self.one, self.two = np.zeros((6, _WIDEST), np.int8), np.zeros((6, _WIDEST), np.int8)

    def _add(self, chars: list[str]) -> None:
        rows = [_coded(c, length, inside) for c in chars for length in (1, 2, 3) for inside in (False, True)]
        price = np.zeros((len(rows), _WIDEST))
        one, two = np.full((len(rows), _WIDEST), -1, np.int8), np.full((len(rows), _WIDEST), -1, np.int8)
        for i, row in enumerate(rows):
            for k, (_, said, channel) in enumerate(row):
                price[i, k] = channel
                one[i, k], two[i, k] = (*said, -1, -1)[:2]
        self.n = np.append(self.n, [len(row) for row in rows])
        self.price, self.one, self.two = np.vstack([self.price, price]), np.vstack([self.one, one]), np.vstack([self.two, two])

    def search(self, spans: list[str]) -> list[str]:
        """The cheapest reading of each span."""
        points = np.frombuffer("".join(spans).encode("utf-32-le", "surrogatepass"), np.uint32)
        ids = self.ids[points]
        if not ids.all():
            new = np.unique(points[ids == 0])
            self.ids[new] = np.arange(self.seen, self.seen + len(new))
            self.seen += len(new)
            self._add([chr(x) for x in new.tolist()])
            ids = self.ids[points]
        ends = np.cumsum(np.fromiter(map(len, spans), np.int64, len(spans)))
        begins = np.append(0, ends)[:-1]
        head = np.ones(len(points), bool)
        head[1:] = ids[1:] != ids[:-1]
        head[begins[begins < ends]] = True
        at = np.flatnonzero(head)
        last = np.searchsorted(at, ends)
        first = np.append(0, last)[:-1]
        inside = np.ones(len(at), np.int64)
        inside[first[first < last]] = inside[last[first < last] - 1] = 0
        ops = ids[at] * 6 + (np.minimum(np.diff(np.append(at, len(points))), 3) - 1) * 2 + inside
        said = np.zeros((len(ops), 2), np.uint8)
        order = np.argsort(first - last, kind="stable")[:np.count_nonzero(last - first)]
        for k in range(0, len(order), _SPANS):
            self._pass(ops, first, last - first, order[k:k + _SPANS], said)
        text = np.zeros(2 * len(ops) + len(spans), np.uint8)  # a line a span
        lines = np.arange(len(spans))
        to = 2 * np.arange(len(ops)) + np.repeat(lines, last - first)
        text[to], text[to + 1], text[2 * last + lines] = said[:, 0], said[:, 1], 10
        return text.tobytes().translate(None, b"\0").decode("ascii").split("\n")[:-1]

    def _pass(self, ops: np.ndarray, first: np.ndarray, runs: np.ndarray, order: np.ndarray, said: np.ndarray) -> None:
        """Write what the spans of ``order``, the longest first, say for each run."""
        begin, lengths, flat = first[order], runs[order], self.flat
        steps = int(lengths[0])
        live = np.searchsorted(-lengths, -np.arange(1, steps + 2), "right")  # spans that have a step
        item, state, price = np.arange(len(order), dtype=np.int32), np.zeros(len(order), np.int32), np.zeros(len(order))
        back, end, held = [], np.zeros(len(order), np.int64), 0
        for t in range(steps):
            op = ops[begin[item] + t]
            n = self.n[op]
            total = int(n.sum())
            held += total
            if held > _MOST and len(order) > 1:
                half = len(order) // 2
                self._pass(ops, first, runs, order[:half], said)
                self._pass(ops, first, runs, order[half:], said)
                return
            rows, k = np.arange(len(n)), 0
            if total > len(n):
                rows = np.repeat(rows, n)
                k = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
                op, item, state, price = op[rows], item[rows], state[rows], price[rows]
            one, two = self.one[op, k], self.two[op, k]
            at = np.where(one >= 0, state * np.int32(SIZE) + one, np.int32(0))
            price = price + self.price[op, k] + flat[at]  # nothing said: flat[0], no price
            state = np.where(one > 0, at % np.int32(PLANE), np.where(one == 0, np.int32(0), state))
            more = np.flatnonzero(two > 0)
            at = state[more] * np.int32(SIZE) + two[more]
            price[more] += flat[at]
            state[more] = at % np.int32(PLANE)
            if len(item) > live[t]:
                key = item * np.int32(PLANE) + state  # below _SPANS * PLANE
                by = np.argsort(key)
                fresh = np.append(True, np.diff(key[by]) > 0)
                if not fresh.all():
                    least = np.minimum.reduceat(price[by], np.flatnonzero(fresh))
                    group = np.cumsum(fresh) - 1
                    best = np.flatnonzero(price[by] == least[group])
                    by = by[best[np.append(True, np.diff(group[best]) > 0)]]
                    item, state, price, rows, one, two = item[by], state[by], price[by], rows[by], one[by], two[by]
            back.append((rows.astype(np.int32), one, two))
            cut = int(np.searchsorted(item, live[t + 1]))
            if cut < len(item):  # spans that end here
                by = np.lexsort((price[cut:] + flat[state[cut:] * SIZE], item[cut:]))
                ended = item[cut:][by]
                best = np.append(True, np.diff(ended) > 0)
                end[ended[best]] = cut + by[best]
                item, state, price = item[:cut], state[:cut], price[:cut]
        at = np.zeros(len(order), np.int64)
        for t in range(steps - 1, -1, -1):
            rows, one, two = back.pop()
            at[live[t + 1]:live[t]] = end[live[t + 1]:live[t]]
            here, to = at[:live[t]], begin[:live[t]] + t
            said[to, 0], said[to, 1] = _SAYS[one[here]], _SAYS[two[here]]
            at[:live[t]] = rows[here]


#: Letters, digits and imitating signs: a chunk, maybe of a word that is set apart; and what may part chunks within a piece.
_CHUNK = re.compile(rf"(?:[^\W_]|[{re.escape(''.join(c for c in IMITATES if not c.isalnum()))}])+")
_PARTS = re.compile(r"[._\-~·/\\,:;'\"?)\]}>]+")
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
#: Signs that can only be a break at an edge: without them the lattice says the same.
_BREAKS = "".join(c for c in _EDGE if c not in IMITATES)
#: A piece without letters, digits or imitations only parts chunks.
_LONG = re.compile(rf"[^\W_]|[{re.escape(''.join(c for c in IMITATES if not c.isalnum()))}]")
#: Signs around a piece that are such a break and part chunks.
_OUTER = "".join(c for c in _BREAKS if _PARTS.fullmatch(c))
_SURE = re.compile("[a-z]+")
_DOUBLE = re.compile(r"([^\W\d_])\1")
_LETTER = re.compile(r"[^\W\d_]")
_NO_WORD = re.compile(r"[^\w]+")
#: Three letters that are read in one way, also beside what is around them.
_SAME = re.compile(r"(?<=(.))(?!\1)([a-z])(?!\2)([a-z])(?!\3)([a-z])(?!\4)", re.S)
#: Parts of spans up to this are searched many at once, longer ones one by one.
_LONGEST = 256
#: Characters after the last letters that are read in one way, and end states, that a chunk's bounds hold.
_REST, _ENDS = 8, 16
_STOP = 1 << 60
#: Words of one or two letters in a row whose gaps are decided at once; longer rows are searched.
_SHORTS = 4
_LATIN = np.append(np.frombuffer(CODES, np.uint8), np.uint8(0))
_FOLD = {b: LETTERS[CODES[b] - 1] for b in range(256) if CODES[b]}


def _base(letters: str) -> str:
    """Letters without accents; "" if some character is no such letter."""
    if letters.isascii():
        return letters if _SURE.fullmatch(letters) else ""
    base = letters.translate(_FOLD)
    return base if _SURE.fullmatch(base) else ""


def _code(letters: str) -> int:
    out = 0
    for x in letters:
        out = out * SIZE + ord(x) - 96
    return out


def _single(letters: str) -> int:
    """The code of three letters that are read in one way, else 0."""
    base = _base(letters)
    if len(base) != 3 or letters[0] == letters[1] or letters[1] == letters[2]:
        return 0
    return _code(base)


def _with_base(word: str) -> tuple[str, ...]:
    """The word and, where it has accents, its base letters."""
    if word.isascii():
        return (word,)
    return (word, "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c)))


def _letters(names: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Which names are letters that are read in one way; of these the base letters, and the bounds as ``Restorer._bounds`` has them."""
    points = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _LATIN[np.minimum(points, 256)]
    sizes = np.fromiter(map(len, names), np.int64, len(names))
    ends = np.cumsum(sizes)
    begins = ends - sizes
    odd = codes == 0
    odd[1:] |= points[1:] == points[:-1]
    odd[begins[(begins < ends) & (codes[np.minimum(begins, len(codes) - 1)] > 0)]] = False  # the same as in the name before
    odd = np.append(0, np.cumsum(odd))
    plain = (odd[ends] == odd[begins]) & (sizes > 0)
    text = np.full(len(codes) + len(names), 10, np.uint8)
    text[np.arange(len(codes)) + np.repeat(np.arange(len(names)), sizes)] = codes + 96
    bases = text.tobytes().decode("ascii").split("\n")[:-1]
    some, packed = np.flatnonzero(plain), np.zeros(len(names), np.int64)
    a, b, n, wide = begins[some], ends[some], sizes[some], codes.astype(np.int64)
    head = np.zeros(len(some), np.int64)
    for k in range(3):
        head = np.where(n > k, head * SIZE + wide[np.minimum(a + k, b - 1)], head)
    tail = (wide[b - 3] * SIZE + wide[b - 2]) * SIZE + wide[b - 1]  # of three and more
    packed[some] = np.where(n < 3, PLANE + head, head | tail << 16)
    return plain, bases, packed


class Numbers:
    """Numbers names from 0 in the order in which they come."""

    def __init__(self, names: list[str] | None = None):
        self.names = names or []
        self.number = {name: i for i, name in enumerate(self.names)}

    def of(self, names: list[str]) -> tuple[np.ndarray, list[str]]:
        """The names' numbers, and those of the names that are new."""
        number, known = self.number, len(self.names)
        give = number.setdefault
        out = np.array([give(name, len(number)) for name in names], np.int64)
        new = list(islice(number, known, None))
        self.names += new
        return out, new


class Lists:
    """Lists of numbers, one behind the other in one array."""

    def __init__(self, lists: list[list[int]] | None = None):
        self.flat, self.ends = np.zeros(0, np.int64), np.zeros(1, np.int64)
        if lists:
            self.add(np.array([x for some in lists for x in some], np.int64), list(map(len, lists)))

    def add(self, flat: np.ndarray, lengths: list[int]) -> None:
        self.flat = np.append(self.flat, flat)
        self.ends = np.append(self.ends, self.ends[-1] + np.cumsum(lengths, dtype=np.int64))

    def gather(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers in the chosen lists, and for each the place in ``which`` of its list."""
        begin = self.ends[which]
        n = self.ends[which + 1] - begin
        at = np.repeat(np.arange(len(which)), n)
        return self.flat[np.arange(len(at)) - (np.cumsum(n) - n - begin)[at]], at


def _distinct(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers in order, and the place of each number among them (numbers are small: an array by number)."""
    there = np.zeros(int(numbers.max(initial=-1)) + 1, bool)
    there[numbers] = True
    return np.flatnonzero(there), (np.cumsum(there) - 1)[numbers]


def pairs(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of numbers, in order; the second ones are below ``n``."""
    both = np.sort(a * n + b)
    return np.divmod(both[np.append(True, both[1:] != both[:-1])] if len(both) else both, max(1, n))


def _cuts(span: str) -> list[str]:
    """Pieces of a span, each but the first beginning with the three letters with which that before it ends."""
    out, start = [], 0
    for m in _SAME.finditer(span):
        if m.end() - start > REMEMBERED >> 1:
            out.append(span[start:m.end()])
            start = m.start()
    return [*out, span[start:]]


class Restorer:
    """Reads words and spans; what it has read is remembered up to a bound.

    Pieces and chunks have numbers, and arrays hold what is known of each, so that the texts of a
    batch are read by array operations; only new pieces, chunks and runs of chunks cost Python.
    """

    def __init__(self, prices: np.ndarray, memo: int = 1 << 18):
        self.prices, self.bound = prices, memo
        self._price = prices.tolist()
        self._flat = prices.astype(np.float64).ravel()
        self._lattices = Lattices(prices)
        self.memo: dict[str, tuple[str, ...]] = {}  # span -> words
        self._heads: dict[str, int] = {}
        self._forget()

    def _forget(self) -> None:
        """Begin anew with the numbers of pieces, chunks and words."""
        self._words = Numbers()
        self._chunk, self._bases, self._packed, self._plain = Numbers([""]), [""], np.array([_STOP]), np.ones(1, bool)
        self._alone = Lists([[]])  # what a chunk between two breaks says, if that is not the chunk itself
        self._pieces, self._parts, self._says = Numbers(), Lists(), Lists()  # a piece's chunks, and its restored words
        self._runs, self._found = Numbers(), Lists()  # runs of chunks, and their words
        self._sets: dict[tuple[int, str], int] = {}  # states and prices at the ends of chunks that have several
        self._tails, self._costs = np.zeros((0, _ENDS), np.int64), np.zeros((0, _ENDS))

    def word(self, raw: str) -> tuple[str, ...]:
        """The restored words in one whitespace-separated piece of a lower-case text."""
        return self.words([raw])[0]

    def words(self, raws: list[str]) -> list[tuple[str, ...]]:
        """``word`` of each."""
        out, spans = [], []
        for raw in raws:
            core = raw.strip(_BREAKS)
            if core.isalpha() and not _DOUBLE.search(core):
                out.append(_with_base(core))  # the lattice has this one path
                continue
            plain, whole = [], core.strip(_EDGE)
            if _LETTER.search(core):
                plain = [p for p in _NO_WORD.split(core) if p]
                if len(plain) > 1 and whole.replace("'", "").replace("-", "").isalpha():
                    plain.append(whole)
            spans.append((len(out), core))
            if whole != core:
                spans.append((len(out), whole))
            out.append(tuple(plain))
        for (i, _), said in zip(spans, self.spans([span for _, span in spans])):
            out[i] += said
        return out

    def spans(self, raws: list[str]) -> list[tuple[str, ...]]:
        """The words of the cheapest reading of each disguised span."""
        memo = self.memo
        if len(memo) > self.bound >> 2:
            memo.clear()
        new = list({raw for raw in raws if raw not in memo})
        read = dict(zip(new, map(tuple, map(str.split, self._readings(new)))))
        out = [read[raw] if raw in read else memo[raw] for raw in raws]
        memo.update((raw, said) for raw, said in read.items() if len(raw) <= REMEMBERED)
        return out

    def _readings(self, spans: list[str]) -> list[str]:
        """The cheapest reading of each span; a long one is cut where all paths say the same three letters."""
        cuts = {span: _cuts(span) for span in spans if len(span) > REMEMBERED}
        parts = [part for cut in cuts.values() for part in cut]
        out = self._lattices.search([x if len(x) <= _LONGEST else "" for x in (*parts, *("" if span in cuts else span for span in spans))])
        read = iter([viterbi(x, self._price) if len(x) > _LONGEST else said for x, said in zip(parts, out)])
        out = out[len(parts):]
        long = {span: "".join(next(read)[3 if k else 0:] for k in range(len(cut))) for span, cut in cuts.items()}
        return [long[span] if span in long else said for span, said in zip(spans, out)] if long else out

    @staticmethod
    def _chunks(piece: str) -> tuple[str, ...]:
        """The chunks of a whitespace-separated piece: () if it only parts others, ("",) if it ends a run of them."""
        parts = [p for p in _PARTS.split(piece) if p]
        if all(map(_CHUNK.fullmatch, parts)):
            return tuple(parts)
        return ("",) if _LONG.search(piece) else ()

    def _single(self, letters: str) -> int:
        """The code of three letters that are read in one way, else 0."""
        code = self._heads.get(letters)
        if code is None:
            if len(self._heads) >= self.bound:
                self._heads.clear()
            code = self._heads[letters] = _single(letters)
        return code

    def _bounds(self, chunk: str) -> int:
        """The first three letters a chunk says, and what it may end in, packed; 0 for what is not known.

        Bits 0 to 15: the code of the first three letters, where all paths have them; PLANE and up,
        that of a whole word of one or two letters. Bits 16 and up: the code of the last three, or
        PLANE and up, the number of a set of end states. _STOP ("") ends a run of chunks.
        """
        n = len(chunk)
        if n < 3:
            return PLANE + _code(_base(chunk)) if _base(chunk) and not _DOUBLE.search(chunk) else 0
        head = self._single(chunk[:3])
        for i in range(n, max(2, n - _REST), -1):
            known = self._single(chunk[i - 3:i]) if i == n or chunk[i] != chunk[i - 1] else 0
            if known:
                return head | (known if i == n else self._set(known, chunk[i:])) << 16
        return head

    def _set(self, state: int, rest: str) -> int:
        """The number of the set of end states of ``rest`` after a state, plus PLANE; 0 if they are too many."""
        at = self._sets.get((state, rest))
        if at is None:
            ends = [(s, p) for s, (p, _) in _walk(rest, self._price, {state: (0.0, None)}, False, False).items()]
            if len(ends) > _ENDS:
                return 0
            at = self._sets[state, rest] = len(self._sets)
            if at >= len(self._tails):
                more = max(256, at)
                self._tails = np.concatenate([self._tails, np.zeros((more, _ENDS), np.int64)])
                self._costs = np.concatenate([self._costs, np.full((more, _ENDS), np.inf)])
            self._tails[at, :len(ends)], self._costs[at, :len(ends)] = zip(*ends)
        return PLANE + at

    def _say(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The price of saying the (up to three) letters of a code after a state, and the state then."""
        cost = np.zeros(np.broadcast(state, word).shape)
        for power in (SIZE * SIZE, SIZE, 1):
            letter = word // power % SIZE
            at = state * SIZE + letter
            said = letter > 0
            cost += np.where(said, self._flat[at], 0.0)
            state = np.where(said, at % PLANE, state)
        return cost, state

    def _gap(self, state: np.ndarray, word: np.ndarray) -> tuple[tuple, tuple]:
        """Price and state after a word's letters, with a break before them and without (nothing is dropped after a break)."""
        apart, there = self._say(np.zeros_like(state), word)
        together, here = self._say(state, word)
        broken = state == 0
        return ((apart + np.where(broken, 0.0, self._flat[state * SIZE]), there),
                (np.where(broken, np.inf, together + DROPPED), here))

    def _gaps(self, flat: np.ndarray) -> np.ndarray:
        """For each gap between neighbouring chunks: 1 a break, 2 none, 0 to be searched.

        Three letters after a gap a path is in the same state with a break and without. So the letters
        around a gap, or around a short word between two gaps, decide alone for every cheapest path.
        """
        packed = self._packed[flat]
        stop = flat == 0
        packed[stop] = 0
        tail, head = packed >> 16, packed & 0xFFFF
        short, known = head >= PLANE, (head > 0) & (head < PLANE)
        one = (tail > 0) & (tail < PLANE)
        out = np.zeros(len(flat) - 1, np.int8)
        at = np.flatnonzero(one[:-1] & known[1:])
        (apart, _), (together, _) = self._gap(tail[at], head[at + 1])
        out[at] = np.where(apart <= together, 1, 2)
        at = np.flatnonzero((tail[:-1] >= PLANE) & known[1:])
        if len(at):
            sets = tail[at] - PLANE
            (apart, _), (together, _) = self._gap(self._tails[sets], head[at + 1][:, None])
            cost = self._costs[sets]
            out[at] = np.where((apart + cost).min(axis=1) <= (together + cost).min(axis=1), 1, 2)
        for k in range(1, min(_SHORTS, len(flat) - 2) + 1):  # k short words: all ways through the gaps around them
            fits = one[:-k - 1] & known[k + 1:]
            for i in range(1, k + 1):
                fits &= short[i:len(short) - k - 1 + i]
            at = np.flatnonzero(fits)
            if not len(at):
                continue
            ways = [(0.0, tail[at])]
            for i in range(1, k + 2):
                word = head[at + i] - (PLANE if i <= k else 0)
                ways = [(p + q, there) for p, state in ways for q, there in self._gap(state, word)]
            best = np.stack([p for p, _ in ways]).argmin(axis=0)
            for i in range(k + 1):
                out[at + i] = (best >> k - i & 1) + 1
        out[stop[:-1] | stop[1:]] = 1
        return out

    def _number(self, chunks: list[str]) -> np.ndarray:
        """The numbers of chunks; what is known of new ones is found first."""
        out, new = self._chunk.of(chunks)
        if new:
            plain, bases, packed = _letters(new)
            others = np.flatnonzero(~plain).tolist()
            for i in others:
                bases[i] = _base(new[i])
                packed[i] = self._bounds(new[i])
            self._bases += bases
            self._plain, self._packed = np.append(self._plain, plain), np.append(self._packed, packed)
            alone: list = [()] * len(new)
            doubled = [i for i in others if bases[i]]
            for i, said in zip(doubled, self.spans([new[i] for i in doubled])):
                alone[i] = [w for w in said if len(w) > 2 and w != new[i]]
            self._alone.add(*self._flat_words(alone))
        return out

    def _flat_words(self, lists: list) -> tuple[np.ndarray, list[int]]:
        """The words' numbers, one list after the other, and the lists' lengths."""
        return self._words.of([w for some in lists for w in some])[0], list(map(len, lists))

    def _learn(self, pieces: list[str], words: bool) -> np.ndarray:
        """The numbers of pieces; their chunks and, if asked for, their restored words are found first."""
        out, new = self._pieces.of(pieces)
        if new:
            cores = [piece.strip(_OUTER) for piece in new]
            plain, bases, _ = _letters(cores)
            others = np.flatnonzero(~plain).tolist()
            parts: list = [(core,) for core in cores]
            says: list = [(core,) if core == base else (core, base) for core, base in zip(cores, bases)] if words else [()] * len(new)
            for i in others:
                parts[i] = self._chunks(new[i])
            if words:
                for i, said in zip(others, self.words([new[i] for i in others])):
                    says[i] = said
            self._parts.add(self._number([c for some in parts for c in some]), list(map(len, parts)))
            self._says.add(*self._flat_words(says))
        return out

    def _set_apart(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places in a row of chunks at which words are found, and the words' numbers, in order.

        The gaps whose neighbours alone decide are found at once; what lies between breaks is read as
        one word, or searched where a gap is still open or a letter may be read in several ways.
        """
        if len(flat) < 2:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        gaps = self._gaps(flat)
        cut = np.flatnonzero(gaps == 1)
        starts, lasts = np.append(0, cut + 1), np.append(cut, len(flat) - 1)
        single = starts[starts == lasts]
        runs = np.flatnonzero(lasts > starts)
        a, b = starts[runs], lasts[runs] + 1
        unsure = np.append(0, np.cumsum(gaps == 0))
        unsure = unsure[b - 1] > unsure[a]
        odd = np.append(0, np.cumsum(~self._plain[flat]))
        sure = ~unsure & (odd[b] == odd[a])  # the lattice has this one path
        plain = self._joins(self._bases, flat, a[sure], b[sure], "")
        words, numbers = self._words.of(plain.dictionary.to_pylist())[0], np.asarray(plain.indices)
        read = self._joins(self._chunk.names, flat, a[~sure], b[~sure], " ")
        runs, which = read.dictionary.to_pylist(), np.asarray(read.indices)
        known = self._known_runs(runs)
        found, at = self._found.gather(known[which])
        marked = np.array([run[-1] == "!" and run[-2] != " " for run in runs], bool)  # more often a mark than a letter
        again = np.flatnonzero(marked[which] & unsure[~sure])
        short = [runs[i].rstrip("!") for i in which[again].tolist()]
        other, to = self._found.gather(self._known_runs([run + "!" if run[-1:] == " " else run for run in short]))
        alone, by = self._alone.gather(flat[single])
        places = np.concatenate([a[sure], a[~sure][at], a[~sure][again][to], single[by]])
        order = np.argsort(places, kind="stable")
        return places[order], np.concatenate([words[numbers], found, other, alone])[order]

    @staticmethod
    def _joins(names: list[str], flat: np.ndarray, a: np.ndarray, b: np.ndarray, by: str) -> pa.DictionaryArray:
        """The names in each stretch, joined."""
        at = np.repeat(b - np.cumsum(b - a), b - a) + np.arange(int((b - a).sum()))
        some, which = _distinct(flat[at])
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(b - a)).astype(np.int32)),
                                         pa.array([names[i] for i in some.tolist()], pa.string()).take(pa.array(which)))
        return pc.binary_join(lists, by).dictionary_encode()

    def _known_runs(self, runs: list[str]) -> np.ndarray:
        """The numbers of runs of chunks; their words of three letters and more that are no chunks are found first."""
        out, new = self._runs.of(runs)
        if new:
            found = []
            for run, said in zip(new, self._readings(new)):
                chunks = run.split(" ")
                found.append([w for w in said.split() if len(w) > 2 and w not in chunks] if said != run else ())
            self._found.add(*self._flat_words(found))
        return out

    def _chunk_row(self, pieces: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The chunks of texts, one after the other with a stop behind each, and where each text ends.

        ``ends`` are the texts' ends in ``pieces``.
        """
        chunks, at = self._parts.gather(pieces)
        behind = np.searchsorted(at, ends)
        return np.insert(chunks, behind, 0), behind + 1 + np.arange(len(ends))

    def joined(self, chunks: tuple[str, ...]) -> tuple[str, ...]:
        """The words of chunks set apart, where each gap is a break or dropped: one exact pass."""
        return tuple(w for w in self.spans([" ".join(chunks)])[0] if len(w) > 2 and w not in chunks)

    def spaced(self, text: str, pieces: list[str] | None = None) -> list[str]:
        """Words restored from letters or chunks of any length that are set apart by any spaces and signs."""
        return self.set_apart([text.split() if pieces is None else pieces])[0]

    def set_apart(self, texts: list[list[str]]) -> list[list[str]]:
        """``spaced`` for many texts, each given as its whitespace-separated pieces."""
        self._forget()
        found: list[list[str]] = [[] for _ in texts]
        flat, ends = self._chunk_row(self._learn([p for pieces in texts for p in pieces], False), np.cumsum(list(map(len, texts)), dtype=np.int64))
        places, words = self._set_apart(flat)
        for text, word in zip(np.searchsorted(ends, places, "right").tolist(), words.tolist()):
            found[text].append(self._words.names[word])
        return found

    def restored(self, texts: pa.Array) -> pa.Array:
        """The texts replaced by their distinct restored words, parted by spaces."""
        if len(self._pieces.names) > self.bound:
            self._forget()
        self._runs, self._found = Numbers(), Lists()  # few come again
        split = pc.utf8_split_whitespace(pa.array([(text or "").lower() for text in texts.to_pylist()], pa.large_string()))
        pieces, ends = split.flatten().dictionary_encode(), np.asarray(split.offsets)[1:]
        pieces = self._learn(pieces.dictionary.to_pylist(), True)[np.asarray(pieces.indices)]
        flat, stops = self._chunk_row(pieces, ends)
        places, joined = self._set_apart(flat)
        owner = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
        owner, pieces = pairs(owner, pieces, len(self._pieces.names))
        words, at = self._says.gather(pieces)
        owner, words = pairs(np.append(owner[at], np.searchsorted(stops, places, "right")), np.append(words, joined), len(self._words.names))
        some, words = _distinct(words)
        names = pa.array([self._words.names[i] for i in some.tolist()], pa.string())
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), names.take(pa.array(words))), " ")
