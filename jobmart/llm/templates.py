"""Texts as templates: numbers, names and units become typed placeholders, and the values they held are kept apart."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

from jobmart.llm import words

#: Units that stand after a number, lower-cased. Fixed values.
UNITS = """
mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound
pounds oz ounce ounces ton tons tonne tonnes ml cl l liter liters litre litres gallon gallons s sec second seconds min
minute minutes h hr hrs hour hours day days week weeks month months year years usd eur dollar dollars euro euros cent
cents percent degree degrees celsius fahrenheit kmh mph hz khz mhz w kw watt watts v volt volts
""".split()

#: Spelled numbers, and those of them after which an "and" may go on with the number. Fixed values.
SPELLED = """
zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen
eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion
""".split()
SCALES = ["hundred", "thousand", "million", "billion"]

NUMBER, NAME, UNIT = 1, 2, 3

_DIGIT, _INSIDE, _END, _UPPER = (np.zeros(256, dtype=bool) for _ in range(4))
_DIGIT[48:58] = True
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_END[[ord(c) for c in ".!?:;\n"]] = True
_UPPER[65:91] = True
_JOINING = np.zeros(256, dtype=bool)  # between the words of one value
_JOINING[[32, 9, 45]] = True
#: Ranges of code points: punctuation, and letters of scripts without spaces.
_MARKS = [(0x2000, 0x200A), (0x2010, 0x205F), (0x3000, 0x3004), (0x3008, 0x3020), (0x30FB, 0x30FB), (0xFF01, 0xFF0F),
          (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65)]
_UNSPACED = [(0x0E01, 0x0E4F), (0x0E81, 0x0EDF), (0x0F40, 0x0FBC), (0x1000, 0x109F), (0x1780, 0x17D3), (0x2E80, 0x2FDF),
             (0x3005, 0x3007), (0x3021, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F)]
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32
#: Code points of one to three bytes whose case is known, from the Unicode tables of Python.
_CASED = 0x2000
_SMALL = np.array([ord(c) if len(c) == 1 else k for k, c in enumerate(chr(k).lower() for k in range(_CASED))])
_CAPITAL = np.array([chr(k).lower() != chr(k) for k in range(_CASED)])


def _unspaced(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes begin a letter of a script without spaces, and which belong to punctuation beyond ASCII.

    Such scripts are Thai, Lao, Tibetan, Burmese, Khmer, kana, and Chinese characters.
    """
    letter, mark = np.zeros(len(data), dtype=bool), np.zeros(len(data), dtype=bool)
    at = np.flatnonzero(data >= 0xE0)
    at = at[at + 2 < len(data)]
    if not len(at):
        return letter, mark
    code = ((data[at].astype(np.int64) & 15) << 12) | ((data[at + 1].astype(np.int64) & 63) << 6) | (data[at + 2] & 63)
    three = data[at] < 0xF0
    marks = three & np.logical_or.reduce([(code >= a) & (code <= b) for a, b in _MARKS])
    letters = three & ~marks & np.logical_or.reduce([(code >= a) & (code <= b) for a, b in _UNSPACED])
    # Characters beyond the basic plane: 0x20000 to 0x3FFFF.
    letters |= (data[at] == 0xF0) & (data[at + 1] >= 0xA0)
    letter[at[letters]] = True
    for k in range(3):
        mark[at[marks] + k] = True
    return letter, mark


def _cases(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with small letters for capital ones, and which bytes begin a capital letter.

    A letter whose small form has another number of bytes is a capital, but stays as it is.
    """
    small, capital = _LOWERED[data], _UPPER[data]
    at = np.flatnonzero((data >= 0xC3) & (data <= 0xE1))
    if not len(at):
        return small, capital
    two, three = at[data[at] <= 0xDF], at[data[at] == 0xE1]
    code = ((data[two].astype(np.int64) & 31) << 6) | (data[two + 1] & 63)
    new = _SMALL[code]
    capital[two] = _CAPITAL[code]
    change = (new != code) & (new >= 0x80) & (new < 0x800)
    small[two[change]] = 0xC0 | (new[change] >> 6)
    small[two[change] + 1] = 0x80 | (new[change] & 63)
    code = 0x1000 | ((data[three + 1].astype(np.int64) & 63) << 6) | (data[three + 2] & 63)
    new = _SMALL[code]
    capital[three] = _CAPITAL[code]
    change = (new != code) & (new >= 0x800)
    small[three[change]] = 0xE0 | (new[change] >> 12)
    small[three[change] + 1] = 0x80 | ((new[change] >> 6) & 63)
    small[three[change] + 2] = 0x80 | (new[change] & 63)
    return small, capital


def _hash_of(text: str) -> int:
    data = words.as_bytes(text.encode())
    return int(words.hashes(data, np.array([0]), np.array([len(data)]))[0])


def _hashes_of(texts: list[str]) -> np.ndarray:
    return np.sort(np.array([_hash_of(t) for t in texts], dtype=np.uint64))


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


_UNITS, _SPELLED, _SCALES, _AND = (_hashes_of(t) for t in (UNITS, SPELLED, SCALES, ["and"]))
_FLAG = np.uint64(1)
_EXACT = 1_000  # numbers the hashes of windows without placeholders apart from those with
_PLACEHOLDER = words.mixed(np.arange(11, 15, dtype=np.uint64))


@dataclass(frozen=True)
class Windows:
    """Windows of a template: first word and end in words of the text, hash, and values of the placeholders.

    ``cuts`` tells which windows hold only a part of a value of several words. The last bit of a value tells that only the loose reading has this placeholder.
    """

    at: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    slots: list[np.ndarray]
    cuts: np.ndarray


@dataclass(frozen=True)
class Template:
    """``tokens`` with placeholders by kind, ``kinds`` (0 for a plain word), and ``values``: what each token was.

    ``loose`` has the kinds if doubtful words are placeholders too; ``joined`` tells which tokens only spaces or hyphens
    part from the one before. ``owner`` is the number of the text that a token is in; no window lies in two texts.
    """

    tokens: np.ndarray
    kinds: np.ndarray
    values: np.ndarray
    loose: np.ndarray
    joined: np.ndarray
    owner: np.ndarray

    def __len__(self) -> int:
        return len(self.tokens)

    def _goes_on(self) -> np.ndarray:
        """Which words go on with the value of the word before."""
        same = self.joined & (self.loose > 0) & (self.loose != UNIT)
        same[1:] &= self.loose[1:] == self.loose[:-1]
        return same

    def loose_size(self) -> int:
        """The number of tokens in the loose reading."""
        return int((~self._goes_on()).sum())

    def windows(self, size: int, min_plain: int, only: Callable[[np.ndarray], np.ndarray] | None = None) -> Windows:
        """The windows of ``size`` tokens that hold at least ``min_plain`` plain words.

        ``only`` tells by their hashes which windows are wanted.
        """
        at, hashed = _eligible(self.tokens, self.kinds, self.owner, size, min_plain, only)
        values = self.values & ~_FLAG
        slots = [values[a : a + size][self.kinds[a : a + size] > 0] for a in at.tolist()]
        goes_on = np.append(self._goes_on(), False)
        return Windows(at, at + size, hashed, slots, goes_on[at] | goes_on[at + size])

    def exact_windows(self, size: int, only: Callable[[np.ndarray], np.ndarray] | None = None) -> Windows:
        """All windows of ``size`` tokens as they are written, without placeholders."""
        hashed = words.numbered(words.windows(self.values, size), size + _EXACT)
        at = np.flatnonzero(_in_one(self.owner, size))
        if only is not None:
            at = at[only(hashed[at])]
        none = np.empty(0, dtype=np.uint64)
        return Windows(at, at + size, hashed[at], [none] * len(at), np.ones(len(at), dtype=bool))

    def loose_windows(self, size: int, min_plain: int, only: Callable[[np.ndarray], np.ndarray] | None = None) -> Windows:
        """Likewise in the loose reading, where a run of like placeholders is one token; only those that differ."""
        kinds, first = self.loose, np.flatnonzero(~self._goes_on())
        if len(first) < size:
            return Windows(*(np.empty(0, dtype=t) for t in (np.int64, np.int64, np.uint64)), [], np.empty(0, dtype=bool))
        ends = np.append(first[1:], len(kinds))
        place = np.arange(len(kinds)) - np.repeat(first, ends - first)
        values = np.add.reduceat(words.mixed(self.values + place.astype(np.uint64)), first)
        values = np.where(ends - first > 1, values, self.values[first]) & ~_FLAG
        new = np.logical_or.reduceat(kinds != self.kinds, first) | (ends - first > 1)
        values |= new.astype(np.uint64)
        kinds = kinds[first]
        tokens = np.where(kinds == 0, self.values[first], _PLACEHOLDER[kinds])
        at, hashed = _eligible(tokens, kinds, self.owner[first], size, min_plain, only)
        differ = np.concatenate([[0], np.cumsum(new)])
        wanted = differ[at + size] > differ[at]
        at, hashed = at[wanted], hashed[wanted]
        slots = [values[a : a + size][kinds[a : a + size] > 0] for a in at.tolist()]
        return Windows(first[at], ends[at + size - 1], hashed, slots, np.zeros(len(at), dtype=bool))


def _in_one(owner: np.ndarray, size: int) -> np.ndarray:
    """Which runs of ``size`` tokens lie in one text."""
    return owner[: max(0, len(owner) - size + 1)] == owner[size - 1 :]


def _eligible(tokens: np.ndarray, kinds: np.ndarray, owner: np.ndarray, size: int, min_plain: int,
              only: Callable[[np.ndarray], np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
    hashed = words.numbered(words.windows(tokens, size), size)
    if not len(hashed):
        return np.empty(0, dtype=np.int64), hashed
    plain = np.concatenate([[0], np.cumsum(kinds == 0)])
    wanted = (plain[size:] - plain[:-size] >= min_plain) & _in_one(owner, size)
    if only is not None:
        wanted &= only(hashed)
    at = np.flatnonzero(wanted)
    return at, hashed[at]


def template(value: bytes | None) -> Template:
    """The template of one text, see ``templates``; null has no token."""
    return templates([value or b""])


def templates(texts: list[bytes]) -> Template:
    """One template for several texts, worked out at once; texts stay apart.

    Tokens are runs of letters and digits, lower-cased up to U+1FFF; punctuation and spacing do not count. In scripts
    without spaces each letter is a token.

    A token that starts with a digit is a number, points and commas between digits included; a word that is
    capitalised, and only its first letter, not at the start of a sentence, is a name; a unit is a word of ``UNITS``
    right after a number. In the loose reading a capitalised word at the start of a sentence is a name as well, and a
    spelled number is a number.
    """
    data = words.as_bytes(b"\n".join(texts))
    if not len(data):
        return Template(*(np.empty(0, dtype=t) for t in (np.uint64, np.int8, np.uint64, np.int8, bool, np.int64)))
    digit = _DIGIT[data]
    joint = np.zeros(len(data), dtype=bool)
    joint[1:-1] = ((data[1:-1] == ord(".")) | (data[1:-1] == ord(","))) & digit[:-2] & digit[2:]
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    letter, mark = _unspaced(data)
    inside[1:-1] = (_INSIDE[data] & ~mark) | joint
    # A letter of an unspaced script is a token; what stands right after it is another.
    border = letter.copy()
    after = np.flatnonzero(letter)
    after += np.where(data[after] < 0xF0, 3, 4)
    border[after[after < len(data)]] = True
    first = (inside[1:-1] > 0) & ((inside[:-2] == 0) | border)
    starts = np.flatnonzero(first)
    last = (inside[1:-1] > 0) & ((inside[2:] == 0) | np.append(border[1:], True))
    ends = np.flatnonzero(last) + 1
    if not len(starts):
        return templates([])
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    owner = np.searchsorted(begins, starts, side="right") - 1
    fresh = np.ones(len(starts), dtype=bool)  # first in its text
    fresh[1:] = owner[1:] != owner[:-1]
    small, large = _cases(data)
    values = words.hashes(small, starts, ends)

    kinds = np.zeros(len(starts), dtype=np.int8)
    upper = np.concatenate([[0], np.cumsum(large)])
    width = 1 + (data[starts] >= 0xC0) + (data[starts] >= 0xE0)
    capital = large[starts] & (upper[ends] - upper[starts] == 1) & (ends - starts > width)
    stops = np.concatenate([[0], np.cumsum(_END[data] & ~joint)])
    first = np.ones(len(starts), dtype=bool)
    first[1:] = stops[starts[1:]] > stops[ends[:-1]]
    kinds[capital & ~first] = NAME
    number = digit[starts]
    kinds[number] = NUMBER
    kinds[_follows(number, fresh) & ~number & _among(values, _UNITS)] = UNIT
    tokens = np.where(kinds == 0, values, _PLACEHOLDER[kinds])

    spelled = (kinds == 0) & _among(values, _SPELLED)
    ahead = np.append(spelled[1:] & ~fresh[1:], False)
    spelled |= _among(values, _AND) & ahead & _follows(spelled & _among(values, _SCALES), fresh)
    loose = np.where((kinds == 0) & capital, NAME, kinds).astype(np.int8)
    loose[spelled] = NUMBER
    loose[(kinds == 0) & ~spelled & _follows(spelled, fresh) & _among(values, _UNITS)] = UNIT
    parting = np.concatenate([[0], np.cumsum(~_JOINING[data])])
    joined = np.zeros(len(starts), dtype=bool)
    joined[1:] = parting[starts[1:]] == parting[ends[:-1]]
    return Template(tokens, kinds, values, loose, joined, owner)


def _follows(marked: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Which tokens come right after a marked one of their text."""
    out = ~fresh
    out[1:] &= marked[:-1]
    return out
